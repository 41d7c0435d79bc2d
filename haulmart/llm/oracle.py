"""The same results in plain SQL, where SQL can express them.

Fingerprints, tokenizers, kernels, keyed surrogates, alignments and the curve
are beyond it; the tests hold those queries against brute force.
"""

from __future__ import annotations

# Fence number, measure, and whether it is a lower limit.
_FENCES = """
    (0, 'word_length', FALSE), (1, 'word_length', TRUE), (2, 'symbol_share', FALSE),
    (3, 'line_share', FALSE), (4, 'repeat_share', FALSE)
"""

_QUALITY = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), trigram AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
    SELECT r, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM trigram) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n FROM repeated GROUP BY r
), counts AS (
    SELECT d.r, doc_id, lang, source, len(words) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words
    FROM d JOIN w USING (r) LEFT JOIN covered USING (r)
), measured AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        word_chars * 100 // greatest(n_words, 1) AS word_length,
        n_symbols * 1000 // greatest(n_words, 1) AS symbol_share,
        n_dup_lines * 1000 // greatest(n_lines, 1) AS line_share,
        n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_share
    FROM counts
), long AS (
    UNPIVOT (SELECT r, lang, source, base_failed, word_length, symbol_share, line_share, repeat_share FROM measured)
    ON word_length, symbol_share, line_share, repeat_share INTO NAME measure VALUE v
), binned AS (
    SELECT lang, source, measure, count(*) AS n,
        CASE WHEN v < 64 THEN v
            ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END AS b
    FROM long WHERE NOT base_failed GROUP BY lang, source, measure, b
), merged AS (
    SELECT 0 AS level, lang, source, measure, b, n FROM binned
    UNION ALL SELECT 1, lang, NULL, measure, b, sum(n) FROM binned GROUP BY lang, measure, b
    UNION ALL SELECT 2, NULL, NULL, measure, b, sum(n) FROM binned GROUP BY measure, b
), ranked AS (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY b) AS upto,
        sum(n) OVER (PARTITION BY level, lang, source, measure) AS total
    FROM merged
), quantile AS (
    SELECT level, lang, source, measure, max(total) AS seen, q,
        min(CASE WHEN 100 * upto >= q * total THEN b END) AS b
    FROM ranked, (VALUES (5), (50), (95), (99)) AS t(q) GROUP BY level, lang, source, measure, q
), numbers AS (
    SELECT level, lang, source, measure, seen, q,
        CASE WHEN b < 64 THEN b WHEN q < 50 THEN (b - (b // 32 - 1) * 32) << CAST(b // 32 - 1 AS INTEGER)
            ELSE ((b - (b // 32 - 1) * 32 + 1) << CAST(b // 32 - 1 AS INTEGER)) - 1 END AS v
    FROM quantile
), own AS (
    SELECT t.level, t.lang, t.source, t.seen, f.k, f.below, floor((5 * t.v - 3 * m.v) / 2.0) AS lim
    FROM numbers t JOIN numbers m ON m.q = 50 AND m.measure = t.measure AND m.level = t.level
            AND m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source
        JOIN (VALUES {_FENCES}) f(k, measure, below) ON f.measure = t.measure
            AND t.q = CASE WHEN f.below THEN 5 WHEN f.k IN (0, 2) THEN 95 ELSE 99 END
), vote AS (
    SELECT * FROM own WHERE level = 0 AND seen >= 20
), of_all AS (
    SELECT k, CASE WHEN below THEN quantile_disc(lim, 0.5) ELSE -quantile_disc(-lim, 0.5) END AS whole
    FROM vote GROUP BY k, below
), of_language AS (
    SELECT lang, k, greatest(least(mid, floor(3 * whole / 2)), floor(whole / 2)) AS mid
    FROM (SELECT lang, k, CASE WHEN below THEN quantile_disc(lim, 0.5) ELSE -quantile_disc(-lim, 0.5) END AS mid
        FROM vote GROUP BY lang, k, below) JOIN of_all USING (k)
), held AS (
    SELECT own.*, greatest(least(lim, floor(3 * m / 2)), floor(m / 2)) AS held_lim
    FROM (SELECT own.*, coalesce(l.mid, a.whole) AS m
        FROM own LEFT JOIN of_all a ON a.k = own.k
            LEFT JOIN of_language l ON l.k = own.k AND own.level < 2 AND l.lang IS NOT DISTINCT FROM own.lang) own
), chosen AS (
    SELECT r, h.k, h.below, x.v, arg_min(coalesce(h.held_lim, h.lim), h.level) AS lim
    FROM long x JOIN (VALUES {_FENCES}) f(k, measure, below) ON f.measure = x.measure
        JOIN held h ON h.k = f.k AND (h.seen >= 200 OR h.level = 2)
        AND (h.level = 2 OR x.lang IS NOT DISTINCT FROM h.lang)
        AND (h.level > 0 OR x.source IS NOT DISTINCT FROM h.source)
    GROUP BY r, h.k, h.below, x.v
), broken AS (
    SELECT DISTINCT r FROM chosen WHERE CASE WHEN below THEN v < lim ELSE v > lim END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND r NOT IN (SELECT r FROM broken) AS kept
FROM measured
"""

_CHAT = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, t) AS k,
        2 * length(t) - length(translate(t, '~<[>', '')) AS inner_chars,
        CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
            ELSE 9 + 2 * length(role) - length(translate(role, '~<[>', '')) END AS mark_chars
    FROM said
), whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || t || chr(10), '' ORDER BY k) AS told,
        coalesce(string_agg(t, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss,
        CAST(sum(inner_chars + mark_chars) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""

_NEGATIVES = """
WITH v AS (
    SELECT CAST(vec_id AS BIGINT) AS id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.id AS anchor_id, a.label AS anchor_label, b.id, b.label,
        CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0
), p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> anchor_label AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""

_PHRASES = r"""
WITH piece AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS x
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents WHERE text IS NOT NULL
    )
), w AS (
    SELECT lang, list_filter(regexp_split_to_array(x, '[\x20\x09]+'), lambda y: y <> '') AS w FROM piece
), g AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k))
), f AS (
    SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase
), total AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cut AS (
    SELECT lang, phrase, k, f AS a, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1 : k], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS i FROM c)
), scored AS (
    SELECT cut.*, x.f AS l, y.f AS r,
        CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head AND x.k = i
        JOIN f y ON y.lang = cut.lang AND y.phrase = tail AND y.k = cut.k - i
    QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, i) = 1
), covered AS (
    SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(f) AS longer
    FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY 1, 2
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
    s.phrase, a, l, r, n, score
FROM scored s JOIN total ON total.lang = s.lang
    LEFT JOIN covered o ON o.lang = s.lang AND o.phrase = s.phrase AND s.k = 2
WHERE o.longer IS NULL OR 100 * o.longer < 50 * a
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op6_quality_rules": _QUALITY,
    "op8_chat_formatting": _CHAT,
    "op12_hard_negatives": _NEGATIVES,
    "op13_phrases": _PHRASES,
}

import numpy as np
import pytest
from tokenizers import Tokenizer

from haulmart.llm import attribution

TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "two\nlines here\n", "Ünïcode ß\nÉ 中文 😀 end\n  indented\r\nx",
    "token = \"04dbebab91ab\"\n\n\n  gap\t\ttabs", "word " * 3000 + "\n" + "x" * 5000,
]


def brute(starts, ends, lo, hi, rule):
    counts, crossing, outside = [0.0] * len(lo), [0] * len(lo), 0.0
    for s, e in zip(starts, ends):
        share = [max(0, min(e, b) - max(s, a)) for a, b in zip(lo, hi)]
        for i, x in enumerate(share):
            crossing[i] += 0 < x < e - s
        if rule == "parts":
            for i, x in enumerate(share):
                counts[i] += x / (e - s)
            outside += 1 - sum(share) / (e - s)
            continue
        if rule == "first":
            chosen = next((i for i, (a, b) in enumerate(zip(lo, hi)) if a <= s < b), None)
        else:
            chosen = share.index(max(share)) if share and max(share) else None
        if chosen is None:
            outside += 1
        else:
            counts[chosen] += 1
    return counts, crossing, outside


def test_spans_equal_those_of_another_library():
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder = attribution.encoder(attribution.ranks_path())
    for text in TEXTS[4:]:
        starts, ends = coder.spans(text)
        assert list(zip(starts.tolist(), ends.tolist())) == library.encode(text, add_special_tokens=False).offsets


@pytest.mark.parametrize("rule", attribution.RULES)
def test_allocation_equals_a_plain_one(rule):
    draw = np.random.default_rng(4)
    for _ in range(80):
        cuts = np.sort(draw.choice(200, 2 * draw.integers(0, 9), replace=False))
        lo, hi = cuts[0::2].astype(np.int64), cuts[1::2].astype(np.int64)
        edges = np.unique(np.r_[0, draw.integers(0, 200, 40), 200])
        counts, crossing, outside = attribution.attribute(edges[:-1], edges[1:], lo, hi, rule)
        want = brute(edges[:-1].tolist(), edges[1:].tolist(), lo.tolist(), hi.tolist(), rule)
        assert np.allclose(counts, want[0]) and crossing.tolist() == want[1] and abs(outside - want[2]) < 1e-9


def test_unknown_rule_is_refused():
    empty = np.empty(0, np.int64)
    with pytest.raises(ValueError):
        attribution.attribute(empty, empty, empty, empty, "none")


def test_lines_share_all_tokens(docs_of):
    coder = attribution.encoder(attribution.ranks_path())
    rows = attribution.section_tokens(docs_of(TEXTS)).collect()
    for i, text in enumerate(TEXTS):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.section or 0)
        total = len(coder.spans(text)[0]) if text else 0
        assert sum(r.n_tokens for r in own) == total and not any(r.n_outside for r in own)
        assert "".join((text or "")[r.start : r.end] for r in own if r.section is not None) == (text or "")
    assert [(r.section, r.n_tokens) for r in rows if r.doc_id == 0] == [(None, 0.0)]


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows, clashing=True)
    rows = attribution.section_tokens(docs).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in odd_rows}
    assert sum(r.section in (0, None) for r in rows) == len(odd_rows)
    assert attribution.section_tokens(docs.limit(0)).count() == 0

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from haulmart.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


TEXTS = [
    None, "", " \t\r\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\ny\nx\n\n x\n",
    "# one | two <b> $5 & 6% *", "one two three four one two three five six one two",
    "tab\tand\x0bvertical\x0cfeed\rreturn kept kept", "é ü 𝔘 é ü 𝔘",
    " ".join(f"w{i}" for i in range(3000)), "spam " * 2000,
    " ".join(f"w{i % 70}" for i in range(400)),
]


def test_base_counts_equal_a_plain_count(docs_of):
    got = {r.doc_id: tuple(r)[1:7] for r in quality.assess(docs_of(TEXTS)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    ).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_sketch_bins_hold_their_numbers(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 4095, 4096, 123_456_789]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", quality.bin_of(F.col("v")).alias("b")
    ).select("v", "b", quality.value_of(F.col("b")).alias("top")).orderBy("v").collect()
    assert [r.b for r in rows] == sorted(r.b for r in rows)
    assert all(r.v <= r.top <= r.v + max(0, r.v // 32) for r in rows)


def test_limits_follow_each_source(docs_of):
    prose = " ".join(f"word{i}" for i in range(80))
    signs = " ".join(f"item{i} |" for i in range(80))
    rows = [(i, prose, "en", "plain") for i in range(300)] + [(i, signs, "en", "tables") for i in range(300, 600)]
    rows += [(600, signs, "en", "plain"), (601, signs, "en", "tables"), (602, prose, "en", "new")]
    kept = {r.doc_id for r in quality.assess(docs_of(rows)).filter("kept").collect()}
    assert 600 not in kept and {0, 299, 300, 601, 602} <= kept


def test_common_junk_does_not_widen_its_own_limit(docs_of):
    prose = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"item{i} |#|" for i in range(80))
    rows = [(i, prose, "en", f"s{i % 3}") for i in range(660)]
    # Half of one source, all of a large one, and a small source judged by the language.
    rows += [(1000 + i, junk if i % 2 else prose, "en", "mixed") for i in range(400)]
    rows += [(2000 + i, junk, "en", "spam") for i in range(700)]
    rows += [(3000, junk, "en", "small"), (3001, prose, "en", "small"), (3002, prose, "fr", "small"), (3003, junk, "fr", "small")]
    kept = {r.doc_id for r in quality.assess(docs_of(rows)).filter("kept").collect()}
    assert kept == {r[0] for r in rows if r[1] == prose}


def test_the_line_limit_can_be_reached(docs_of):
    head = " ".join(f"w{i}" for i in range(3000))
    lines = lambda n, same: "\n".join([head, *[f"line{i}" for i in range(n - same)], *["again"] * same])
    # A quarter of the documents repeat over an eighth of their lines.
    rows = [(i, lines(20, 7 if i % 3 == 0 else 0), "en", "s") for i in range(300)] + [(900, lines(400, 398), "en", "s")]
    kept = {r.doc_id for r in quality.assess(docs_of(rows)).filter("kept").collect()}
    assert kept == set(range(300))


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows_have_a_verdict(docs_of, odd_rows, clashing):
    docs = docs_of(odd_rows, clashing)
    assert quality.assess(docs).filter("kept is not null").count() == len(odd_rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 0


def test_empty_table(docs_of):
    assert quality.assess(docs_of([(1, "x", "en", "s")]).limit(0)).count() == 0


def test_documents_meet_few_limits_without_a_shuffle(spark, docs_of):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "256k")
    try:
        kept = quality.keep_good(docs_of([(i, TEXTS[-3], "en", f"src{i % 3}") for i in range(30)]))
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert kept.count() == 30
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan

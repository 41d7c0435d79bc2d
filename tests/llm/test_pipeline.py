import random

import corpus_pipeline
import sentencepiece
from haulmart.llm import leaks, pieces
from tests.llm.test_leaks import brute_distance
from tests.llm.test_quality import brute as brute_counts
from tests.llm.test_simhash import brute_components, brute_print


def corpus(rng):
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(40)) for i in range(4)]
    rows = [(i, prose(rng.randrange(60, 400)), "en", f"s{i % 3}") for i in range(260)]
    rows += [(300 + i, prose(20), "en", "s0") for i in range(10)]
    rows += [(320 + i, f"{prose(60)} {items[i % 4][1]} {prose(60)}", "en", "s1") for i in range(8)]
    rows += [(340 + i, rows[i][1], "en", "s2") for i in range(12)]
    rows += [(360 + i, f"{prose(70)} call me at user{i}@mail.org or 10.0.0.{i + 1}", "en", "s2") for i in range(6)]
    rows += [(380, None, None, None), (381, "", "en", "s1"), (382, "spam spam " * 300, "en", "s1")]
    return rows, items


def test_stages_equal_brute_force(spark, docs_of, tmp_path):
    rows, items = corpus(random.Random(11))
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    # Nothing here breaks a limit of its source, so the base rule alone decides.
    left = [r for r in rows if not brute_counts(r[1])[5]]
    roots = brute_components([brute_print(r[1]) for r in left])
    left = [r for i, r in enumerate(left) if roots[i] == i]
    passages = [leaks.letters(t) for _, t in items]
    left = [r for r in left if not any(
        brute_distance(p, leaks.letters(r[1])) <= leaks.edit_budget(len(p)) for p in passages)]
    assert set(got) == {r[0] for r in left} and {360, 365} <= set(got)

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for doc_id, text, lang, source in left:
        row = got[doc_id]
        assert (row.lang, row.source, row.n_chars) == (lang, source, len(row.text))
        if doc_id < 360:
            assert row.text == text
        else:
            assert "mail.org" not in row.text and row.text.split(" call me")[0] == text.split(" call me")[0]
        assert row.token_ids == library.encode(row.text) and row.n_tokens == len(row.token_ids)


def test_stages_keep_the_columns_of_documents(spark, docs_of, odd_rows, tmp_path):
    spark.createDataFrame([(0, "x" * 40)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    prose = " ".join(f"word{i}" for i in range(90))
    docs = docs_of([*odd_rows, (77, prose, None, "s")], clashing=True)
    for frame in (docs, docs.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, str(tmp_path))
            assert out.columns[: len(docs.columns)] == docs.columns or k == len(corpus_pipeline.STAGES) - 1
            assert set(docs.columns) <= set(out.columns)
            out.count()
            frame = frame if k == len(corpus_pipeline.STAGES) - 1 else out


def test_the_registered_pipeline_is_the_run():
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run

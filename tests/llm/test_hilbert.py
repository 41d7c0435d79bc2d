import zlib

import numpy as np
import pytest

from haulmart.llm import hilbert


@pytest.mark.parametrize("dims,depth", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_each_cell_once_and_steps_to_a_neighbour(dims, depth):
    cells = np.array(list(np.ndindex(*[1 << depth] * dims)))
    place = hilbert.curve_index(cells, depth)
    assert sorted(place.tolist()) == list(range(len(cells)))
    walked = cells[np.argsort(place)]
    assert (np.abs(np.diff(walked, axis=0)).sum(1) == 1).all()


def check(out, rows, shards):
    got = out.select("doc_id", "size", "text_crc32", "shard", "slot", "place").collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows), key=str
    )
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(shards)]
    assert all(slots == list(range(len(slots))) for slots in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert [r.shard for r in sorted(got, key=lambda r: r.place)] == sorted(r.shard for r in got)


def test_rows_law_with_a_hot_group(docs_of):
    rows = [(i, f"text {i % 7}", "en" if i % 3 else "de", f"s{i % 5}") for i in range(500)]
    rows += [(1000 + i, "hot copy", "en", "s0") for i in range(300)]
    check(hilbert.sharded(docs_of(rows)), rows, 8)


@pytest.mark.parametrize("shards", [1, 8, 30])
def test_odd_rows(docs_of, odd_rows, shards):
    docs = docs_of(odd_rows, clashing=True)
    check(hilbert.sharded(docs, shards), odd_rows, shards)


def test_files_have_narrow_ranges(spark, docs_of, tmp_path):
    rows = [(i, "x" * (i * 37 % 900), f"l{i % 4}", f"s{i * 7 % 16}") for i in range(4096)]
    docs = docs_of(rows)
    out = hilbert.sharded(docs, 64).selectExpr("shard", "row.lang AS lang", "row.source AS source", "size").toPandas()
    spread = out.groupby("shard").agg({"lang": "nunique", "source": "nunique", "size": np.ptp})
    assert spread["lang"].mean() < 3 and spread["source"].mean() < 10 and spread["size"].mean() < 700
    hilbert.write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 4096 and back.select("shard").distinct().count() == 8


def test_empty_table(docs_of):
    assert hilbert.sharded(docs_of([(1, "x", "en", "s")]).limit(0)).count() == 0


def test_sources_that_begin_alike_are_told_apart(docs_of):
    rows = [(i, "x" * (i % 50), "en", f"https://crawl.example/part-{i * 7 % 8}") for i in range(2048)]
    rows += [(5000 + i, "hot", "en", "https://crawl.example/part-3") for i in range(1024)]
    rows += [(9000, "none", "en", None), (9001, "empty", None, "")]
    out = hilbert.sharded(docs_of(rows), 32).selectExpr("shard", "row.source AS source").toPandas()
    assert out.groupby("shard")["source"].nunique().mean() <= 4


def test_string_cuts_are_exact_quantiles(spark):
    words = [f"common/{i * i % 97:03d}" for i in range(3000)] + ["common/050"] * 1500 + [None] * 40
    rows = spark.createDataFrame([(w,) for w in words], "w string").repartition(16)
    held = sorted(w for w in words if w is not None)
    want = sorted({held[-(-i * len(held) // 8) - 1] for i in range(1, 8)})
    assert hilbert._string_cuts(rows, ["w"], 3) == {"w": want}
    assert hilbert._string_cuts(rows.limit(0), ["w"], 3) == {"w": []}

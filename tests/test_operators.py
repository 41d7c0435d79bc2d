"""Verdicts, chains, keys and splits against brute force, also on forced hot keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from haulmart.operators import keys
from haulmart.operators.ordered import HIGHEST, before_each
from haulmart.operators.splitting import split
from haulmart.operators.verdict import Repeat, Rule, judge


def landing(seed, n=400):
    """A third of the rows share one key, some have none."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT" if rng.random() < 0.35 else rng.choice(["", "A", "B", "C", "D", "E"])
        rows.append((i, rng.randrange(20), key, rng.randrange(3)))
    return rows


def loop(rows, newest_first):
    seen, accepted, rejected = set(), [], []
    order = sorted(rows, key=lambda r: (r[1], r[0]), reverse=newest_first)
    for i, _, key, fault in order:
        if not key or key in seen:
            rejected.append((i, "deduplicate"))
        elif fault:
            rejected.append((i, f"rule_{fault}"))
        else:
            seen.add(key)
            accepted.append(i)
    return sorted(accepted), sorted(rejected)


@pytest.mark.parametrize("newest_first", [True, False])
@pytest.mark.parametrize("written", [False, True])
@pytest.mark.parametrize("partitions", [1, 37])
def test_first_accepted_wins(spark, tmp_path, newest_first, written, partitions):
    rows = landing(3)
    frame = spark.createDataFrame(
        rows, "id int, extracted_at int, key string, fault int").repartition(partitions)
    verdict = judge(
        frame, F.col("key"),
        [Rule(f"rule_{n}", F.col("fault") == n, "x", ("id",)) for n in (1, 2)],
        Repeat("again", ("id",)), newest_first=newest_first,
    )
    if written:
        def keep(rows, name):
            rows.write.parquet(str(tmp_path / name))
            return spark.read.parquet(str(tmp_path / name))

        verdict = verdict.settled(keep)
    accepted = sorted(r.id for r in verdict.accepted().collect())
    rejected = sorted(
        (int(r.id), r.rule)
        for r in verdict.rejected().withColumn("id", F.get_json_object("raw_payload", "$.id"))
        .collect())
    assert (accepted, rejected) == loop(rows, newest_first)


def test_positions_are_not_written(spark):
    rows = spark.createDataFrame([(1, 5, "A"), (2, None, "A"), (3, 4, "")], "id int, extracted_at int, key string")
    verdict, names = judge(rows, F.col("key"), [], Repeat("again", ("id",))), []

    def keep(rows, name):
        names.append(rows.columns)
        return rows.localCheckpoint()

    settled = verdict.settled(keep)
    assert names == [["id", "extracted_at", "key", "_key", "_own"]]
    # A missing value sorts after all others.
    assert [r.id for r in settled.accepted().collect()] == [2]


def chain_rows(seed, n=500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        plate = "HOT" if rng.random() < 0.4 else rng.choice(["", "P1", "P2", "P3"])
        rows.append((i, plate, rng.choice([None, "a", "b"]),
                     None if rng.random() < 0.1 else rng.randrange(40),
                     None if rng.random() < 0.2 else rng.randrange(1000)))
    return rows


@pytest.mark.parametrize("hot_rows", [1, 20, 10**6])
@pytest.mark.parametrize("kind", ["last", "highest"])
def test_value_before_each_row(spark, hot_rows, kind):
    rows = chain_rows(5)
    expected, last = {}, {}
    first = lambda x: (x is not None, x or 0)  # noqa: E731  nulls come first
    for i, plate, raw, t, value in sorted(
        rows, key=lambda r: (r[2] is not None, r[2] or "", *first(r[3]), r[0])
    ):
        expected[i] = last.get(plate) if plate else None
        if plate and value is not None:
            last[plate] = value if kind == "last" else max(value, last.get(plate, value))
    frame = spark.createDataFrame(rows, "id int, plate string, raw string, t int, value int")
    buckets = ({"_raw": F.col("raw"), "_coarse": F.floor(F.col("t") / 10)},
               {"_fine": F.col("t"), "_chunk": F.floor(F.col("id") / 5)})
    options = {"carry": HIGHEST} if kind == "highest" else {}
    out = before_each(frame, "plate", "value", ("raw", "t", "id"), buckets, "before",
                      hot_rows=hot_rows, **options)
    assert {r.id: r.before for r in out.collect()} == expected


def test_numbering_is_dense_and_stable(spark):
    frame = spark.createDataFrame([(f"K{i}",) for i in range(500)], "code string")
    one = {r.code: r.n for r in keys.number_rows(frame.repartition(1), "code", "n").collect()}
    many = {r.code: r.n for r in keys.number_rows(frame.repartition(31), "code", "n").collect()}
    assert one == many and sorted(one.values()) == list(range(1, 501))


def test_upsert_keeps_keys(spark):
    old = spark.createDataFrame([(1, "A", "x"), (2, "B", "y")], "k bigint, code string, v string")
    new = spark.createDataFrame([("B", None), ("C", "z")], "code string, v string")
    out = {r.code: (r.k, r.v) for r in keys.upsert(old, new, "k", "code", ["v"], 2).collect()}
    assert out == {"A": (1, "x"), "B": (2, None), "C": (3, "z")}


def test_split_is_exact_and_repeatable(spark):
    frame = spark.createDataFrame(
        [(f"F{i}", int(i % 3 == 0)) for i in range(3000)], "folio string, late int")
    first = split(frame.repartition(1), "folio", 0.2, 42, "late")
    again = split(frame.repartition(23), "folio", 0.2, 42, "late")
    sizes = {(r.late, r.is_test): r["count"] for r in
             first.groupBy("late", "is_test").count().collect()}
    assert sizes[1, True] == math.ceil(1000 * 0.2) and sizes[0, True] == math.ceil(2000 * 0.2)
    assert sum(sizes.values()) == 3000
    chosen = lambda f: {r.folio for r in f.filter("is_test").collect()}
    assert chosen(first) == chosen(again)
    other = split(frame, "folio", 0.2, 43, "late")
    assert chosen(other) != chosen(first)


def test_readers_of_some_parts_of_a_record_carry_no_payload(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5, "long text"), (2, "a", 6, "long text"), (3, "b", -1, "long text"), (4, "", 1, "")],
        "id long, code string, n int, text string",
    )
    verdict = judge(
        rows, F.col("code"), [Rule("positive", F.col("n") <= 0, "not positive", ("code", "text"))],
        Repeat("repeated", ("code", "text")), order=("id",),
    )
    whole = {(r.source_pk, r.rule): r.raw_payload for r in verdict.rejected().collect()}
    assert whole.keys() == {("a", "deduplicate"), ("b", "positive"), ("", "deduplicate")}
    assert whole["b", "positive"] == '{"code":"b","text":"long text"}'
    some = verdict.rejected().select("source_pk", "rule")
    assert {tuple(r) for r in some.collect()} == whole.keys()
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "text#" not in plan.split("Join")[-1].split("LogicalRDD")[0]

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmart.llm import negatives

SCHEMA = "id long, label long, vector array<double>"


def brute(rows, step, positives=5, k=10, low=30, high=90):
    out = []
    for a, (i, label, v) in enumerate(rows):
        if i % step:
            continue
        score = [(-sum(int(x) * int(y) for x, y in zip(v, w)), j, b) for b, (j, _, w) in enumerate(rows) if b != a]
        near = sorted(s for s in score if rows[s[2]][1] == label)[:positives]
        for p, pid, _ in near:
            fits = sorted(s for s in score if rows[s[2]][1] != label and low * -p <= -100 * s[0] <= high * -p)[:k]
            out += [(i, pid, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(fits)]
    return sorted(out)


def made(rng, n, width=6, labels=4, spread=40):
    centres = [[rng.randrange(-spread, spread) for _ in range(width)] for _ in range(labels)]
    return [
        (i, label, [float(c + rng.randrange(-9, 10)) for c in centres[label]])
        for i in range(n) for label in [rng.randrange(labels)]
    ]


def answered(spark, rows, step, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = negatives.hard_negatives(frame, F.col("id") % step == 0, **settings)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("leaf_rows", [12, 40, 4096])
def test_equals_comparing_everything(spark, leaf_rows):
    rng = random.Random(leaf_rows)
    rows = made(rng, 400)
    # A crowd of equal vectors, and ties on the score.
    rows += [(1000 + i, i % 2, rows[3][2]) for i in range(120)]
    assert answered(spark, rows, 20, leaf_rows=leaf_rows, sample_rows=256) == brute(rows, 20)


def test_the_tree_leaves_subtrees_out():
    rng = np.random.default_rng(1)
    rows = np.round(rng.normal(size=(3000, 5)) * 200)
    square = float((rows * rows).sum(1).max())
    tree = negatives.fit_tree(rows, square, len(rows), fanout=8, leaf_rows=60)
    for number, at, apart, nearest in tree.walk(rows):
        for j in np.unique(nearest):
            held = tree.nodes[number].ranges[:, j]
            held[:, 0], held[:, 1] = apart[nearest == j].min(0), apart[nearest == j].max(0)
    leaf = tree.leaf_of(rows)
    assert tree.leaves > 8 and set(leaf.tolist()) <= set(range(tree.leaves))
    visited = 0
    for anchor in rows[::100]:
        scores = rows @ anchor
        best = np.sort(scores)[-10]
        found = {l for l, _ in tree.surviving(anchor, np.array([best]), np.array([scores.max()]))}
        assert set(leaf[scores >= best].tolist()) <= found
        visited += len(found)
    assert visited < 0.8 * 30 * tree.leaves


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    raw = [
        (0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.3]), (2, 2, [0.4, 0.1]), (3, None, [0.5, 0.5]), (4, 1, None),
        (5, 1, [0.5, None]), (6, 2, [nan, 0.1]), (7, 2, [inf, 0.1]), (None, 2, [0.4, 0.1]), (8, 2, []),
        (9, 2, [0.4]), (10, 2, [0.4, 0.1, 0.0]), (1, 1, [0.5, 0.3]),
    ]
    frame = spark.createDataFrame(raw, "id long, label long, embedding array<float>")
    frame = frame.withColumn("vector", negatives.whole_vector(F.col("embedding"))).withColumn("row", F.lit("x")).withColumn("leaf", F.lit(1))
    got = sorted(tuple(r) for r in negatives.hard_negatives(frame, F.col("id") == 0).collect())
    whole = [(i, l, [float(np.floor(256 * np.float64(np.float32(x)))) for x in v] + [0.0] * (3 - len(v))) for i, l, v in raw
             if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert got == brute(whole, 1_000_000) and len({g[3] for g in got}) == 3
    assert negatives.hard_negatives(frame.limit(0), F.col("id") == 0).count() == 0
    assert negatives.hard_negatives(frame, F.lit(False)).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    big = float(1 << 29)
    rows = [(0, 0, [big, 3.0]), (1, 0, [big, 1.0]), (2, 1, [big // 2, 7.0]), (3, 1, [big // 2, 8.0])]
    assert answered(spark, rows, 100) == brute(rows, 100)
    with pytest.raises(ValueError):
        answered(spark, [(0, 0, [float(1 << 40)])], 1)

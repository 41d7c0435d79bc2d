"""Hard negatives found through a tree of nearest split points with distance ranges.

Vectors are lifted onto a sphere by one more component, so that the distance
from an anchor to a row depends on their inner product alone: a window of
scores is an annulus around the anchor. Each node of the tree has several split
points; a row belongs to the subtree of the nearest. For every split point and
every sibling subtree the least and the greatest distance between them are
kept, over all rows. A subtree is left out when, by some split point's range,
none of its rows can lie in any annulus of the anchor.

The tree is fitted on a bounded sample of rows; every row is dealt to a leaf,
every range covers all rows, and leaves are searched exactly, so the result is
that of comparing everything. The sample also narrows the windows first: the
k-th best of its rows that fits bounds what can still come.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.shared import keep

# Rows that the tree is fitted on, first by a hash of the row.
SAMPLE = 4096
# Split points of a node.
FANOUT = 12
# Rows that a leaf should hold; leaves are at most SAMPLE / FANOUT of them.
LEAF_ROWS = 4096
# Rows and anchors that are compared at a time, and anchors that descend the tree at a time.
BLOCK_ROWS = 4096
BLOCK_ANCHORS = 1024
AT_ONCE = 256
# Exact limits of doubles and longs.
EXACT_DOUBLE = 1 << 53
EXACT_LONG = 1 << 63
FAR = 1 << 62


def whole_vector(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * component), as doubles; null if any component is null or not finite."""
    sound = vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    return F.when(sound, whole)


# --- the tree ---------------------------------------------------------------


@dataclass
class Node:
    """Split points (lifted), the subtree of each, and ranges[i, j] = distances from i to subtree j."""

    points: np.ndarray
    children: list[int]
    ranges: np.ndarray


@dataclass
class Tree:
    """Nodes from the root on; a child below zero is leaf ``-child - 1``."""

    nodes: list[Node]
    leaves: int
    square: float

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.square - (rows * rows).sum(1), 0.0)
        return np.c_[rows, np.sqrt(rest)]

    def apart(self, node: Node, lifted: np.ndarray) -> np.ndarray:
        """Distances from lifted rows to a node's split points."""
        return np.sqrt(np.maximum(2 * self.square - 2 * (lifted @ node.points.T), 0.0))

    def walk(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, positions of rows there, their distances, their subtree) of every node reached."""
        lifted = self.lifted(rows)
        waiting = [(0, np.arange(len(rows)))] if self.nodes and len(rows) else []
        while waiting:
            number, at = waiting.pop()
            node = self.nodes[number]
            apart = self.apart(node, lifted[at])
            nearest = apart.argmin(1)
            yield number, at, apart, nearest
            for j, child in enumerate(node.children):
                here = at[nearest == j]
                if child >= 0 and len(here):
                    waiting.append((child, here))

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(rows), np.int64)
        for number, at, _, nearest in self.walk(rows):
            children = np.array(self.nodes[number].children)[nearest]
            leaf[at[children < 0]] = -children[children < 0] - 1
        return leaf

    def surviving(self, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, which windows) that may hold rows scoring within [lo, hi] for an anchor."""
        if not self.nodes:
            yield 0, np.ones(len(lo), bool)
            return
        own = float(anchor @ anchor)
        # Room for rounding, far above the error of the roots.
        slack = 1e-6 * np.sqrt(self.square + own) + 1e-9
        inner = np.sqrt(np.maximum(own + self.square - 2.0 * hi, 0.0)) - slack
        outer = np.sqrt(np.maximum(own + self.square - 2.0 * lo, 0.0)) + slack
        flat = np.r_[anchor, 0.0]
        waiting = [(0, np.ones(len(lo), bool))]
        while waiting:
            number, open_ = waiting.pop()
            node = self.nodes[number]
            apart = np.sqrt(np.maximum(own + self.square - 2 * (node.points @ flat), 0.0))[:, None]
            low, high = node.ranges[..., 0], node.ranges[..., 1]
            # By the triangle with each split point, how near and far a subtree's rows can be.
            near = np.maximum(low - apart, apart - high).max(0)
            far = (high + apart).min(0)
            for j, child in enumerate(node.children):
                left = open_ & (near[j] <= outer) & (far[j] >= inner)
                if left.any():
                    if child < 0:
                        yield -child - 1, left
                    else:
                        waiting.append((child, left))


def _apart_points(lifted: np.ndarray, fanout: int) -> np.ndarray:
    """Positions of up to ``fanout`` rows far from one another; equal rows count once."""
    chosen = [0]
    gap = ((lifted - lifted[0]) ** 2).sum(1)
    while len(chosen) < fanout:
        at = int(gap.argmax())
        if gap[at] <= 1e-9:
            break
        chosen.append(at)
        gap = np.minimum(gap, ((lifted - lifted[at]) ** 2).sum(1))
    return np.array(chosen)


def fit_tree(sample: np.ndarray, square: float, rows: int, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree of split points for ``rows`` rows of which ``sample`` are some; ranges are open."""
    tree = Tree([], 1, square)
    if not len(sample) or rows <= leaf_rows:
        return tree
    lifted, share = tree.lifted(sample), rows / len(sample)
    tree.leaves = 0

    def grow(at: np.ndarray) -> int:
        split = len(at) * share > leaf_rows and len(at) >= 2 * fanout
        chosen = at[_apart_points(lifted[at], fanout)] if split else at[:1]
        if len(chosen) < 2:
            tree.leaves += 1
            return -tree.leaves
        number = len(tree.nodes)
        node = Node(lifted[chosen], [], np.full((len(chosen), len(chosen), 2), (np.inf, -np.inf)))
        tree.nodes.append(node)
        nearest = tree.apart(node, lifted[at]).argmin(1)
        node.children = [grow(at[nearest == j]) for j in range(len(chosen))]
        return number

    root = grow(np.arange(len(sample)))
    if root < 0:
        tree.leaves = 1
    return tree


# --- the index --------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


@dataclass(frozen=True)
class Index:
    """Rows dealt to leaves and blocks, the tree, and the sample that it was fitted on."""

    rows: DataFrame
    blocks: DataFrame
    tree: Tree
    sample: dict[str, np.ndarray]
    width: int
    exact: type


def _ranges(routed: DataFrame, tree: Tree, width: int) -> None:
    """Fill the tree's ranges from all rows, combined in each batch and then once."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for number, _, apart, nearest in tree.walk(_matrix(batch.column(0), width)):
                for j in np.unique(nearest).tolist():
                    low, high = apart[nearest == j].min(0), apart[nearest == j].max(0)
                    out += [(number, i, j, a, b) for i, (a, b) in enumerate(zip(low.tolist(), high.tolist()))]
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(out, columns=["node", "i", "j", "low", "high"]).astype(
                    {"node": "int32", "i": "int32", "j": "int32", "low": "float64", "high": "float64"}
                ),
                preserve_index=False,
            )

    found = routed.select("vector").mapInArrow(spans, "node int, i int, j int, low double, high double")
    # At most SAMPLE split points times FANOUT.
    for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.nodes[r["node"]].ranges[r["i"], r["j"]] = r["low"], r["high"]


def build(rows: DataFrame, sample_rows: int = SAMPLE, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Index:
    """Index rows (id long, label long, vector array<double> of whole numbers), none of them null.

    Vectors shorter than the longest count as ending in zeros. Scores that do
    not fit a long are an error.
    """
    rows = keep(rows.select("id", "label", "vector").withColumn("row", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    largest = F.array_max(F.transform("vector", F.abs))
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
        F.max(square).alias("square"), F.max(largest).alias("largest"),
    ).first()
    width, bound = seen["width"] or 0, int(seen["largest"] or 0) ** 2 * max(seen["width"] or 0, 1)
    if bound >= EXACT_LONG:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    first = rows.orderBy(F.xxhash64("row"), "row").limit(sample_rows).toArrow()
    sample = {
        "vector": _matrix(first.column("vector"), width),
        **{c: first.column(c).to_numpy() for c in ("id", "label", "row")},
    }
    tree = fit_tree(sample["vector"], float(seen["square"] or 0.0), seen["n"], fanout, leaf_rows)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.leaf_of(_matrix(batch.column("vector"), width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], [*batch.schema.names, "leaf"])

    routed = keep(
        rows.mapInArrow(leaves, "id long, label long, vector array<double>, row long, leaf long"), "routed"
    )
    _ranges(routed, tree, width)
    # A row per leaf; a crowded leaf is cut into blocks by a hash.
    blocks = keep(
        routed.groupBy(F.col("leaf").alias("of_leaf")).agg(
            F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).alias("n_blocks")
        ),
        "leaves",
    )
    exact = np.float64 if bound < EXACT_DOUBLE else np.int64
    return Index(routed, blocks, tree, sample, width, exact)


# --- the search -------------------------------------------------------------

WINDOWS = "array<struct<tag:long,lo:long,hi:long>>"
FOUND = "anchor long, tag long, row long, id long, score long"


def _best(scores: np.ndarray, fits: np.ndarray, lo: int, hi: int, k: int) -> np.ndarray:
    """Positions of the k best that fit a window; rows are in the order that decides ties."""
    at = np.flatnonzero(fits & (scores >= lo) & (scores <= hi))
    if len(at) > k:
        edge = -np.partition(-scores[at], k - 1)[k - 1]
        at = at[scores[at] >= edge]
    return at[np.argsort(-scores[at], kind="stable")][:k]


def search(index: Index, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The ``k`` best other rows of each window of each anchor: anchor, tag, row, id, score.

    ``anchors`` has row, label, vector and windows (tag, lo, hi of scores).
    Higher scores come first, then smaller ids, then rows as they were
    written. Anchors go, in chunks, to the blocks of the leaves that survive.
    """
    tree, sample, width, exact = index.tree, index.sample, index.width, index.exact
    order = np.lexsort((sample["row"], sample["id"]))
    known = sample["vector"][order].astype(exact)
    known_label, known_row = sample["label"][order], sample["row"][order]

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, AT_ONCE) for b in batches for i in range(0, b.num_rows, AT_ONCE)):
            vectors = _matrix(batch.column("vector"), width)
            scores = (vectors.astype(exact) @ known.T).astype(np.int64)
            labels, own = batch.column("label").to_pylist(), batch.column("row").to_pylist()
            taken, leaf, left = [], [], []
            for i, windows in enumerate(batch.column("windows").to_pylist()):
                fits = (known_label == labels[i]) == same_label
                fits &= known_row != own[i]
                for w in windows:
                    best = _best(scores[i], fits, w["lo"], w["hi"], k)
                    if len(best) == k:
                        w["lo"] = int(scores[i][best[-1]])
                lo, hi = (np.array([w[c] for w in windows], np.float64) for c in ("lo", "hi"))
                for number, open_ in tree.surviving(vectors[i], lo, hi):
                    taken.append(i)
                    leaf.append(number)
                    left.append([w for w, there in zip(windows, open_.tolist()) if there])
            chosen = batch.take(pa.array(taken, pa.int64()))
            kind = pa.list_(pa.struct([("tag", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    chosen.column("row"), chosen.column("label"), chosen.column("vector"),
                    pa.array(left, kind), pa.array(leaf, pa.int64()),
                ],
                ["anchor", "anchor_label", "anchor_vector", "windows", "leaf"],
            )

    asked = anchors.filter(F.size("windows") > 0).select("row", "label", "vector", "windows")
    n_chunks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    sent = asked.mapInArrow(
        narrowed, f"anchor long, anchor_label long, anchor_vector array<double>, windows {WINDOWS}, leaf long"
    ).join(F.broadcast(index.blocks), F.col("leaf") == F.col("of_leaf"))
    sent = sent.select(
        "anchor", "anchor_label", "anchor_vector", "windows", "leaf",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("anchor"), F.lit(n_chunks)).alias("chunk"),
    )
    held = index.rows.join(F.broadcast(index.blocks), F.col("leaf") == F.col("of_leaf")).select(
        "id", "label", "vector", "row", "leaf",
        F.pmod(F.xxhash64("row"), F.col("n_blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))).alias("chunk"),
    )

    def compare(asking: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asking) and len(rows):
            ids, own = rows.column("id").to_numpy(), rows.column("row").to_numpy()
            order = np.lexsort((own, ids))
            ids, own, labels = ids[order], own[order], rows.column("label").to_numpy()[order]
            there = _matrix(rows.column("vector"), width)[order].astype(exact)
            scores = (_matrix(asking.column("anchor_vector"), width).astype(exact) @ there.T).astype(np.int64)
            columns = (asking.column(c).to_pylist() for c in ("anchor", "anchor_label", "windows"))
            for i, (anchor, label, windows) in enumerate(zip(*columns)):
                fits = ((labels == label) == same_label) & (own != anchor)
                for w in windows:
                    best = _best(scores[i], fits, w["lo"], w["hi"], k)
                    out += zip(
                        [anchor] * len(best), [w["tag"]] * len(best),
                        own[best].tolist(), ids[best].tolist(), scores[i][best].tolist(),
                    )
        columns = list(zip(*out)) or [()] * 5
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("anchor", "tag", "row", "id", "score"), columns)})

    unit = ("leaf", "block", "chunk")
    found = sent.groupBy(*unit).cogroup(held.groupBy(*unit)).applyInArrow(compare, FOUND)
    # At most k rows of each block; a rank limited to k is applied before the shuffle too.
    best = Window.partitionBy("anchor", "tag").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has id, label and vector (whole numbers); a row with any of them
    null takes no part. ``is_anchor`` is a condition on id and label. An
    anchor's positives are its best other rows of its label. A negative has
    another label and scores from ``low`` to ``high`` hundredths of the
    positive. Rows that are repeated take part each, so an anchor given twice
    is answered twice. Without anchors, positives or negatives there are no rows.
    """
    sound = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    index = build(
        sound.select(F.col("id").cast("long"), F.col("label").cast("long"), "vector"), sample_rows,
        leaf_rows=leaf_rows,
    )
    anchors = keep(index.rows.filter(is_anchor).select("row", "id", "label", "vector"), "anchors")
    everything = F.array(F.struct(
        F.lit(0).cast("long").alias("tag"), F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi")
    ))
    near = keep(
        search(index, anchors.withColumn("windows", everything), positives, same_label=True), "positives"
    )
    # The window's ends as whole numbers: the floor of a quotient, and minus that of its negative.
    hundredth = F.col("score").cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")
    low_end, high_end = -F.floor(hundredth * -low), F.floor(hundredth * high)
    window = F.struct(
        F.col("row").alias("tag"), low_end.cast("long").alias("lo"), high_end.cast("long").alias("hi")
    )
    windows = near.groupBy(F.col("anchor").alias("of_anchor")).agg(
        F.filter(F.collect_list(window), lambda w: w["lo"] <= w["hi"]).alias("windows")
    )
    asked = anchors.join(windows, F.col("row") == F.col("of_anchor"))
    far = search(index, asked.select("row", "label", "vector", "windows"), negatives, same_label=False)
    pairs = near.select(
        F.col("anchor").alias("of_anchor"), F.col("row").alias("of_tag"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    met = far.join(pairs, (F.col("anchor") == F.col("of_anchor")) & (F.col("tag") == F.col("of_tag")))
    named = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return met.join(named, F.col("anchor") == F.col("anchor_row")).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )

"""Near-duplicates by SimHash, found by meeting in the middle of two balls.

Two fingerprints within ``RADIUS`` bits have a common variant within half of
that of each. So every distinct fingerprint emits the variants of its half
ball, variants meet in a shuffle, and equal ones tell of a pair. The shuffle is
on the leading bits of the variant: a fingerprint is sent once per way of
changing those bits, with the changes it has left, and the rest of its ball
unfolds inside the task. That moves a few dozen rows for a fingerprint in place
of two thousand.

All members of one bucket lie within half the radius of its variant, so any two
of them are within the radius. A bucket is kept as a star, never as all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from haulmart.llm.graph import components
from haulmart.llm.shared import keep, unpack, whole_row

BITS = 64
SHINGLE = 4
SEED = 42
RADIUS = 4
# Variants of one group of the shuffle, about, and those that unfold in a worker's
# memory at a time: sorting and matching them takes some 80 bytes each.
AT_ONCE = 4_000_000
PIECE = 1_000_000


def fingerprint(text: str | None) -> int:
    """A bit is set where over half of the shingles' hashes set it; no words: zero.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at the six ASCII
    white characters, as the definition of a word wants.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - SHINGLE] + 1).tolist()]
    ends = [*gaps[SHINGLE - 1 :].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts)
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    over = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(i) for i in over)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")


def half_ball(width: int, changes: int) -> np.ndarray:
    """Masks of at most ``changes`` of the ``width`` low bits."""
    return np.array(
        [
            sum(1 << i for i in chosen)
            for k in range(changes + 1)
            for chosen in combinations(range(width), k)
        ],
        np.uint64,
    )


class _Forest:
    """Union-find over the positions of one bucket group."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _unfold(prints: np.ndarray, left: np.ndarray, at: np.ndarray, width: int, forest: _Forest,
            links: list[tuple[int, int]], at_once: int) -> None:
    """Link the positions ``at`` whose half balls meet on the ``width`` low bits.

    ``left`` is how many bits each may still change. A group whose variants are
    too many for one piece is cut by its next bits and each part worked on alone.
    """
    sizes = {k: sum(math.comb(width, i) for i in range(k + 1)) for k in np.unique(left).tolist()}
    total = sum(int((left == k).sum()) * n for k, n in sizes.items())
    if total > at_once and width > 4 and len(prints) > 1:
        lower = width - 4
        head = (prints >> np.uint64(lower)) & np.uint64(15)
        for value in range(16):
            spent = np.bitwise_count(head ^ np.uint64(value)).astype(left.dtype)
            here = spent <= left
            if here.sum() > 1:
                _unfold(prints[here], (left - spent)[here], at[here], lower, forest, links, at_once)
        return
    low = prints & np.uint64((1 << width) - 1)
    variants, owners = [], []
    for k in sizes:
        own = left == k
        masks = half_ball(width, k)
        variants.append((low[own][:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(at[own], len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    ordered = np.sort(variant)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    place = np.searchsorted(twice, variant)
    place[place == len(twice)] = 0
    hit = twice[place] == variant
    place, owner = place[hit], owner[hit]
    order = np.lexsort((owner, place))
    place, owner = place[order], owner[order]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    least = np.repeat(owner[first], np.diff(np.r_[first, len(place)]))
    pairs = np.unique(np.stack([least, owner], 1)[least != owner], axis=0)
    for i, j in pairs.tolist():
        if forest.join(i, j):
            links.append((i, j))


def _meet(group: pd.DataFrame, width: int, radius: int, at_once: int) -> pd.DataFrame:
    """Links between the fingerprints of one variant prefix, verified by their distance."""
    prints = group["print"].to_numpy().astype(np.int64).view(np.uint64)
    links: list[tuple[int, int]] = []
    if len(prints) > 1:
        left = group["left"].to_numpy().astype(np.int8)
        forest, piece = _Forest(len(prints)), min(at_once, PIECE)
        _unfold(prints, left, np.arange(len(prints)), width, forest, links, piece)
    pairs = np.array(links, np.int64).reshape(-1, 2)
    a, b = prints[pairs[:, 0]], prints[pairs[:, 1]]
    near = np.bitwise_count(a ^ b) <= radius
    return pd.DataFrame({"a": a[near].view(np.int64), "b": b[near].view(np.int64)})


def links(prints: DataFrame, radius: int = RADIUS, at_once: int = AT_ONCE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, each within ``radius`` bits.

    Every two fingerprints within the radius are connected by the pairs, not
    each of them by a pair of its own. ``prints`` has distinct longs in ``print``.
    The prefix is as long as gives a group of even size ``at_once`` variants. The
    radius is even, as members of a bucket are then within it of each other.
    """
    if radius % 2:
        raise ValueError(f"half of the radius must be a whole number, not that of {radius}")
    half = radius // 2
    ball = sum(math.comb(BITS, k) for k in range(half + 1))
    prefix = max(4, math.ceil(math.log2(max(2, prints.count() * ball / at_once))))
    width = BITS - prefix
    ways = F.array(*[
        F.struct(
            F.lit(_signed(int(m) << width)).alias("mask"),
            F.lit(half - int(m).bit_count()).alias("left"),
        )
        for m in half_ball(prefix, half).tolist()
    ])
    sent = prints.select("print", F.explode(ways).alias("way")).select(
        "print",
        F.shiftrightunsigned(F.col("print").bitwiseXOR(F.col("way.mask")), width).alias("prefix"),
        F.col("way.left").alias("left"),
    )
    return sent.groupBy("prefix").applyInPandas(
        lambda group: _meet(group, width, radius, at_once), "a long, b long"
    )


def classes(rows: DataFrame) -> DataFrame:
    """(class_print, component_id) of the distinct fingerprints of ``rows``.

    ``rows`` has doc_id and print. Rows with one fingerprint are one node with
    their least doc_id, by a map-side combined minimum, so thousands of copies
    shrink before they are shuffled. ``component_id`` is the least doc_id
    reachable (null only where all of them are null).
    """
    nodes = keep(rows.groupBy("print").agg(F.min("doc_id").alias("least_id")), "prints")
    member = components(links(nodes.select("print")))
    rooted = nodes.join(member, F.col("print") == F.col("node"), "left").select(
        F.col("print").alias("class_print"), "least_id", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy(F.col("root").alias("of_root")).agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, F.col("root") == F.col("of_root")).select("class_print", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Null and empty texts have the fingerprint zero and are linked like any
    other; repeated rows come out repeated.
    """
    prints = keep(docs.select("doc_id", fingerprint_of("text").alias("print")), "fingerprints")
    return prints.join(classes(prints), F.col("print") == F.col("class_print")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: that of the least doc_id, null ids last.

    Of rows that tie, the first as written to the shared folder stays.
    """
    columns = docs.columns
    rows = docs.select(whole_row(docs), "doc_id", fingerprint_of("text").alias("print"))
    rows = keep(rows.withColumn("at", F.monotonically_increasing_id()), "fingerprinted")
    narrow = rows.select("doc_id", "print", "at")
    found = narrow.join(classes(narrow), F.col("print") == F.col("class_print"))
    # All null ids of the data are one component's id only if it has no other.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("print")))
    chosen = found.groupBy(group.alias("of")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at"))["at"].alias("stays")
    )
    return unpack(rows.join(chosen, F.col("at") == F.col("stays"), "left_semi"), columns)

"""Benchmark passages inside documents, by the q-gram lemma and banded alignment.

A passage of m letters that occurs with at most k edits shares at least
m + 1 - q (k + 1) of its q-grams with the document, all on diagonals (document
place minus passage place) at most k apart. Shared q-grams are counted in bands
of 2 (k + 1) diagonals that overlap by half, so every such spread falls whole
into some band. A band that meets the bound is verified by an alignment
confined to its diagonals.

Both sides are compared as lower-case UTF-8 without ASCII white space and
punctuation, so shouting, line breaks and decoration do not hide a passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from haulmart.llm.shared import keep, unpack, whole_row

Q = 8
# Share of a passage's letters that may be edited.
EDITS = 0.1
# Letters of one block of the benchmark; its index is some 50 bytes a letter.
BLOCK = 1_000_000
# Document letters worked on at a time.
AT_ONCE = 1 << 20
_DROPPED = bytes(c for c in range(128) if not chr(c).isalnum())
_MIX = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, _DROPPED)


def edit_budget(m: int) -> int:
    """Edits allowed in m letters: a tenth, and no more than leave one q-gram whole."""
    return min(int(m * EDITS), (m - Q) // Q) if m >= Q else -1


def _grams(data: np.ndarray) -> np.ndarray:
    """The q letters at every place as one number."""
    return np.ndarray((max(0, len(data) - Q + 1),), "<u8", data, strides=(1,))


@dataclass(frozen=True)
class Index:
    """The q-grams of a block of passages, sorted, with a bit table in front."""

    items: tuple
    texts: tuple
    budget: np.ndarray
    bound: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    shift: np.uint64


def index(block: list[tuple[int | None, bytes]]) -> Index:
    budget = np.array([edit_budget(len(t)) for _, t in block], np.int64)
    bound = np.array([len(t) for _, t in block], np.int64) + 1 - Q * (budget + 1)
    codes = [_grams(np.frombuffer(t, np.uint8)) for _, t in block]
    item = np.repeat(np.arange(len(block)), [len(c) for c in codes])
    place = np.concatenate([np.arange(len(c)) for c in codes])
    codes = np.concatenate(codes).astype(np.uint64)
    order = np.argsort(codes, kind="stable")
    found, first = np.unique(codes[order], return_index=True)
    bits = max(16, int(len(found)).bit_length() + 5)
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[(found * _MIX) >> shift] = True
    return Index(
        tuple(i for i, _ in block), tuple(t for _, t in block), budget, bound, found,
        np.r_[first, len(codes)], item[order], place[order], table, shift,
    )


def aligned(passage: bytes, regions: np.ndarray, k: int) -> np.ndarray:
    """Least edits of the whole passage in each region, its ends free there.

    ``regions`` has a row of len(passage) + width letters each. Cell c of row i
    stands for region place i + c, so a row holds one band of diagonals. Values
    over k only say that there are more.
    """
    m = len(passage)
    width = regions.shape[1] - m
    steps = np.arange(width + 1, dtype=np.int32)
    cost = np.zeros((len(regions), width + 1), np.int32)
    for i, letter in enumerate(passage):
        turn = cost + (regions[:, i : i + width + 1] != letter)
        turn[:, :-1] = np.minimum(turn[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(turn - steps, axis=1) + steps
        if not (cost <= k).any():
            break
    return cost.min(axis=1)


def _search(joined: np.ndarray, ends: np.ndarray, ix: Index) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, edits, shared q-grams) of the documents joined with zero bytes."""
    grams, places = _grams(joined), []
    for at in range(0, len(grams), AT_ONCE):
        part = grams[at : at + AT_ONCE]
        places.append(np.flatnonzero(ix.table[(part * _MIX) >> ix.shift]) + at)
    places = np.concatenate(places) if places else np.empty(0, np.int64)
    codes = grams[places]
    row = np.searchsorted(ix.codes, codes)
    row[row == len(ix.codes)] = 0
    real = ix.codes[row] == codes
    places, row = places[real], row[real]
    if not len(places):
        return
    many = ix.starts[row + 1] - ix.starts[row]
    doc_place = np.repeat(places, many)
    offset = np.arange(len(doc_place)) - np.repeat(np.cumsum(many) - many, many)
    entry = np.repeat(ix.starts[row], many) + offset
    item = ix.item[entry]
    doc = np.searchsorted(ends, doc_place, side="right")
    begin = np.r_[0, ends[:-1] + 1][doc]
    lengths = np.array([len(t) for t in ix.texts], np.int64)
    # At least 0: the passage may begin before the document does.
    diagonal = doc_place - begin - ix.place[entry] + lengths[item]
    half = ix.budget[item] + 1
    band = diagonal // half
    doc, item, band = (np.concatenate([x, y]) for x, y in ((doc, doc), (item, item), (band, band - 1)))
    order = np.lexsort((band, item, doc))
    doc, item, band = doc[order], item[order], band[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])]
    first = np.flatnonzero(new)
    shared = np.diff(np.r_[first, len(doc)])
    enough = shared >= ix.bound[item[first]]
    first, shared = first[enough], shared[enough]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for i in np.unique(item[first]).tolist():
        passage, k = ix.texts[i], int(ix.budget[i])
        own = item[first] == i
        docs, counts = doc[first][own], shared[own]
        # A band's diagonals, and k more for the ends of the alignment.
        low = band[first][own] * (k + 1) - len(passage) - k
        width = 2 * (k + 1) + 2 * k
        at = low[:, None] + np.arange(len(passage) + width)[None, :]
        begins, stops = np.r_[0, ends[:-1] + 1][docs], ends[docs]
        at += begins[:, None]
        inside = (at >= begins[:, None]) & (at < stops[:, None])
        regions = np.where(inside, joined[np.clip(at, 0, len(joined) - 1)], 0)
        for a in range(0, len(regions), 512):
            edits = aligned(passage, regions[a : a + 512], k)
            for d, e, n in zip(docs[a : a + 512].tolist(), edits.tolist(), counts[a : a + 512].tolist()):
                if e <= k and (e, -n) < best.get((d, i), (k + 1, 0)):
                    best[d, i] = (e, -n)
    for (d, i), (e, n) in sorted(best.items()):
        yield d, i, e, -n


def find(texts: list[str | None], ix: Index) -> list[list[list[int | None]]]:
    """For each text its [item_id, edits, shared q-grams], least edits of each item.

    Texts are joined up to some millions of letters; a longer one stands alone.
    """
    out: list[list] = [[] for _ in texts]
    if not len(ix.codes):
        return out
    pieces, owners, size = [], [], 0

    def flush() -> None:
        nonlocal pieces, owners, size
        if pieces:
            ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
            joined = np.frombuffer(b"\0".join(pieces) + b"\0" * Q, np.uint8)
            for d, i, edits, shared in _search(joined, ends, ix):
                out[owners[d]].append([ix.items[i], edits, shared])
        pieces, owners, size = [], [], 0

    for n, text in enumerate(texts):
        piece = letters(text)
        if len(piece) < Q:
            continue
        pieces.append(piece)
        owners.append(n)
        size += len(piece)
        if size >= 2 * AT_ONCE:
            flush()
    flush()
    return out


def blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[list[tuple[int | None, bytes]]]:
    """Passages (item_id, text) in blocks of about ``size`` letters, read one after another.

    A passage of fewer than ``Q`` letters has no q-gram and is left out.
    """
    block, held = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = letters(row["text"])
        if len(text) < Q:
            continue
        block.append((row["item_id"], text))
        held += len(text)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def matcher(spark: SparkSession, block: list[tuple[int | None, bytes]]) -> Column:
    """Column function from a text to its matches; the index of a block is broadcast."""
    shipped = spark.sparkContext.broadcast(index(block))

    def match(texts: pd.Series) -> pd.Series:
        return pd.Series(find(texts.tolist(), shipped.value), dtype=object)

    return F.pandas_udf(match, ArrayType(ArrayType(LongType())))


def matches(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, edits, shared_grams) for each document and passage in it.

    Null and empty texts and passages match nothing; repeated rows come out
    repeated. Each block of the benchmark reads all documents once.
    """
    spark = docs.sparkSession
    found = [
        keep(
            docs.select("doc_id", F.explode(matcher(spark, b)("text")).alias("m")).select(
                "doc_id",
                F.col("m")[0].alias("item_id"),
                F.col("m")[1].alias("edits"),
                F.col("m")[2].alias("shared_grams"),
            ),
            "matches",
        )
        for b in blocks(benchmark, block)
    ]
    if not found:
        return docs.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("item_id", "edits", "shared_grams")]).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents in which no passage of the benchmark is found, with all their columns."""
    columns, rows = docs.columns, docs.select(whole_row(docs))
    for n, b in enumerate(blocks(benchmark, block)):
        if n:
            rows = keep(rows, "clean")
        found = rows.withColumn("m", matcher(docs.sparkSession, b)(F.col("row").getField("text")))
        rows = found.filter(F.size("m") == 0).select("row")
    return unpack(rows, columns)

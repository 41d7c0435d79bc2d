"""Documents packed into token sequences of one size, shortest pack first.

Texts are encoded, ended with an id and cut at the size of a sequence. What is
left of each is packed by its length alone: the histogram of lengths, at most
one number per length, is packed on the driver, longest first and always into
the emptiest packs, and gives packing patterns with counts. A pattern's places
for one length are a run of ranks, so a document finds its sequence by its rank
among the pieces of its length.

Ranks need no global order: a task numbers the pieces of each length as it
writes them, and the counts per task and length add up to where it begins.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from haulmart.llm.shared import keep

SIZE = 2048
END_ID = 1
# Texts that are encoded before their pieces are handed on.
AT_ONCE = 256


def ranks_path() -> str:
    """The byte-level vocabulary of byte_bpe_50k.json, written as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encodings: dict[str, object] = {}


def encoding(path: str):
    """The encoding of a file of ranks, once per worker process."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[path]


# --- patterns ---------------------------------------------------------------


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold these (length, times) each."""

    count: int
    parts: tuple[tuple[int, int], ...]

    @property
    def fill(self) -> int:
        return sum(length * times for length, times in self.parts)


def shortest_pack_first(histogram: Mapping[int, int], size: int = SIZE) -> list[Pattern]:
    """Patterns that hold ``histogram[length]`` pieces of each length.

    A length splits at most one group of like packs and opens at most one, so
    the patterns are at most twice the lengths, however many pieces there are.
    Where nothing has room, the fewest packs that hold the rest are opened.
    """
    packs: dict[int, list[tuple[int, tuple | None]]] = {}
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} does not fit a sequence of {size}")
        left = histogram[length]
        while left > 0:
            fill = min(packs, default=size)
            if fill + length > size:
                fill = 0
                packs[0] = [(-(-left // (size // length)), None)]
            group, moved = packs.pop(fill), packs.setdefault(fill + length, [])
            for at, (count, parts) in enumerate(group):
                taken = min(count, left)
                left -= taken
                moved.append((taken, (parts, length)))
                if not left:
                    rest = [(count - taken, parts)] if count > taken else []
                    if rest + group[at + 1 :]:
                        packs[fill] = rest + group[at + 1 :]
                    break
    out = []
    for fill in sorted(packs, reverse=True):
        for count, parts in packs[fill]:
            if parts is None:
                continue
            times: dict[int, int] = {}
            while parts is not None:
                parts, length = parts
                times[length] = times.get(length, 0) + 1
            out.append(Pattern(count, tuple(sorted(times.items(), reverse=True))))
    return out


@dataclass(frozen=True)
class Places:
    """Runs of ranks of one length, sorted by (length, first rank)."""

    keys: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray

    # Ranks of one length stay below this.
    RANKS = 1 << 50

    @classmethod
    def of(cls, patterns: list[Pattern]) -> Places:
        placed: dict[int, int] = {}
        rows, sequence = [], 0
        for pattern in patterns:
            offset = 0
            for length, times in pattern.parts:
                first = placed.get(length, 0)
                rows.append((length * cls.RANKS + first, sequence, times, offset))
                placed[length] = first + pattern.count * times
                offset += length * times
            sequence += pattern.count
        columns = np.array(sorted(rows), np.int64).reshape(-1, 4).T
        return cls(*columns)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the piece of that rank among those of its length."""
        key = length * self.RANKS + rank
        run = np.searchsorted(self.keys, key, "right") - 1
        within = key - self.keys[run]
        times = self.times[run]
        return self.sequence[run] + within // times, self.offset[run] + within % times * length


# --- documents --------------------------------------------------------------


def _cut(path: str, size: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_to_numpy
        task, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in (b.slice(i, AT_ONCE) for b in batches for i in range(0, b.num_rows, AT_ONCE)):
            ids, row, start, length, tokens, rank = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                made = encode(text, disallowed_special=()) if text else np.empty(0, np.uint32)
                ids += [made, [end_id]]
                n = len(made) + 1
                for at in range(0, n, size):
                    held = min(size, n - at)
                    row.append(i)
                    start.append(at)
                    length.append(held)
                    tokens.append(n)
                    rank.append(seen[held])
                    seen[held] += 1
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            cuts = pa.array(np.r_[0, np.cumsum(length)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(tokens, pa.int64()),
                    pa.ListArray.from_arrays(cuts, flat),
                    pa.array([task] * len(row), pa.int32()), pa.array(rank, pa.int64()),
                ],
                ["doc_id", "start", "length", "doc_tokens", "ids", "task", "rank"],
            )

    return cut


def packed(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """A row per piece: doc_id, start, length, doc_tokens, ids, sequence_id and offset.

    Every document ends with ``end_id``; a null or empty text has that id only.
    Pieces are whole sequences but for each document's last. Sequences are
    numbered from 0 without gaps, and so are the places in one. Repeated rows
    are packed each; no rows give no pieces.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, start long, length long, doc_tokens long, ids array<int>, task int, rank long"
    )
    pieces = keep(
        docs.select("doc_id", "text").mapInArrow(_cut(path or ranks_path(), size, end_id), schema), "pieces"
    )
    # A row per task and length from here to the next paragraph, then one per length.
    counts = keep(pieces.groupBy("task", "length").agg(F.max("rank").alias("last")), "lengths")
    histogram = {
        r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n")).collect()
    }
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("task").alias("of_task"), F.col("length").alias("of_length"),
        F.coalesce(F.sum(F.col("last") + 1).over(earlier), F.lit(0)).alias("before"),
    )

    places = Places.of(shortest_pack_first(histogram, size))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    met = pieces.join(before, (F.col("task") == F.col("of_task")) & (F.col("length") == F.col("of_length")))
    found = met.withColumn("placed", place("length", F.col("before") + F.col("rank")))
    return found.select("doc_id", "start", "length", "doc_tokens", "ids", "placed.*")


@F.pandas_udf(LongType())
def crc32_of(ids: pd.Series) -> pd.Series:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return pd.Series([zlib.crc32(np.asarray(x).astype("<u4").tobytes()) for x in ids], dtype="int64")


def sequences(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """A row per sequence: its ids, the pieces in it, and the length it is padded to.

    ``pieces`` is what ``packed`` returns. A sequence holds at most ``size``
    ids, so no group grows with the corpus. One whose length is a power of two
    needs no padding.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    filled = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    power = F.expr("n_tokens & (n_tokens - 1)") == 0
    return rows.withColumn("n_tokens", filled).select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces"),
        "n_tokens",
        F.when(power, F.col("n_tokens")).otherwise(F.lit(size)).alias("padded_to"),
    )

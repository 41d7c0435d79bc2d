"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is cut into cells at its own quantiles, cells are numbered along
the curve, and documents are sorted by that number. Any run of the order is
compact in all dimensions at once, so files and shards cut from it have narrow
ranges of every dimension, which lets readers skip files.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from haulmart.llm.shared import keep, whole_row

# Cells of a dimension: 2 to this power.
DEPTH = 4
ACCURACY = 10_000


def curve_index(cells: np.ndarray, depth: int) -> np.ndarray:
    """Places along the Hilbert curve of cells, one column per dimension.

    The coordinates become the transposed index by undoing rotations and
    exchanges from the top bit down and Gray coding the rest (J. Skilling,
    "Programming the Hilbert curve", 2004); its bits are then interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (depth - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            swap = (x[i] & bit) == 0
            exchanged = np.where(swap, (x[0] ^ x[i]) & low, 0)
            x[0] = np.where(swap, x[0] ^ exchanged, x[0] ^ low)
            x[i] ^= exchanged
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (depth - 1)
    while bit > 1:
        turn = np.where(x[n - 1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(depth - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def quantised(value: Column, cuts: Sequence[int | str]) -> Column:
    """How many cut points a value reaches; null counts as below all."""
    reached = [F.when(value >= c, 1).otherwise(0) for c in cuts]
    return sum(reached, F.lit(0)).cast("int")


def _number_cuts(rows: DataFrame, columns: Sequence[str], depth: int) -> dict[str, list[int]]:
    """Quantiles that cut each column into 2**depth cells, from a mergeable sketch."""
    if not columns:
        return {}
    shares = [i / (1 << depth) for i in range(1, 1 << depth)]
    found = rows.agg(*[F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def _string_cuts(rows: DataFrame, columns: Sequence[str], depth: int) -> dict[str, list[str]]:
    """Exact quantiles of whole strings that cut each column into 2**depth cells.

    Distinct values are counted first, with map-side combining, and spread over
    tasks by a range exchange; the rows of earlier tasks come from one sum per
    task. Only the cuts reach the driver, fewer than 2**depth per column.
    """
    if not columns:
        return {}
    cells = 1 << depth
    each = F.explode(
        F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).alias("value")) for c in columns])
    )
    counts = rows.select(each.alias("x")).filter(F.col("x.value").isNotNull()).groupBy(
        F.col("x.of").alias("of"), F.col("x.value").alias("value")
    ).agg(F.count(F.lit(1)).alias("n"))
    spread = keep(
        counts.repartitionByRange("of", "value").withColumn("task", F.spark_partition_id()), "values"
    )
    per_task = spread.groupBy(F.col("of").alias("dim"), F.col("task").alias("at")).agg(F.sum("n").alias("held"))
    of_dim = Window.partitionBy("dim")
    earlier = of_dim.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select(
        "dim", "at", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
        F.sum("held").over(of_dim).alias("total"),
    )
    running = Window.partitionBy("of", "task").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # One row per task and column, whatever the data.
    ranked = spread.join(
        F.broadcast(offsets), (F.col("of") == F.col("dim")) & (F.col("task") == F.col("at"))
    ).withColumn("upto", F.col("before") + F.sum("n").over(running))
    found = ranked.groupBy("of").agg(F.array(*[
        F.min(F.when(F.col("upto") * cells >= i * F.col("total"), F.col("value"))) for i in range(1, cells)
    ]).alias("cuts"))
    cuts = {r["of"]: sorted(set(r["cuts"])) for r in found.collect()}
    return {c: cuts.get(c, []) for c in columns}


def sorted_runs(docs: DataFrame, dimensions: dict[str, Column], depth: int = DEPTH) -> DataFrame:
    """``docs`` as written in the order of the curve, with ``place`` (global, from 0).

    Ties go by the checksum of the text, so equal texts of equal metadata are
    neighbours, and then by doc_id. The order is a range exchange, which spreads
    any hot cell over several tasks; files are runs of it. Places are the row
    numbers inside a task plus the rows of the tasks before, and only the counts
    per task, one row each, are summed in one place. Dimensions are numbers or
    strings; strings are compared whole, and a null lies below all values.
    """
    names = [f"dim_{d}" for d in dimensions]
    values = docs.select(*[v.alias(n) for n, v in zip(names, dimensions.values())])
    strings = [f.name for f in values.schema if isinstance(f.dataType, StringType)]
    numbers = [n for n in names if n not in strings]
    cuts = _number_cuts(values, numbers, depth) | _string_cuts(values, strings, depth)
    cells = [quantised(v, cuts[n]) for n, v in zip(names, dimensions.values())]

    def along(*columns: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.stack(columns, 1), depth))

    curve = F.pandas_udf(along, LongType())
    keyed = docs.withColumn("curve", curve(*cells))
    keys = ["curve", "text_crc32", "doc_id"]
    # Task and row number come from one pass over the sorted rows and are written with them.
    numbered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "at", F.monotonically_increasing_id()
    )
    written = keep(numbered, "curve").withColumns({
        "task": F.shiftrightunsigned("at", 33), "line": F.col("at").bitwiseAND((1 << 33) - 1),
    })
    per_task = written.groupBy(F.col("task").alias("of")).agg(F.count(F.lit(1)).alias("lines"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    # One row per task of the exchange, whatever the data.
    return written.join(F.broadcast(offsets), F.col("task") == F.col("of")).withColumn(
        "place", F.col("before") + F.col("line")
    ).drop("at", "task", "line", "of", "lines", "before")


def cut(placed: DataFrame, total: int, shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot``: runs whose row counts differ by one at most."""
    if not total:
        return placed.withColumns({"shard": F.lit(0), "slot": F.col("place")})
    shard = F.expr(f"cast(place * {shards} div {total} as int)")
    # The first place of shard s is the least p with p * shards >= s * total.
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("place") - first)


def sharded(docs: DataFrame, shards: int = 8, depth: int = DEPTH) -> DataFrame:
    """(row, doc_id, size, text_crc32, curve, place, shard, slot) of every row of ``docs``.

    ``row`` is the input row with all its columns. Dimensions are language,
    source, size and doc_id. Size is the text's UTF-8 bytes plus one; a null text has none and checksum zero. Repeated rows keep
    a slot each. The law is ``rows``: shard counts differ by one at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        whole_row(docs), "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dimensions = {
        "lang": F.col("row.lang").cast("string"), "source": F.col("row.source").cast("string"),
        "size": F.col("size"), "doc": F.col("doc_id").cast("long"),
    }
    placed = sorted_runs(rows, dimensions, depth)
    return cut(placed, placed.count(), shards)


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """The documents as Parquet, a folder per shard, files in the order of the curve.

    A column of the documents named shard or slot gives way to the new one.
    """
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    sharded(docs, shards).select(*own, "shard", "slot").write.partitionBy("shard").parquet(path)

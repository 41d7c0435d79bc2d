"""Surrogate keys, type-1 upserts and insert-only loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Numbering runs per hash bucket; the offsets are one row per bucket.
NUMBERING_BUCKETS = 4096


def number_rows(rows: DataFrame, natural: str, out: str) -> DataFrame:
    """Number rows 1..n, each natural key always drawing the same number.

    A global ``row_number`` would sort everything in one task. Here every hash
    bucket numbers its own rows and adds the size of the buckets before it.
    """
    bucketed = rows.withColumn(
        "_bucket", F.pmod(F.xxhash64(natural), F.lit(NUMBERING_BUCKETS)).cast("int")
    )
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    return (
        bucketed.withColumn("_local", local)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop("_bucket", "_local", "_offset")
    )


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    surrogate: str,
    natural: str,
    attributes: Sequence[str],
    last_key: int,
) -> DataFrame:
    """Type-1 upsert: known keys keep their surrogate and take the new values.

    Rows missing from ``incoming`` stay as they are. ``last_key`` is the
    highest surrogate handed out so far.
    """
    fresh = number_rows(
        incoming.join(existing.select(natural), natural, "left_anti"), natural, surrogate
    ).select(
        (F.col(surrogate) + F.lit(last_key)).cast("bigint").alias(surrogate),
        natural, *attributes,
    )
    new = incoming.select(
        natural, F.struct(*attributes).alias("_new")
    )
    kept = existing.join(new, natural, "left").select(
        F.col(surrogate).cast("bigint").alias(surrogate),
        natural,
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[a]).otherwise(F.col(a)).alias(a)
            for a in attributes
        ],
    )
    return kept.unionByName(fresh)


def merge(
    existing: DataFrame, incoming: DataFrame, natural: str, attributes: Sequence[str]
) -> DataFrame:
    """The same upsert on natural keys alone, as one full outer join."""
    old = existing.select(natural, F.struct(*attributes).alias("_old"))
    new = incoming.select(natural, F.struct(*attributes).alias("_new"))
    return old.join(new, natural, "full_outer").select(
        natural,
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[a])
            .otherwise(F.col("_old")[a])
            .alias(a)
            for a in attributes
        ],
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "kept")
        .otherwise("updated")
        .alias("change"),
    )


def insert_only(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose ``key`` has not been loaded before."""
    return incoming.join(existing.select(key), key, "left_anti")

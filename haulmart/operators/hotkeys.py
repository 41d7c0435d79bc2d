"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key below this many rows is an ordinary task's worth of work.
HOT_ROWS = 2_000_000
# The hottest keys treated apart. Any key outside the top N holds less than
# 1/N of all rows, so N bounds both what is broadcast and the largest cold group.
MAX_HOT_KEYS = 20_000


def hot_keys(rows: DataFrame, key: Column, hot_rows: int = HOT_ROWS) -> list[str]:
    """The keys over ``hot_rows``, hottest first and at most ``MAX_HOT_KEYS``.

    Counts combine map-side, so this reads one column and moves one row per
    key and task. Most data has no such key, and then plans need no second way.
    """
    counted = (
        rows.groupBy(key.alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter((F.col("_rows") > hot_rows) & (F.col("_key") != ""))
        .orderBy(F.col("_rows").desc(), "_key")
        .limit(MAX_HOT_KEYS)
    )
    return [r["_key"] for r in counted.collect()]


def key_table(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The given keys as a frame small enough to broadcast by construction."""
    frame = rows.sparkSession.createDataFrame([(k,) for k in keys], f"{name} string")
    return F.broadcast(frame)


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    spread_by: Sequence[Column],
    hot: Sequence[str] = (),
) -> DataFrame:
    """Left join ``rows`` to ``per_key``, which has one row per ``key``.

    ``per_key`` usually comes straight from an aggregate, and Spark does not
    split skew of a join whose side is aggregated in the same stage. So the
    summaries of the ``hot`` keys travel in a broadcast of bounded size, and
    rows with such a key, or with a blank one, take part in the shuffle under
    a scattered key that matches nothing.
    """
    values = [c for c in per_key.columns if c != key]
    own = F.col(key) != ""
    tagged = rows
    if hot:
        chosen = per_key.join(key_table(rows, hot, "_hot_key"), F.col(key) == F.col("_hot_key"))
        chosen = chosen.select("_hot_key", *[F.col(c).alias(f"_hot_{c}") for c in values])
        tagged = rows.join(F.broadcast(chosen), F.col(key) == F.col("_hot_key"), "left")
        own = own & F.col("_hot_key").isNull()
    scattered = F.concat(F.lit("\u0000"), F.xxhash64(*spread_by).cast("string"))
    tagged = tagged.withColumn("_shuffle_key", F.when(own, F.col(key)).otherwise(scattered))
    cold = per_key.select(
        F.col(key).alias("_cold_key"), *[F.col(c).alias(f"_cold_{c}") for c in values]
    )
    joined = tagged.join(cold, F.col("_shuffle_key") == F.col("_cold_key"), "left")
    found = [
        F.coalesce(F.col(f"_hot_{c}"), F.col(f"_cold_{c}")) if hot else F.col(f"_cold_{c}")
        for c in values
    ]
    return joined.select(*rows.columns, *[f.alias(c) for f, c in zip(found, values)])

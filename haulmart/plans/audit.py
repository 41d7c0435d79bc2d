"""Questions about the runs themselves: log, rejections, counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rejections_by_rule(errors: DataFrame) -> DataFrame:
    return errors.groupBy("rule").agg(F.count(F.lit(1)).alias("rejected")).orderBy(
        F.col("rejected").desc(), "rule"
    )


def rejected_per_run(errors: DataFrame) -> DataFrame:
    return errors.groupBy("run_id").agg(F.count(F.lit(1)).alias("rejected"))


def run_overview(log: DataFrame) -> DataFrame:
    """One row per run, oldest first: phases, failures, rejected rows."""
    return log.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.count(F.lit(1)).alias("phases"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum("rows_rejected").alias("rejected"),
    ).orderBy("started_at", "run_id")

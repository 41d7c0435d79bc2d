"""Conformed date and time dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.functions import derive as d
from haulmart.functions.render import day_name, month_name


def time_dimension(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        hour.alias("time_key"), hour.alias("hour"), d.time_band(hour).alias("time_band")
    )


def key_to_date(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def calendar_bounds(*date_keys: DataFrame) -> DataFrame:
    """One row: first and last ``date_key`` over all the given frames."""
    keys = date_keys[0].select("date_key")
    for other in date_keys[1:]:
        keys = keys.unionByName(other.select("date_key"))
    return keys.agg(F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))


def bounds_or_today(bounds: DataFrame, as_of: dt.date) -> DataFrame:
    """Bounds as dates; yesterday to today where nothing was loaded."""
    return bounds.select(
        F.coalesce(key_to_date(F.col("first_key")), F.date_sub(F.lit(as_of), 1)).alias("start"),
        F.coalesce(key_to_date(F.col("last_key")), F.lit(as_of)).alias("end"),
    )


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    day = F.col("full_date")
    weekday = F.weekday(day)
    return (
        bounds.select(F.explode(F.sequence("start", "end")).alias("full_date"))
        .select(
            d.date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            month_name(F.month(day)).alias("month_name"),
            F.weekofyear(day).alias("week"),
            F.dayofmonth(day).alias("day"),
            weekday.alias("day_of_week"),
            day_name(weekday).alias("day_name"),
            F.when(F.dayofmonth(day) <= 15, 1).otherwise(2).alias("fortnight"),
            (weekday >= 5).alias("is_weekend"),
        )
    )


def add_missing(existing: DataFrame, built: DataFrame, key: str) -> DataFrame:
    """Existing rows stay untouched; only unknown keys are added."""
    return existing.unionByName(built.join(existing.select(key), key, "left_anti"))

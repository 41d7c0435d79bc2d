"""Capture rules run over whole source tables as quality checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions.cleaning import strip


def canonical_code(value: Column) -> Column:
    """Codes and tax ids as captured: stripped and upper-cased."""
    return F.upper(strip(value))


def canonical_plate(value: Column) -> Column:
    """Plates as captured: only hyphens are dropped."""
    return F.regexp_replace(F.upper(strip(value)), "-", "")


def _rules(as_of: dt.date) -> dict[str, tuple[str, list[tuple[str, Column]]]]:
    """Per table: its natural key and the named conditions that break a rule."""
    col = F.col
    return {
        "route": ("code", [("distance_positive", col("distance_km") <= 0)]),
        "delivery": (
            "folio",
            [
                ("arrival_after_departure",
                 col("scheduled_arrival") <= col("scheduled_departure")),
                ("weight_within_capacity",
                 (col("cargo_weight_kg") != 0)
                 & (col("cargo_weight_kg") > col("vehicle_cargo_capacity_kg"))),
            ],
        ),
        "fuel_load": (
            "folio",
            [
                ("liters_positive", col("liters") <= 0),
                ("liters_within_tank",
                 (col("liters") > 0) & (col("liters") > col("vehicle_tank_capacity_l") * 2)),
                ("odometer_non_negative", col("odometer_km") < 0),
            ],
        ),
        "maintenance": (
            "folio",
            [("costs_non_negative",
              (F.coalesce(col("labor_cost"), F.lit(0)) < 0)
              | (F.coalesce(col("parts_cost"), F.lit(0)) < 0))],
        ),
        "operator": (
            "employee_number",
            [("expiry_after_hire", col("license_expiry") < col("hire_date"))],
        ),
        "vehicle": (
            "plate",
            [("year_in_range", ~col("year").between(1980, as_of.year + 1))],
        ),
    }


# Vehicle limits the rules of other tables look at.
_LIMITS = {"delivery": "cargo_capacity_kg", "fuel_load": "tank_capacity_l"}


def violations(sources: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """One row per broken rule: table, natural key, rule."""
    found = []
    for table, (natural, rules) in _rules(as_of).items():
        rows = sources[table]
        if table in _LIMITS:
            limit = _LIMITS[table]
            rows = rows.join(
                sources["vehicle"].select(
                    F.col("id").alias("vehicle_id"), F.col(limit).alias(f"vehicle_{limit}")
                ),
                "vehicle_id", "left",
            )
        broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]))
        found.append(
            rows.select(
                F.lit(table).alias("table_name"),
                F.col(natural).alias("natural_key"),
                F.explode(broken).alias("rule"),
            )
        )
    return reduce(DataFrame.unionByName, found)

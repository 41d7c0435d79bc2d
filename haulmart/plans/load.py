"""Upsert the dimensions, then add the new facts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.operators.keys import insert_only
from haulmart.sources.schemas import FACT_DDL, schema


@dataclass(frozen=True)
class Dimension:
    table: str
    group: str
    surrogate: str
    natural: str
    attributes: tuple[str, ...]


DIMENSIONS = (
    Dimension("dim_customer", "customers", "customer_key", "code",
              ("business_name", "city", "state", "customer_type")),
    Dimension("dim_vehicle", "vehicles", "vehicle_key", "plate",
              ("economic_number", "brand", "model", "year", "vehicle_type",
               "age_range", "capacity_range")),
    Dimension("dim_operator", "operators", "operator_key", "employee_number",
              ("full_name", "license_type", "seniority_range")),
    Dimension("dim_route", "routes", "route_key", "code",
              ("name", "origin_city", "destination_city", "distance_km",
               "distance_range", "route_type", "zone")),
    Dimension("dim_delay_cause", "delay_causes", "delay_cause_key", "code",
              ("name", "category")),
)

# Per fact: clean group and the keys to resolve as
# (clean column, dimension table, surrogate, natural key, fact column).
_CUSTOMER = ("customer_code", "dim_customer", "customer_key", "code", "customer_id")
_ROUTE = ("route_code", "dim_route", "route_key", "code", "route_id")
_VEHICLE = ("vehicle_plate", "dim_vehicle", "vehicle_key", "plate", "vehicle_id")
_OPERATOR = ("operator_number", "dim_operator", "operator_key", "employee_number", "operator_id")
_CAUSE = ("delay_cause_code", "dim_delay_cause", "delay_cause_key", "code", "delay_cause_id")
FACTS = {
    "fact_delivery": ("deliveries", (_CUSTOMER, _ROUTE, _VEHICLE, _OPERATOR, _CAUSE)),
    "fact_fuel": ("fuel_loads", (_VEHICLE, _OPERATOR)),
    "fact_maintenance": ("maintenances", (_VEHICLE,)),
}
OPTIONAL_KEYS = frozenset({"delay_cause_code"})


class LoadError(RuntimeError):
    """A fact refers to a member that no dimension holds."""


def resolve(rows: DataFrame, dims: Mapping[str, DataFrame], fact: str) -> DataFrame:
    """Natural keys to surrogate keys; an unknown key leaves a null.

    Customers, the members that grow most, are met last: if that takes a
    shuffle, the other keys are numbers by then.
    """
    for column, table, surrogate, natural, target in reversed(FACTS[fact][1]):
        keys = dims[table].select(
            F.col(natural).alias(column), F.col(surrogate).alias(target)
        )
        rows = rows.join(keys, column, "left")
    renamed = rows.withColumnRenamed("date_key", "date_id")
    if "time_key" in rows.columns:
        renamed = renamed.withColumnRenamed("time_key", "time_id")
    return renamed


def unresolved(fact: str) -> Column:
    """True where a key that must exist did not resolve."""
    broken = F.lit(False)
    for column, _, _, _, target in FACTS[fact][1]:
        absent = F.col(target).isNull()
        if column in OPTIONAL_KEYS:
            absent = absent & F.col(column).isNotNull()
        broken = broken | absent
    return broken


def fact_rows(
    clean: DataFrame, existing: DataFrame, dims: Mapping[str, DataFrame], fact: str
) -> DataFrame:
    """New facts with their keys; fails the job on a key that does not resolve."""
    resolved = resolve(insert_only(existing, clean, "folio"), dims, fact)
    checked = resolved.withColumn(
        "folio",
        F.when(
            unresolved(fact),
            F.raise_error(F.concat(F.lit("unknown key in folio "), F.col("folio"))).cast("string"),
        ).otherwise(F.col("folio")),
    )
    return checked.select(*schema(FACT_DDL[fact]).fieldNames())

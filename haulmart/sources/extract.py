"""Land the source tables verbatim, foreign keys turned into natural keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.functions.derive import instant, moment_in, session_zone
from haulmart.sources.schemas import staging_columns

# Source table of every landing table.
SOURCES = {
    "stg_customer": "customer",
    "stg_vehicle": "vehicle",
    "stg_operator": "operator",
    "stg_route": "route",
    "stg_delay_cause": "delay_cause",
    "stg_delivery": "delivery",
    "stg_fuel_load": "fuel_load",
    "stg_maintenance": "maintenance",
}

# Foreign keys resolved while landing: (id column, source table, its natural
# key, landing column).
_CUSTOMER = ("customer_id", "customer", "code", "customer_code")
_ROUTE = ("route_id", "route", "code", "route_code")
_VEHICLE = ("vehicle_id", "vehicle", "plate", "vehicle_plate")
_OPERATOR = ("operator_id", "operator", "employee_number", "operator_number")
_CAUSE = ("delay_cause_id", "delay_cause", "code", "delay_cause_code")
REFERENCES = {
    "stg_delivery": (_CUSTOMER, _ROUTE, _VEHICLE, _OPERATOR, _CAUSE),
    "stg_fuel_load": (_VEHICLE, _OPERATOR),
    "stg_maintenance": (_VEHICLE,),
}


def changed_since(
    source: DataFrame, watermark: dt.datetime | None, zone: str | None = None
) -> DataFrame:
    """Rows updated strictly after the watermark; all rows without one."""
    if watermark is None:
        return source
    return source.filter(
        F.col("updated_at") > instant(watermark, source.schema["updated_at"].dataType, zone)
    )


def zoned(rows: DataFrame, zone: str) -> DataFrame:
    """Zone-free timestamps as the instants they name in ``zone``."""
    free = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampNTZType)]
    own = session_zone(rows)
    return rows.withColumns({name: moment_in(F.col(name), zone, own) for name in free})


def denormalise(rows: DataFrame, sources: Mapping[str, DataFrame], table: str) -> DataFrame:
    """Replace each foreign id by the natural key it points to.

    A lake enforces no foreign keys: a row whose id finds no partner lands with
    a null key, for the cleaning to refuse and record.
    """
    for id_column, target, natural, landed in REFERENCES.get(table, ()):
        lookup = sources[target].select(
            F.col("id").alias(id_column), F.col(natural).alias(landed)
        )
        rows = rows.join(lookup, id_column, "left")
    return rows


def stamp(rows: DataFrame, table: str, run_id: str, extracted_at: dt.datetime) -> DataFrame:
    """Landing columns in declared order, with provenance."""
    return rows.select(
        F.col("id").alias("source_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(extracted_at).alias("extracted_at"),
        *staging_columns(table),
    )


def land(
    sources: Mapping[str, DataFrame],
    table: str,
    run_id: str,
    extracted_at: dt.datetime,
    watermark: dt.datetime | None = None,
    zone: str | None = None,
) -> DataFrame:
    """The rows one extract adds to a landing table.

    With a ``zone``, zone-free times of the source land as instants.

    The source id doubles as the landing position within the run: it is unique
    there, and rows of a later run are newer by ``extracted_at``.
    """
    changed = changed_since(sources[SOURCES[table]], watermark, zone)
    rows = stamp(denormalise(changed, sources, table), table, run_id, extracted_at)
    if zone is not None:
        rows = zoned(rows, zone)
    return rows.withColumn("id", F.col("source_id"))


def watermark(etl_log: DataFrame) -> DataFrame:
    """One row: when the latest successful load finished, null if none did."""
    return etl_log.filter((F.col("phase") == "LOAD") & (F.col("status") == "SUCCESS")).agg(
        F.max("finished_at").alias("watermark")
    )


def extract_watermark(etl_log: DataFrame) -> DataFrame:
    """Where the next extract resumes: the start of the last loaded run's extract.

    Rows updated between that instant and the end of the load would be lost if
    the finish of the load were used.
    """
    loaded = (
        etl_log.filter((F.col("phase") == "LOAD") & (F.col("status") == "SUCCESS"))
        .groupBy("run_id")
        .agg(F.max("finished_at").alias("finished_at"))
        .orderBy(F.col("finished_at").desc(), "run_id")
        .limit(1)
    )
    return (
        etl_log.filter(F.col("phase") == "EXTRACT")
        .join(loaded.select("run_id"), "run_id", "left_semi")
        .agg(F.min("started_at").alias("watermark"))
    )

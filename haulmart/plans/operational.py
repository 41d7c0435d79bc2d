"""Questions about the running fleet, asked of the source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.functions import derive as d
from haulmart.operators.hotkeys import HOT_ROWS, hot_keys, key_table
from haulmart.operators.ordered import before_each


def efficiency_report(
    fuel_loads: DataFrame,
    vehicles: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Fuel per vehicle over the odometer span, worst first.

    The earliest load of the window only filled the tank for the first reading,
    so its litres do not count as burned over the measured span. One aggregate
    finds the span, the sums and that load.
    """
    loads, kind = fuel_loads.filter("is_active"), fuel_loads.schema["load_datetime"].dataType
    if start is not None:
        loads = loads.filter(F.col("load_datetime") >= d.instant(start, kind))
    if end is not None:
        loads = loads.filter(F.col("load_datetime") <= d.instant(end, kind))
    totals = loads.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("loads"),
        F.sum("liters").alias("liters"),
        F.sum("total_cost").alias("cost"),
        (F.max("odometer_km") - F.min("odometer_km")).alias("km"),
        F.min(F.struct("load_datetime", "id", "liters"))["liters"].alias("first_liters"),
    )
    burned = F.col("liters") - F.col("first_liters")
    named = vehicles.select(F.col("id").alias("vehicle_id"), "plate", "economic_number")
    return (
        totals.join(named, "vehicle_id")
        .select(
            "plate", "economic_number", "loads",
            F.coalesce(F.col("liters"), F.lit(0)).alias("liters"),
            F.coalesce(F.col("cost"), F.lit(0)).alias("cost"),
            "km",
            d.efficiency(
                F.col("km").cast("decimal(18,2)"), burned.cast("decimal(18,2)")
            ).alias("efficiency"),
        )
        .orderBy(F.col("efficiency").asc_nulls_first(), "plate")
    )


def vehicle_state(vehicles: DataFrame, as_of: dt.date) -> DataFrame:
    """Add kilometres and days around the service window to each vehicle."""
    stated = vehicles.withColumns(
        {
            "km_to_next_service": d.km_to_next_service(
                F.col("next_service_km"), F.col("current_odometer_km")
            ),
            "days_since_service": d.days_since_service(F.col("last_service_date"), as_of),
        }
    )
    return stated.withColumn(
        "needs_maintenance",
        d.needs_maintenance(F.col("km_to_next_service"), F.col("days_since_service")),
    )


def _whole(km: Column) -> Column:
    return F.bround(km, 0).cast("bigint").cast("string")


def maintenance_alerts(vehicles: DataFrame, as_of: dt.date) -> DataFrame:
    """Vehicles that need service, most urgent first, with the reason."""
    remaining, elapsed = F.col("km_to_next_service"), F.col("days_since_service")
    def urgent(severity: str, *reason: Column | str) -> Column:
        parts = [F.lit(x) if isinstance(x, str) else x for x in reason]
        return F.struct(
            F.lit(severity).alias("severity"), F.concat(*parts).alias("reason")
        )

    alert = (
        F.when(
            remaining <= 0,
            urgent("ALTA", "Kilometraje vencido por ", _whole(F.abs(remaining)),
                   " km respecto al próximo servicio."),
        )
        .when(elapsed.isNull(), urgent("ALTA", "Sin registro de servicio previo."))
        .when(
            elapsed > d.SERVICE_MAX_DAYS,
            urgent("ALTA", "Han pasado ", elapsed.cast("string"),
                   " días desde el último servicio."),
        )
        .when(
            remaining <= d.SERVICE_WARNING_KM,
            urgent("MEDIA", "Faltan ", _whole(remaining), " km para el próximo servicio."),
        )
    )
    return (
        vehicle_state(vehicles.filter("is_active AND status <> 'OUT_OF_SERVICE'"), as_of)
        .withColumn("alert", alert)
        .filter(F.col("alert").isNotNull())
        .select(
            "plate", "economic_number", "alert.severity", "alert.reason",
            "km_to_next_service", "days_since_service",
        )
        .orderBy(F.col("severity") != "ALTA", "km_to_next_service", "plate")
    )


def alert_tally(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"))


def deliveries_per_customer(customers: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Every customer with the number of its deliveries, zero included."""
    counts = deliveries.groupBy(F.col("customer_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return customers.join(counts, "id", "left").select(
        "code", F.coalesce(F.col("n"), F.lit(0)).alias("total_deliveries")
    )


def previous_load(fuel_loads: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Odometer of the vehicle's previous active load, strictly earlier in time.

    Of several loads at the previous instant the one with the highest id
    counts. A load without a time has no earlier load and is none itself.
    Vehicles of ordinary size take one range window; a vehicle over
    ``hot_rows`` is reduced to one row per instant first, and those are carried
    forward minute by minute.
    """
    known = fuel_loads.withColumn("_vehicle", F.col("vehicle_id").cast("string"))
    hot = hot_keys(known, F.col("_vehicle"), hot_rows)
    reading = F.struct("load_datetime", "id", "odometer_km")
    timed = F.col("load_datetime").isNotNull()
    active = F.when(F.col("is_active") & timed, reading)

    micros = F.unix_micros(F.col("load_datetime").cast("timestamp"))
    earlier = (
        Window.partitionBy("_vehicle").orderBy(micros)
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    columns = [*fuel_loads.columns, "previous_odometer_km"]
    latest = F.when(timed, F.max(active).over(earlier)["odometer_km"])
    if not hot:
        return known.withColumn("previous_odometer_km", latest).select(*columns)

    chosen = key_table(known, hot, "_vehicle")
    cold = known.join(chosen, "_vehicle", "left_anti").withColumn("previous_odometer_km", latest)
    crowded = known.join(chosen, "_vehicle", "left_semi")
    instants = crowded.groupBy("_vehicle", "load_datetime").agg(
        F.max(active)["odometer_km"].alias("_at_instant")
    )
    carried = before_each(
        instants, "_vehicle", "_at_instant", ("load_datetime",),
        ({"_minute": F.date_format("load_datetime", "yyyyMMddHHmm")},),
        "previous_odometer_km", hot_rows=0,
    ).drop("_at_instant")
    # Loads without a time stay, with nothing to carry to them.
    split = crowded.join(carried.filter(timed), ["_vehicle", "load_datetime"], "left")
    return cold.select(*columns).unionByName(split.select(*columns))


def load_efficiency(fuel_loads: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Kilometres and efficiency of each load against the previous one."""
    distance = F.col("odometer_km") - F.col("previous_odometer_km")
    return previous_load(fuel_loads, hot_rows).withColumns(
        {
            "km_traveled": distance,
            "efficiency_km_per_liter": d.efficiency(distance, F.col("liters")),
        }
    )

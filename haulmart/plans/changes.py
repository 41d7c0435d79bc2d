"""State changes of the running fleet as batch jobs over event tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions import derive as d
from haulmart.functions.render import label
from haulmart.operators.hotkeys import HOT_ROWS, hot_keys, join_per_key
from haulmart.operators.ordered import HIGHEST, before_each


@dataclass(frozen=True)
class Applied:
    """New state of both tables and the events that were refused."""

    rows: DataFrame
    vehicles: DataFrame
    refused: DataFrame


def _refusal(*cases: tuple[Column, Column | str]) -> Column:
    reason = F.lit(None).cast("string")
    for failed, text in reversed(cases):
        reason = F.when(failed, F.lit(text) if isinstance(text, str) else text).otherwise(reason)
    return reason


def arrival_verdicts(
    events: DataFrame, deliveries: DataFrame, causes: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Arrival events with the delivery they close and the reason to refuse.

    ``events`` has ``event_id``, ``folio``, ``arrived_at``, ``cause_code``. A
    folio closes once: of several events the first acceptable one (by arrival,
    then id) counts and later ones meet a closed delivery.
    """
    active = causes.filter("is_active").select(
        F.col("code").alias("cause_code"), F.col("id").alias("_cause_id")
    )
    joined = events.join(deliveries.drop("delay_cause_id"), "folio").join(
        active, "cause_code", "left"
    )
    departure = F.coalesce(F.col("actual_departure"), F.col("scheduled_departure"))
    late = d.delay_minutes(F.col("scheduled_arrival"), F.col("arrived_at")) > (
        d.DELAY_TOLERANCE_MINUTES
    )
    closed = F.concat(
        F.lit("La entrega "), F.col("folio"), F.lit(" ya está cerrada ("),
        label(F.col("status"), "delivery_status"), F.lit(")."),
    )
    own = _refusal(
        (~d.is_open(F.col("status")), closed),
        (F.col("arrived_at") < departure, "La llegada no puede ser anterior a la salida."),
        (
            late & (F.coalesce(F.col("cause_code"), F.lit("")) == ""),
            "Una entrega con retraso requiere que se indique la causa.",
        ),
        (
            late & F.col("_cause_id").isNull(),
            F.concat(
                F.lit("Causa de retraso desconocida: "), F.col("cause_code"), F.lit(".")
            ),
        ),
    )
    judged = joined.withColumns(
        {
            "_late": late,
            "_own": own,
            "_position": F.struct("arrived_at", "event_id"),
            "_departed": departure,
        }
    )
    winner = F.min(F.when(F.col("_own").isNull(), F.struct("_position", "_late")))
    per_folio = judged.groupBy("folio").agg(winner.alias("_winner"))
    hot = hot_keys(events, F.col("folio"), hot_rows)
    placed = join_per_key(judged, per_folio, "folio", [F.col("event_id")], hot)
    status = F.when(F.col("_winner._late"), "DELAYED").otherwise("DELIVERED")
    reclosed = F.concat(
        F.lit("La entrega "), F.col("folio"), F.lit(" ya está cerrada ("),
        label(status, "delivery_status"), F.lit(")."),
    )
    after = F.coalesce(F.col("_position") > F.col("_winner._position"), F.lit(False))
    return placed.withColumn("reason", F.when(after, reclosed).otherwise(F.col("_own")))


def apply_arrivals(
    events: DataFrame,
    deliveries: DataFrame,
    causes: DataFrame,
    vehicles: DataFrame,
    at: dt.datetime,
    hot_rows: int = HOT_ROWS,
) -> Applied:
    """Close deliveries, note the cause of late ones, free their vehicles."""
    moment = d.instant(at, deliveries.schema["updated_at"].dataType)
    verdicts = arrival_verdicts(events, deliveries, causes, hot_rows)
    accepted = verdicts.filter(F.col("reason").isNull()).select(
        "folio",
        F.struct(
            F.col("arrived_at"),
            F.col("_departed"),
            F.when(F.col("_late"), F.col("_cause_id")).alias("cause_id"),
            F.when(F.col("_late"), "DELAYED").otherwise("DELIVERED").alias("status"),
        ).alias("_close"),
        F.col("vehicle_id").alias("_vehicle_id"),
    )
    hit = F.col("_close").isNotNull()
    closing = accepted.select("folio", "_close")
    rows = deliveries.join(closing, "folio", "left").withColumns(
        {
            "actual_arrival": F.when(hit, F.col("_close.arrived_at")).otherwise(
                F.col("actual_arrival")
            ),
            "actual_departure": F.when(hit, F.col("_close._departed")).otherwise(
                F.col("actual_departure")
            ),
            "delay_cause_id": F.when(hit, F.col("_close.cause_id")).otherwise(
                F.col("delay_cause_id")
            ),
            "status": F.when(hit, F.col("_close.status")).otherwise(F.col("status")),
            "updated_at": F.when(hit, moment).otherwise(F.col("updated_at")),
        }
    ).select(*deliveries.columns)
    freed = accepted.groupBy(F.col("_vehicle_id").alias("id")).agg(
        F.count(F.lit(1)).alias("_closed")
    )
    back = F.col("_closed").isNotNull() & (F.col("status") == "ON_ROUTE")
    fleet = vehicles.join(freed, "id", "left").withColumns(
        {
            "updated_at": F.when(back, moment).otherwise(F.col("updated_at")),
            "status": F.when(back, "AVAILABLE").otherwise(F.col("status")),
        }
    ).select(*vehicles.columns)
    refused = verdicts.filter(F.col("reason").isNotNull()).select("event_id", "folio", "reason")
    return Applied(rows, fleet, refused)


def completion_verdicts(
    events: DataFrame,
    maintenances: DataFrame,
    vehicles: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Workshop completions with the reason to refuse them, if any.

    ``events`` has ``event_id``, ``folio`` and ``next_service_km`` (may be
    null). Completions of one vehicle take effect by service date, then id. A
    refused reading never exceeds the odometer, so the odometer an event meets
    is the highest reading of all events before it. A folio completes once.
    """
    vehicle = vehicles.select(
        F.col("id").alias("vehicle_id"), F.col("current_odometer_km").alias("_start_km")
    )
    joined = (
        events.withColumnRenamed("next_service_km", "_given_km")
        .join(maintenances.drop("next_service_km"), "folio")
        .join(vehicle, "vehicle_id")
        .withColumns(
            {
                "_vehicle": F.col("vehicle_id").cast("string"),
                "_reading": F.when(F.col("status") != "COMPLETED", F.col("odometer_km")),
                "_target": F.coalesce(
                    F.col("_given_km"), F.col("odometer_km") + d.SERVICE_INTERVAL_KM
                ).cast("decimal(12,2)"),
                "_position": F.struct("service_date", "event_id"),
            }
        )
    )
    met = before_each(
        joined,
        group="_vehicle",
        value="_reading",
        order=("service_date", "event_id"),
        buckets=(
            {"_day": F.col("service_date")},
            {"_chunk": F.floor(F.col("event_id") / 1_000_000)},
        ),
        out="_before_km",
        carry=HIGHEST,
        hot_rows=hot_rows,
    ).withColumn("_met_km", F.greatest("_start_km", "_before_km"))
    fits = (F.col("status") != "COMPLETED") & (F.col("odometer_km") >= F.col("_met_km"))
    per_folio = met.groupBy("folio").agg(
        F.min(F.when(fits, F.col("_position"))).alias("_winner")
    )
    hot = hot_keys(events, F.col("folio"), hot_rows)
    placed = join_per_key(met, per_folio, "folio", [F.col("event_id")], hot)
    after = F.coalesce(F.col("_position") > F.col("_winner"), F.lit(False))
    reason = _refusal(
        (
            (F.col("status") == "COMPLETED") | after,
            F.concat(
                F.lit("El mantenimiento "), F.col("folio"), F.lit(" ya está completado.")
            ),
        ),
        (
            F.col("odometer_km") < F.col("_met_km"),
            F.concat(
                F.lit(
                    "El odómetro del servicio no puede ser menor al odómetro actual "
                    "del vehículo ("
                ),
                F.col("_met_km").cast("string"),
                F.lit(" km)."),
            ),
        ),
    )
    return placed.withColumn("reason", reason)


def apply_completions(
    events: DataFrame,
    maintenances: DataFrame,
    vehicles: DataFrame,
    at: dt.datetime,
    hot_rows: int = HOT_ROWS,
) -> Applied:
    """Complete workshop orders and push the service window onto the vehicles."""
    moment = d.instant(at, maintenances.schema["updated_at"].dataType)
    verdicts = completion_verdicts(events, maintenances, vehicles, hot_rows)
    accepted = verdicts.filter(F.col("reason").isNull())
    hit = F.col("_done").isNotNull()
    rows = maintenances.join(
        accepted.select("folio", F.col("_target").alias("_done")), "folio", "left"
    ).withColumns(
        {
            "next_service_km": F.when(hit, F.col("_done")).otherwise(F.col("next_service_km")),
            "status": F.when(hit, "COMPLETED").otherwise(F.col("status")),
            "total_cost": F.when(
                hit, d.maintenance_total(F.col("labor_cost"), F.col("parts_cost"))
            ).otherwise(F.col("total_cost")),
            "updated_at": F.when(hit, moment).otherwise(F.col("updated_at")),
        }
    ).select(*maintenances.columns)
    latest = accepted.groupBy(F.col("vehicle_id").alias("id")).agg(
        F.max(F.struct("service_date", "event_id", "odometer_km", "_target")).alias("_last")
    )
    served = F.col("_last").isNotNull()
    fleet = vehicles.join(latest, "id", "left").withColumns(
        {
            "current_odometer_km": F.when(served, F.col("_last.odometer_km")).otherwise(
                F.col("current_odometer_km")
            ),
            "next_service_km": F.when(served, F.col("_last._target")).otherwise(
                F.col("next_service_km")
            ),
            "last_service_date": F.when(served, F.col("_last.service_date")).otherwise(
                F.col("last_service_date")
            ),
            "updated_at": F.when(served, moment).otherwise(F.col("updated_at")),
            "status": F.when(served & (F.col("status") != "OUT_OF_SERVICE"), "AVAILABLE")
            .otherwise(F.col("status")),
        }
    ).select(*vehicles.columns)
    refused = verdicts.filter(F.col("reason").isNotNull()).select("event_id", "folio", "reason")
    return Applied(rows, fleet, refused)


def deactivate(rows: DataFrame, ids: DataFrame, at: dt.datetime) -> DataFrame:
    """Soft delete: the row stays, marked inactive, and the next extract sees it."""
    moment = d.instant(at, rows.schema["updated_at"].dataType)
    gone = ids.select("id").distinct().withColumn("_gone", F.lit(True))
    hit = F.coalesce(F.col("_gone"), F.lit(False))
    return rows.join(gone, "id", "left").withColumns(
        {
            "is_active": F.col("is_active") & ~hit,
            "updated_at": F.when(hit, moment).otherwise(F.col("updated_at")),
        }
    ).select(*rows.columns)

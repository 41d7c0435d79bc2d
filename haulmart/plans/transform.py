"""Clean the landed tables: named rules, quarantine, derived measures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions import cleaning as c
from haulmart.functions import derive as d
from haulmart.operators.hotkeys import HOT_ROWS
from haulmart.operators.ordered import before_each
from haulmart.operators.verdict import Keep, Repeat, Rule, Verdict, judge

FAR_FUTURE = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Cleaned:
    """Outcome of one table: rows for the warehouse and rows for quarantine."""

    project: Callable[[Verdict], DataFrame]
    verdict: Verdict

    @cached_property
    def rows(self) -> DataFrame:
        return self.project(self.verdict)

    @cached_property
    def rejected(self) -> DataFrame:
        return self.verdict.rejected()

    def settled(self, keep: Keep) -> Cleaned:
        """The same outcome read from judged rows that are written once."""
        return replace(self, verdict=self.verdict.settled(keep))

    def slices(self, count: int) -> list[Cleaned]:
        """The outcome in parts, each of whole natural keys, in place of one large shuffle."""
        return [replace(self, verdict=v) for v in self.verdict.slices(count)]


def _missing(description: str, payload: tuple[str, ...], *required: str) -> Rule:
    """Values the derivations cannot do without; refused instead of failing the run."""
    absent = F.lit(False)
    for name in required:
        absent = absent | F.col(name).isNull()
    return Rule("missing_required", absent, description, payload)


def customers(staging: DataFrame) -> Cleaned:
    payload = ("code", "business_name")
    verdict = judge(
        staging,
        c.normalize_code(F.col("code")),
        [],
        Repeat(
            "Clave natural repetida; se conserva el registro más reciente.",
            payload,
            blank=Rule(
                "normalize_code", F.lit(True), "Código de cliente vacío.", payload,
                pk=F.col("source_id"),
            ),
        ),
    )
    text = c.normalize_text
    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_code(F.col("code")).alias("code"),
            text(F.col("business_name")).alias("business_name"),
            c.normalize_code(F.col("tax_id")).alias("tax_id"),
            c.default_if_blank(text(F.col("city"))).alias("city"),
            c.default_if_blank(text(F.col("state"))).alias("state"),
            c.code_or(F.col("customer_type"), "REGULAR").alias("customer_type"),
        )

    return Cleaned(rows, verdict)


def vehicles(staging: DataFrame, as_of: dt.date) -> Cleaned:
    verdict = judge(
        staging,
        c.normalize_plate(F.col("plate")),
        [
            _missing(
                "Falta el año o la capacidad de carga.",
                ("plate", "year", "cargo_capacity_kg"),
                "year", "cargo_capacity_kg",
            )
        ],
        Repeat("Placa vacía o repetida.", ("plate",), pk=F.col("plate")),
    )
    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_plate(F.col("plate")).alias("plate"),
            c.normalize_code(F.col("economic_number")).alias("economic_number"),
            c.normalize_text(F.col("brand")).alias("brand"),
            c.normalize_text(F.col("model")).alias("model"),
            F.col("year").cast("int").alias("year"),
            c.normalize_code(F.col("vehicle_type")).alias("vehicle_type"),
            c.age_range(F.col("year"), as_of.year).alias("age_range"),
            c.capacity_range(F.col("cargo_capacity_kg")).alias("capacity_range"),
        )

    return Cleaned(rows, verdict)


def operators(staging: DataFrame, as_of: dt.date) -> Cleaned:
    verdict = judge(
        staging,
        c.normalize_code(F.col("employee_number")),
        [
            _missing(
                "Falta la fecha de ingreso.", ("employee_number", "hire_date"), "hire_date"
            )
        ],
        Repeat(
            "Número de empleado vacío o repetido.",
            ("employee_number",),
            pk=F.col("employee_number"),
        ),
    )
    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_code(F.col("employee_number")).alias("employee_number"),
            c.normalize_text(d.full_name(F.col("first_name"), F.col("last_name"))).alias(
                "full_name"
            ),
            c.code_or(F.col("license_type"), "C").alias("license_type"),
            c.seniority_range(F.col("hire_date"), as_of).alias("seniority_range"),
        )

    return Cleaned(rows, verdict)


def routes(staging: DataFrame) -> Cleaned:
    verdict = judge(
        staging,
        c.normalize_code(F.col("code")),
        [
            Rule(
                "is_positive",
                ~c.is_positive(F.col("distance_km")),
                "La distancia debe ser mayor que cero.",
                ("code", "distance_km"),
            )
        ],
        Repeat("Código de ruta vacío o repetido.", ("code",), pk=F.col("code")),
    )
    text = c.normalize_text
    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_code(F.col("code")).alias("code"),
            text(F.col("name")).alias("name"),
            c.default_if_blank(text(F.col("origin_city"))).alias("origin_city"),
            c.default_if_blank(text(F.col("destination_city"))).alias("destination_city"),
            F.col("distance_km"),
            c.distance_range(F.col("distance_km")).alias("distance_range"),
            c.normalize_code(F.col("route_type")).alias("route_type"),
            c.code_or(F.col("zone"), c.UNZONED).alias("zone"),
        )

    return Cleaned(rows, verdict)


def with_unspecified(causes: DataFrame) -> DataFrame:
    """The marker for late deliveries of unknown cause always exists."""
    marker = causes.sparkSession.range(1).select(
        F.lit(c.UNSPECIFIED_CAUSE).alias("code"),
        F.lit("No Especificada").alias("name"),
        F.lit("EXTERNA").alias("category"),
    )
    # At most one row is looked up; the catalogue itself is not moved.
    listed = causes.filter(F.col("code") == c.UNSPECIFIED_CAUSE).select("code").limit(1)
    return causes.unionByName(marker.join(listed, "code", "left_anti"))


def delay_causes(staging: DataFrame) -> Cleaned:
    verdict = judge(
        staging,
        c.normalize_code(F.col("code")),
        [],
        Repeat(
            "Clave natural repetida; se conserva el registro más reciente.",
            ("code", "name"),
        ),
    )
    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_code(F.col("code")).alias("code"),
            c.normalize_text(F.col("name")).alias("name"),
            c.code_or(F.col("category"), "EXTERNA").alias("category"),
        )

    return Cleaned(lambda judged: with_unspecified(rows(judged)), verdict)


def mark_known(rows: DataFrame, universe: DataFrame, code: str, natural: str, flag: str,
               *carry: str) -> DataFrame:
    """Flag rows whose ``code`` exists in ``universe``; optionally carry columns.

    Spark chooses the join by the real size of the universe, which a run has
    written before; a row without a code takes no part in the match.
    """
    known = universe.select(F.col(natural).alias(code), *carry, F.lit(True).alias(flag))
    return rows.join(known, code, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def absent_codes(rows: DataFrame, code: Column, universe: DataFrame, natural: str) -> DataFrame:
    """The codes of ``rows`` that ``universe`` lacks, each once.

    They are few where a universe is large, and only codes are shuffled to find
    them, so rows that meet them in place of the universe stay where they are.
    """
    codes = rows.select(code.alias("code")).filter("code IS NOT NULL").distinct()
    return codes.join(universe.select(F.col(natural).alias("code")), "code", "left_anti")


def mark_present(rows: DataFrame, absent: DataFrame, code: str, flag: str) -> DataFrame:
    """Flag rows as :func:`mark_known` does, by the codes that their universe lacks."""
    lacking = absent.select(F.col("code").alias(code), F.lit(True).alias("_absent"))
    return rows.join(lacking, code, "left").withColumn(
        flag, F.col(code).isNotNull() & F.col("_absent").isNull()
    ).drop("_absent")


def missing_references(*named: tuple[str, str]) -> Column:
    """Names of the absent references in the given order; "" when complete."""
    return F.concat_ws(", ", *[F.when(~F.col(flag), name) for flag, name in named])


UNREAD_OF_DELIVERIES = ("run_id", "source_id", "declared_value", "status", "is_active")


def absent_of_deliveries(staging: DataFrame, members: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Of each given universe, the codes that landed deliveries name and it lacks."""
    named = {
        "customers": (c.normalize_code(F.col("customer_code")), "code"),
        "vehicles": (c.normalize_plate(F.col("vehicle_plate")), "plate"),
    }
    return {g: absent_codes(staging, named[g][0], m, named[g][1]) for g, m in members.items()}


def deliveries(
    staging: DataFrame,
    customers: DataFrame,
    routes: DataFrame,
    vehicles: DataFrame,
    operators: DataFrame,
    causes: DataFrame,
    order: tuple[str, ...] = ("extracted_at", "id"),
    zone: str = "UTC",
    absent: Mapping[str, DataFrame] | None = None,
) -> Cleaned:
    """Deliveries; calendar keys are those of a clock in ``zone``.

    ``absent`` may hold the codes that rows name and the customers or vehicles
    lack; such a universe is not met itself.
    """
    absent = absent or {}
    # What neither a clean row nor a record of a refused one shows is not carried along.
    unread = [n for n in UNREAD_OF_DELIVERIES if n not in order]
    keyed = staging.drop(*unread).withColumns(
        {
            "_customer": c.normalize_code(F.col("customer_code")),
            "_route": c.normalize_code(F.col("route_code")),
            "_plate": c.normalize_plate(F.col("vehicle_plate")),
            "_operator": c.normalize_code(F.col("operator_number")),
            "_cause": c.normalize_code(F.col("delay_cause_code")),
        }
    )
    checked = mark_known(
        keyed,
        routes.withColumnRenamed("distance_km", "_distance"),
        "_route", "code", "_has_route", "_distance",
    )
    checked = mark_known(checked, operators, "_operator", "employee_number", "_has_operator")
    checked = mark_known(checked, causes, "_cause", "code", "_has_cause")
    for group, members, code, natural, flag in (
        ("vehicles", vehicles, "_plate", "plate", "_has_vehicle"),
        ("customers", customers, "_customer", "code", "_has_customer"),
    ):
        if group in absent:
            checked = mark_present(checked, absent[group], code, flag)
        else:
            checked = mark_known(checked, members, code, natural, flag)

    payload = (
        "folio", "customer_code", "route_code", "vehicle_plate", "operator_number",
        "scheduled_arrival", "actual_arrival", "actual_departure", "freight_cost",
    )
    departure = F.coalesce(F.col("actual_departure"), F.col("scheduled_departure"))
    missing = missing_references(
        ("_has_customer", "cliente"), ("_has_route", "ruta"),
        ("_has_vehicle", "vehículo"), ("_has_operator", "operador"),
    )
    verdict = judge(
        checked,
        c.normalize_code(F.col("folio")),
        [
            Rule(
                "is_non_negative", ~c.is_non_negative(F.col("freight_cost")),
                "El flete no puede ser negativo.", payload,
            ),
            Rule(
                "open_delivery", F.col("actual_arrival").isNull(),
                "Entrega sin llegada real; no forma parte del hecho.", payload,
            ),
            Rule(
                "dates_are_coherent",
                ~c.dates_are_coherent(departure, F.col("actual_arrival")),
                "La llegada real es anterior a la salida.", payload,
            ),
            Rule(
                "referential_integrity", missing != "",
                F.concat(F.lit("Referencia inexistente: "), missing, F.lit(".")), payload,
            ),
            _missing(
                "Falta una fecha programada.", payload,
                "scheduled_departure", "scheduled_arrival",
            ),
        ],
        Repeat("Folio vacío o repetido.", payload),
        order=order,
    )
    delay = d.delay_minutes(F.col("scheduled_arrival"), F.col("actual_arrival"))
    late = d.is_delayed(delay)
    cause = F.when(
        late == 1,
        F.when(F.col("_has_cause"), F.col("_cause")).otherwise(F.lit(c.UNSPECIFIED_CAUSE)),
    )
    def rows(judged: Verdict) -> DataFrame:
        kind = staging.schema["scheduled_departure"].dataType
        planned = d.wall_clock(
            F.col("scheduled_departure"), kind, zone, d.session_zone(staging)
        )
        return judged.accepted().select(
            c.normalize_code(F.col("folio")).alias("folio"),
            F.col("_customer").alias("customer_code"),
            F.col("_route").alias("route_code"),
            F.col("_plate").alias("vehicle_plate"),
            F.col("_operator").alias("operator_number"),
            cause.alias("delay_cause_code"),
            d.date_key(planned).alias("date_key"),
            d.time_key(planned).alias("time_key"),
            F.col("cargo_weight_kg"),
            F.coalesce(F.col("packages_count"), F.lit(0)).alias("packages_count"),
            F.col("freight_cost"),
            d.minutes(F.col("scheduled_departure"), F.col("scheduled_arrival")).alias(
                "planned_duration_min"
            ),
            d.minutes(departure, F.col("actual_arrival")).alias("actual_duration_min"),
            delay.alias("delay_minutes"),
            late.alias("is_delayed"),
            F.col("_distance").alias("distance_km"),
            d.cost_per_km(F.col("freight_cost"), F.col("_distance")).alias("cost_per_km"),
        )

    return Cleaned(rows, verdict)


def odometer_chain(staging: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Kilometres since the vehicle's previous reading, over *all* landed rows.

    The chain belongs to the vehicle: a row that is refused later still proves
    that the vehicle passed that kilometre.
    """
    placed = staging.withColumns(
        {
            "_plate": c.normalize_plate(F.col("vehicle_plate")),
            "_moment": F.coalesce(
                F.col("load_datetime"),
                F.lit(FAR_FUTURE).cast(staging.schema["load_datetime"].dataType),
            ),
        }
    )
    chained = before_each(
        placed,
        group="_plate",
        value="odometer_km",
        order=("vehicle_plate", "_moment", "id"),
        buckets=(
            {
                "_spelling": F.col("vehicle_plate"),
                "_minute": F.date_format("_moment", "yyyyMMddHHmm"),
            },
            {"_instant": F.col("_moment"), "_chunk": F.floor(F.col("id") / 1_000_000)},
        ),
        out="_last_odometer",
        hot_rows=hot_rows,
    )
    return chained.withColumn("_travelled", F.col("odometer_km") - F.col("_last_odometer"))


def fuel_loads(
    staging: DataFrame,
    vehicles: DataFrame,
    operators: DataFrame,
    hot_rows: int = HOT_ROWS,
    zone: str = "UTC",
    only: Column | None = None,
) -> Cleaned:
    """Fuel loads; calendar keys are those of a clock in ``zone``.

    All rows make the chain of readings; with ``only``, those it holds for are judged.
    """
    chained = odometer_chain(staging, hot_rows)
    if only is not None:
        chained = chained.filter(only)
    chained = chained.withColumns(
        {
            "_operator": c.normalize_code(F.col("operator_number")),
            "_efficiency": d.efficiency(F.col("_travelled"), F.col("liters")),
        }
    )
    checked = mark_known(chained, vehicles, "_plate", "plate", "_has_vehicle")
    checked = mark_known(checked, operators, "_operator", "employee_number", "_has_operator")
    payload = ("folio", "vehicle_plate", "liters", "odometer_km")
    verdict = judge(
        checked,
        c.normalize_code(F.col("folio")),
        [
            Rule(
                "is_positive", ~c.is_positive(F.col("liters")),
                "Los litros deben ser mayores que cero.", payload,
            ),
            Rule(
                "referential_integrity", ~(F.col("_has_vehicle") & F.col("_has_operator")),
                "Vehículo u operador inexistente.", payload,
            ),
            Rule(
                "is_efficiency_outlier", c.is_efficiency_outlier(F.col("_efficiency")),
                F.concat(
                    F.lit(
                        f"Rendimiento fuera del rango [{c.EFFICIENCY_LOW}, "
                        f"{c.EFFICIENCY_HIGH}]: "
                    ),
                    F.col("_efficiency").cast("string"),
                    F.lit(" km/L."),
                ),
                payload,
            ),
            _missing("Falta la fecha de carga.", payload, "load_datetime"),
        ],
        Repeat("Folio vacío o repetido.", payload),
        order=("vehicle_plate", "load_datetime", "id"),
        newest_first=False,
    )
    kind = staging.schema["load_datetime"].dataType
    loaded = d.wall_clock(F.col("load_datetime"), kind, zone, d.session_zone(staging))

    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_code(F.col("folio")).alias("folio"),
            F.col("_plate").alias("vehicle_plate"),
            F.col("_operator").alias("operator_number"),
            d.date_key(loaded).alias("date_key"),
            d.time_key(loaded).alias("time_key"),
            F.col("liters"),
            F.col("price_per_liter"),
            F.col("total_cost"),
            F.col("_travelled").alias("km_traveled"),
            F.col("_efficiency").alias("efficiency_km_per_liter"),
        )

    return Cleaned(rows, verdict)


def maintenances(
    staging: DataFrame, vehicles: DataFrame
) -> Cleaned:
    checked = mark_known(
        staging.withColumn("_plate", c.normalize_plate(F.col("vehicle_plate"))),
        vehicles, "_plate", "plate", "_has_vehicle",
    )
    payload = ("folio", "vehicle_plate", "total_cost", "service_date")
    verdict = judge(
        checked,
        c.normalize_code(F.col("folio")),
        [
            Rule(
                "referential_integrity", ~F.col("_has_vehicle"),
                "Vehículo inexistente.", payload,
            ),
            Rule(
                "is_non_negative", ~c.is_non_negative(F.col("total_cost")),
                "El costo total no puede ser negativo.", payload,
            ),
            _missing("Falta la fecha de servicio.", payload, "service_date"),
        ],
        Repeat("Folio vacío o repetido.", payload),
    )
    def rows(judged: Verdict) -> DataFrame:
        return judged.accepted().select(
            c.normalize_code(F.col("folio")).alias("folio"),
            F.col("_plate").alias("vehicle_plate"),
            d.date_key(F.col("service_date")).alias("date_key"),
            c.normalize_code(F.col("maintenance_type")).alias("maintenance_type"),
            F.col("labor_cost"),
            F.col("parts_cost"),
            F.col("total_cost"),
            F.coalesce(F.col("days_out_of_service"), F.lit(0)).alias("days_out_of_service"),
            F.col("odometer_km"),
        )

    return Cleaned(rows, verdict)


# Staging table of every clean group.
SOURCE_OF = {
    "customers": "stg_customer",
    "vehicles": "stg_vehicle",
    "operators": "stg_operator",
    "routes": "stg_route",
    "delay_causes": "stg_delay_cause",
    "deliveries": "stg_delivery",
    "fuel_loads": "stg_fuel_load",
    "maintenances": "stg_maintenance",
}


def clean_dimensions(
    staging: Mapping[str, DataFrame], as_of: dt.date
) -> dict[str, Cleaned]:
    return {
        "customers": customers(staging["stg_customer"]),
        "vehicles": vehicles(staging["stg_vehicle"], as_of),
        "operators": operators(staging["stg_operator"], as_of),
        "routes": routes(staging["stg_route"]),
        "delay_causes": delay_causes(staging["stg_delay_cause"]),
    }


def clean_facts(
    staging: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    hot_rows: int = HOT_ROWS,
    delivery_order: tuple[str, ...] = ("extracted_at", "id"),
    zone: str = "UTC",
    fuel_only: Column | None = None,
    absent: Mapping[str, DataFrame] | None = None,
) -> dict[str, Cleaned]:
    return {
        "deliveries": deliveries(
            staging["stg_delivery"], dims["customers"], dims["routes"], dims["vehicles"],
            dims["operators"], dims["delay_causes"], delivery_order, zone, absent,
        ),
        "fuel_loads": fuel_loads(
            staging["stg_fuel_load"], dims["vehicles"], dims["operators"], hot_rows, zone, fuel_only
        ),
        "maintenances": maintenances(staging["stg_maintenance"], dims["vehicles"]),
    }

"""The standing business questions, each one DataFrame.

Facts are aggregated on their key first and meet the dimension afterwards, so
the join sees one row per member instead of one per fact. Every top-k breaks
ties on the natural key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.functions import render as r
from haulmart.plans.period import ALL, Period, scope
from haulmart.plans.star import Star, member

def _shipments() -> Column:
    return F.count(F.lit(1))


def _late() -> Column:
    return F.count_if(F.col("is_delayed") == 1)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def is_empty(star: Star) -> bool:
    return star["fact_delivery"].isEmpty()


def data_bounds(star: Star) -> DataFrame:
    """First and last day with deliveries."""
    keys = star["fact_delivery"].agg(
        F.min("date_id").alias("first"), F.max("date_id").alias("last")
    )
    return keys.select(
        *[
            F.to_date(F.col(c).cast("string"), "yyyyMMdd").alias(f"{c}_day")
            for c in ("first", "last")
        ]
    )


def kpi_summary(star: Star, period: Period = ALL) -> DataFrame:
    """Headline numbers in one row; zeros for an empty period.

    The three facts are stacked with a shared layout and reduced in a single
    aggregate instead of joining three one-row results.
    """
    layout = {
        "delivered": "bigint", "late": "bigint", "delay": "bigint", "freight": "decimal(18,2)",
        "km": "decimal(18,2)", "fuel_cost": "decimal(18,2)", "efficiency": "decimal(18,2)",
        "maintenance_cost": "decimal(18,2)",
    }

    def lay(fact: DataFrame, **given: Column) -> DataFrame:
        return fact.select(
            *[
                given.get(name, F.lit(None)).cast(kind).alias(name)
                for name, kind in layout.items()
            ]
        )

    stacked = (
        lay(
            scope(star["fact_delivery"], period),
            delivered=F.lit(1), late=F.col("is_delayed"), delay=F.col("delay_minutes"),
            freight=F.col("freight_cost"), km=F.col("distance_km"),
        )
        .unionByName(
            lay(
                scope(star["fact_fuel"], period),
                fuel_cost=F.col("total_cost"), efficiency=F.col("efficiency_km_per_liter"),
            )
        )
        .unionByName(
            lay(scope(star["fact_maintenance"], period), maintenance_cost=F.col("total_cost"))
        )
    )
    sums = stacked.agg(
        F.count("delivered").alias("deliveries"),
        F.count_if(F.col("late") == 1).alias("delayed"),
        r.mean(F.col("delay")).alias("delay"),
        r.mean(F.when(F.col("late") == 1, F.col("delay"))).alias("delay_when_late"),
        _total("freight").alias("total_freight"),
        _total("km").alias("total_km"),
        r.mean(F.col("efficiency")).alias("efficiency"),
        _total("fuel_cost").alias("fuel_cost"),
        _total("maintenance_cost").alias("maintenance_cost"),
    )

    def shown(column: str, digits: int) -> Column:
        return F.coalesce(r.rounded(F.col(column), digits), F.lit(0.0))

    return sums.select(
        "deliveries",
        "delayed",
        r.percent(F.col("deliveries") - F.col("delayed"), F.col("deliveries")).alias(
            "on_time_rate"
        ),
        shown("delay", 1).alias("avg_delay_minutes"),
        shown("delay_when_late", 1).alias("avg_delay_when_late"),
        "total_freight",
        "total_km",
        shown("efficiency", 2).alias("avg_efficiency"),
        "fuel_cost",
        "maintenance_cost",
    )


def monthly_trend(star: Star, period: Period = ALL) -> DataFrame:
    month = F.floor(F.col("date_id") / 100).cast("int")
    totals = (
        scope(star["fact_delivery"], period)
        .groupBy(month.alias("year_month"))
        .agg(
            _shipments().alias("deliveries"),
            _late().alias("delayed"),
            _total("freight_cost").alias("freight"),
        )
    )
    name = r.month_name(F.col("year_month") % 100)
    year = F.floor(F.col("year_month") / 100).cast("string")
    return totals.orderBy("year_month").select(
        "year_month",
        F.concat_ws(" ", F.substring(name, 1, 3), year).alias("label"),
        "deliveries", "delayed", "freight",
    )


def _route_totals(star: Star, period: Period, *extra: Column) -> DataFrame:
    return (
        scope(star["fact_delivery"], period)
        .groupBy("route_id")
        .agg(_shipments().alias("shipments"), _late().alias("delayed"), *extra)
    )


def top_routes(star: Star, limit: int = 10, period: Period = ALL) -> DataFrame:
    """Busiest routes with their delay rate."""
    totals = member(
        _route_totals(star, period), star, "dim_route", "route_id", "code", "name", "zone"
    )
    return totals.orderBy(F.col("shipments").desc(), "code").limit(limit).select(
        "code", "name", "zone", "shipments",
        r.percent(F.col("delayed"), F.col("shipments")).alias("delay_rate"),
    )


def worst_routes(
    star: Star, limit: int = 10, period: Period = ALL, minimum: int = 20
) -> DataFrame:
    """Routes with the longest mean delay among those with enough shipments."""
    totals = _route_totals(star, period, r.mean(F.col("delay_minutes")).alias("mean_delay"))
    named = member(
        totals.filter(F.col("shipments") >= minimum),
        star, "dim_route", "route_id", "code", "name", "zone",
    )
    return named.orderBy(F.col("mean_delay").desc(), "code").limit(limit).select(
        "code", "name", "zone", "shipments",
        r.percent(F.col("delayed"), F.col("shipments")).alias("delay_rate"),
        r.rounded(F.col("mean_delay"), 1).alias("avg_delay"),
    )


def top_operators(star: Star, limit: int = 10, period: Period = ALL) -> DataFrame:
    totals = (
        scope(star["fact_delivery"], period)
        .groupBy("operator_id")
        .agg(_shipments().alias("deliveries"), _late().alias("delayed"))
    )
    named = member(totals, star, "dim_operator", "operator_id", "employee_number", "full_name")
    return named.orderBy(F.col("deliveries").desc(), "employee_number").limit(limit).select(
        "employee_number", "full_name", "deliveries",
        r.percent(F.col("delayed"), F.col("deliveries")).alias("delay_rate"),
    )


def demand_by_service_type(star: Star, period: Period = ALL) -> DataFrame:
    """Shipments, share of the total and distinct routes per kind of corridor."""
    per_route = member(
        _route_totals(star, period, _total("freight_cost").alias("freight")),
        star, "dim_route", "route_id", "route_type",
    )
    totals = per_route.groupBy(F.col("route_type").alias("service_type")).agg(
        F.sum("shipments").alias("shipments"),
        F.sum("delayed").alias("delayed"),
        F.sum("freight").alias("freight"),
        F.count(F.lit(1)).alias("routes"),
    )
    # One row per service type is left at this point.
    everything = F.sum("shipments").over(Window.partitionBy())
    return totals.select(
        "service_type", "shipments",
        r.percent(F.col("shipments"), everything).alias("share"),
        r.percent(F.col("delayed"), F.col("shipments")).alias("delay_rate"),
        "freight", "routes",
    ).orderBy(F.col("shipments").desc(), "service_type")


def top_customers(star: Star, limit: int = 10, period: Period = ALL) -> DataFrame:
    totals = (
        scope(star["fact_delivery"], period)
        .groupBy("customer_id")
        .agg(
            _shipments().alias("shipments"),
            _late().alias("delayed"),
            _total("freight_cost").alias("freight"),
        )
    )
    named = member(
        totals, star, "dim_customer", "customer_id",
        "code", "business_name", "city", "customer_type",
    )
    return named.orderBy(F.col("shipments").desc(), "code").limit(limit).select(
        "code", "business_name", "city", "customer_type", "shipments",
        r.percent(F.col("delayed"), F.col("shipments")).alias("delay_rate"),
        "freight",
    )


def week_grid(star: Star) -> DataFrame:
    """All 168 hours of a week, Monday = 0."""
    slot = F.col("id").cast("int")
    return star["fact_delivery"].sparkSession.range(7 * 24).select(
        F.floor(slot / 24).cast("int").alias("day_of_week"), (slot % 24).alias("hour")
    )


def hour_heatmap(star: Star, period: Period = ALL) -> DataFrame:
    """Departures per weekday and hour, empty cells included; peak for scaling."""
    day = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    # Weekdays are worked out once per date, not once per delivery.
    per_slot = (
        scope(star["fact_delivery"], period)
        .groupBy("date_id", "time_id")
        .agg(_shipments().alias("total"))
        .groupBy(F.weekday(day).alias("day_of_week"), F.col("time_id").alias("hour"))
        .agg(F.sum("total").alias("total"))
    )
    dense = (
        week_grid(star)
        .join(per_slot, ["day_of_week", "hour"], "left")
        .withColumn("total", F.coalesce(F.col("total"), F.lit(0)))
    )
    return dense.select(
        "day_of_week", r.day_name(F.col("day_of_week")).alias("day_name"), "hour", "total",
        F.max("total").over(Window.partitionBy()).alias("peak"),
    ).orderBy("day_of_week", "hour")


def delay_causes_pareto(star: Star, period: Period = ALL) -> DataFrame:
    """Causes by frequency with the cumulative percentage."""
    per_cause = (
        scope(star["fact_delivery"], period)
        .filter(F.col("delay_cause_id").isNotNull())
        .groupBy("delay_cause_id")
        .agg(_shipments().alias("total"))
    )
    named = (
        member(per_cause, star, "dim_delay_cause", "delay_cause_id", "name")
        .groupBy(F.col("name").alias("cause"))
        .agg(F.sum("total").alias("total"))
    )
    # One row per catalogue entry is left at this point.
    ranked = Window.orderBy(F.col("total").desc(), "cause")
    running = F.sum("total").over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    everything = F.sum("total").over(Window.partitionBy())
    return named.select(
        "cause", "total", r.percent(running, everything).alias("cumulative")
    ).orderBy(F.col("total").desc(), "cause")


def cost_by_vehicle(star: Star, limit: int | None = 15, period: Period = ALL) -> DataFrame:
    """Fuel plus maintenance, also of vehicles without any; all of them, unordered, without a limit."""

    def per_vehicle(fact: str, name: str) -> DataFrame:
        return scope(star[fact], period).groupBy(F.col("vehicle_id").alias("vehicle_key")).agg(
            F.sum("total_cost").alias(name)
        )

    costs = (
        star["dim_vehicle"]
        .join(per_vehicle("fact_fuel", "fuel"), "vehicle_key", "left")
        .join(per_vehicle("fact_maintenance", "maintenance"), "vehicle_key", "left")
    )
    fuel = F.coalesce(F.col("fuel"), F.lit(0)).cast("decimal(20,2)")
    maintenance = F.coalesce(F.col("maintenance"), F.lit(0)).cast("decimal(20,2)")
    totals = costs.select(
        "economic_number", "plate", "vehicle_type", "age_range",
        fuel.alias("fuel_cost"), maintenance.alias("maintenance_cost"),
        (fuel + maintenance).alias("total_cost"),
    )
    if limit is None:
        return totals
    return totals.orderBy(F.col("total_cost").desc(), "plate").limit(limit)


def efficiency_by_vehicle(star: Star, limit: int = 15, period: Period = ALL) -> DataFrame:
    """Mean kilometres per litre of each vehicle's loads, worst first."""
    per_vehicle = (
        scope(star["fact_fuel"], period)
        .filter(F.col("efficiency_km_per_liter").isNotNull())
        .groupBy("vehicle_id")
        .agg(
            F.sum("efficiency_km_per_liter").alias("sum"),
            F.count("efficiency_km_per_liter").alias("loads"),
            F.sum("liters").alias("liters"),
        )
    )
    shown = ("economic_number", "vehicle_type", "age_range")
    ranked = (
        member(per_vehicle, star, "dim_vehicle", "vehicle_id", *shown)
        .groupBy(*shown)
        .agg(
            (F.sum("sum").cast("double") / F.sum("loads").cast("double")).alias("mean"),
            F.sum("liters").alias("liters"),
        )
        .orderBy("mean", *shown)
        .limit(limit)
    )
    return ranked.select(*shown, r.rounded(F.col("mean"), 2).alias("efficiency"), "liters")


def cost_per_km_by_route(star: Star, limit: int = 15, period: Period = ALL) -> DataFrame:
    """Mean of the per-delivery ratios, dearest first."""
    totals = _route_totals(star, period, r.mean(F.col("cost_per_km")).alias("mean"))
    named = member(totals, star, "dim_route", "route_id", "code", "name")
    return named.orderBy(F.col("mean").desc(), "code").limit(limit).select(
        "code", "name", r.rounded(F.col("mean"), 2).alias("cost_per_km"), "shipments"
    )


def annotate(report: DataFrame, label: str, value: str, position: str) -> DataFrame:
    """Add a series' mean, peak, where the peak is, and each percent of total.

    For finished reports, whose rows are few; of tied peaks the one that comes
    first by ``position`` is named.
    """
    whole = Window.partitionBy()
    number = F.col(value).cast("double")
    highest = F.min(
        F.struct((-number).alias("n"), F.col(position).alias("p"), F.col(label).alias("l"))
    )
    share = F.try_divide(number, F.sum(number).over(whole)) * 100
    return report.select(
        "*",
        F.avg(number).over(whole).alias("series_mean"),
        F.max(number).over(whole).alias("peak_value"),
        highest.over(whole)["l"].alias("peak_label"),
        F.coalesce(share, F.lit(0.0)).alias("percent_of_total"),
    )


# -- registry ---------------------------------------------------------------


@dataclass(frozen=True)
class Report:
    label: str
    build: Callable[[Star, Period], DataFrame]
    columns: tuple[tuple[str, str], ...]


# Slug, title, row cap and column headings of each report.
REPORTS = {
    "rutas": Report(
        "Rutas más utilizadas",
        lambda star, period: top_routes(star, 100, period),
        (("code", "Código"), ("name", "Ruta"), ("zone", "Zona"), ("shipments", "Envíos"),
         ("delay_rate", "% retraso")),
    ),
    "rutas-retrasadas": Report(
        "Rutas con mayores retrasos",
        lambda star, period: worst_routes(star, 100, period),
        (("code", "Código"), ("name", "Ruta"), ("zone", "Zona"), ("shipments", "Envíos"),
         ("avg_delay", "Retraso promedio (min)"), ("delay_rate", "% retraso")),
    ),
    "operadores": Report(
        "Operadores con más entregas",
        lambda star, period: top_operators(star, 100, period),
        (("employee_number", "Empleado"), ("full_name", "Nombre"), ("deliveries", "Entregas"),
         ("delay_rate", "% retraso")),
    ),
    "costos-vehiculo": Report(
        "Costo total por vehículo",
        lambda star, period: cost_by_vehicle(star, 200, period),
        (("economic_number", "Económico"), ("plate", "Placa"), ("vehicle_type", "Tipo"),
         ("age_range", "Antigüedad"), ("fuel_cost", "Combustible"),
         ("maintenance_cost", "Mantenimiento"), ("total_cost", "Total")),
    ),
    "rendimiento": Report(
        "Rendimiento por vehículo",
        lambda star, period: efficiency_by_vehicle(star, 200, period),
        (("economic_number", "Económico"), ("vehicle_type", "Tipo"),
         ("age_range", "Antigüedad"), ("efficiency", "km/L"), ("liters", "Litros")),
    ),
    "demanda-servicio": Report(
        "Demanda por tipo de servicio",
        lambda star, period: demand_by_service_type(star, period),
        (("service_type", "Servicio"), ("shipments", "Envíos"), ("share", "Participación %"),
         ("delay_rate", "% retraso"), ("freight", "Flete"), ("routes", "Rutas")),
    ),
    "demanda-cliente": Report(
        "Clientes con mayor demanda",
        lambda star, period: top_customers(star, 200, period),
        (("code", "Código"), ("business_name", "Cliente"), ("city", "Ciudad"),
         ("customer_type", "Tipo"), ("shipments", "Envíos"), ("delay_rate", "% retraso"),
         ("freight", "Flete")),
    ),
    "costo-por-km": Report(
        "Costo por kilómetro por ruta",
        lambda star, period: cost_per_km_by_route(star, 200, period),
        (("code", "Código"), ("name", "Ruta"), ("cost_per_km", "Costo por km"),
         ("shipments", "Envíos")),
    ),
}


def report(star: Star, slug: str, period: Period = ALL) -> DataFrame:
    """A registered report under its display headings, in display order."""
    if slug not in REPORTS:
        raise ValueError(f"Reporte desconocido: {slug}")
    spec = REPORTS[slug]
    return spec.build(star, period).select(
        *[F.col(key).alias(heading) for key, heading in spec.columns]
    )


def write_csv(star: Star, slug: str, path: str, period: Period = ALL) -> None:
    """One CSV file with headings; a report is a few hundred rows at most."""
    report(star, slug, period).coalesce(1).write.mode("overwrite").option("header", True).option(
        "encoding", "UTF-8"
    ).csv(path)

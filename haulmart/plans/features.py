"""Feature tables for mining, assembled from the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions import cleaning as c
from haulmart.functions import derive as d
from haulmart.plans.star import Star, member

# Known only after arrival, so never features.
LEAKAGE_COLUMNS = frozenset(
    {
        "actual_departure", "actual_arrival", "status", "delay_cause",
        "delay_cause_code", "actual_duration_min", "delay_minutes", "is_delayed",
    }
)
# The feature contract shared by training and scoring.
NUMERIC_FEATURES = (
    "distance_km", "planned_duration_min", "cargo_weight_kg", "packages_count", "day_of_week",
)
CATEGORICAL_FEATURES = (
    "route_code", "route_type", "zone", "distance_range", "time_band", "vehicle_type",
    "vehicle_age_range", "operator_seniority_range", "customer_type", "is_weekend",
)
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
CLASSIFICATION_TARGET = "is_delayed"
REGRESSION_TARGET = "delay_minutes"
PROFILE_FEATURES = (
    "distance_km", "avg_duration_min", "delay_rate", "avg_delay_minutes", "avg_cargo_kg",
    "avg_cost_per_km", "monthly_shipments",
)


def check_leakage(columns: tuple[str, ...] = FEATURE_COLUMNS) -> None:
    leaked = sorted(LEAKAGE_COLUMNS.intersection(columns))
    if leaked:
        raise ValueError(f"columns known only after arrival: {', '.join(leaked)}")


def _weekend(weekday: Column) -> Column:
    return F.when(weekday >= 5, "true").otherwise("false")


def delivery_features(star: Star) -> DataFrame:
    """One row per delivery: folio, 15 features, both targets."""
    check_leakage()
    day = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    rows = star["fact_delivery"].select(
        "folio", "route_id", "vehicle_id", "operator_id", "customer_id",
        F.col("distance_km").cast("double").alias("distance_km"),
        F.col("planned_duration_min"),
        F.col("cargo_weight_kg").cast("double").alias("cargo_weight_kg"),
        F.col("packages_count"),
        F.weekday(day).alias("day_of_week"),
        d.time_band(F.col("time_id")).alias("time_band"),
        "delay_minutes", "is_delayed",
    )
    rows = member(rows, star, "dim_route", "route_id",
                  F.col("code").alias("route_code"), "route_type", "zone", "distance_range")
    rows = member(rows, star, "dim_vehicle", "vehicle_id",
                  "vehicle_type", F.col("age_range").alias("vehicle_age_range"))
    rows = member(rows, star, "dim_operator", "operator_id",
                  F.col("seniority_range").alias("operator_seniority_range"))
    rows = member(rows, star, "dim_customer", "customer_id", "customer_type")
    return rows.withColumn("is_weekend", _weekend(F.col("day_of_week"))).select(
        "folio", *FEATURE_COLUMNS, REGRESSION_TARGET, CLASSIFICATION_TARGET
    )


def route_profile(star: Star) -> DataFrame:
    """One row per route that ever ran, with its mean behaviour."""
    # Months are counted on (route, month) partial totals, so no distinct set
    # of a busy route is ever gathered.
    month = F.floor(F.col("date_id") / 100)
    measures = {
        "distance_km": "distance_km",
        "avg_duration_min": "actual_duration_min",
        "delay_rate": "is_delayed",
        "avg_delay_minutes": "delay_minutes",
        "avg_cargo_kg": "cargo_weight_kg",
        "avg_cost_per_km": "cost_per_km",
    }
    monthly = star["fact_delivery"].groupBy("route_id", month.alias("_month")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(m).alias(f"_sum_{a}") for a, m in measures.items()],
        *[F.count(m).alias(f"_cnt_{a}") for a, m in measures.items()],
    )
    totals = monthly.groupBy("route_id").agg(
        *[
            F.coalesce(
                F.try_divide(
                    F.sum(f"_sum_{a}").cast("double"), F.sum(f"_cnt_{a}").cast("double")
                ),
                F.lit(0.0),
            ).alias(a)
            for a in measures
        ],
        F.coalesce(
            F.try_divide(F.sum("_n").cast("double"), F.count("_month").cast("double")),
            F.lit(0.0),
        ).alias("monthly_shipments"),
    )
    return member(
        totals, star, "dim_route", "route_id",
        F.col("code").alias("route_code"), F.col("name").alias("route_name"),
        "route_type", "zone",
    ).select("route_code", "route_name", "route_type", "zone", *PROFILE_FEATURES)


def planned_features(plans: DataFrame, routes: DataFrame) -> DataFrame:
    """Features of deliveries still to be made.

    ``plans`` holds one row per plan: ``plan_id``, ``route_code``,
    ``departure_hour``, ``day_of_week``, ``cargo_weight_kg``,
    ``packages_count`` and the four chosen categories. Spelling of the weekend
    flag is the one used in training.
    """
    corridor = routes.select(
        F.col("code").alias("route_code"),
        F.col("distance_km").cast("double").alias("distance_km"),
        F.col("estimated_duration_min").cast("int").alias("planned_duration_min"),
        "route_type", "zone",
        c.distance_range(F.col("distance_km")).alias("distance_range"),
    )
    return (
        plans.join(corridor, "route_code")
        .withColumns(
            {
                "cargo_weight_kg": F.col("cargo_weight_kg").cast("double"),
                "time_band": d.time_band(F.col("departure_hour")),
                "is_weekend": _weekend(F.col("day_of_week")),
            }
        )
        .select("plan_id", *FEATURE_COLUMNS)
    )

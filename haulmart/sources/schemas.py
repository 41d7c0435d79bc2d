"""Declared schemas of landing, warehouse and control tables."""

from __future__ import annotations

from pyspark.sql import types as T

_PROVENANCE = "id bigint, run_id string, source_id bigint, extracted_at timestamp"

STAGING_DDL = {
    "stg_customer": "code string, business_name string, tax_id string, city string, "
    "state string, customer_type string, is_active boolean",
    "stg_vehicle": "plate string, economic_number string, brand string, model string, "
    "year int, vehicle_type string, cargo_capacity_kg decimal(14,2), fuel_type string, "
    "is_active boolean",
    "stg_operator": "employee_number string, first_name string, last_name string, "
    "license_type string, hire_date date, is_active boolean",
    "stg_route": "code string, name string, origin_city string, destination_city string, "
    "distance_km decimal(14,2), estimated_duration_min int, route_type string, "
    "zone string, is_active boolean",
    "stg_delay_cause": "code string, name string, category string, is_active boolean",
    "stg_delivery": "folio string, customer_code string, route_code string, "
    "vehicle_plate string, operator_number string, delay_cause_code string, "
    "scheduled_departure timestamp, actual_departure timestamp, "
    "scheduled_arrival timestamp, actual_arrival timestamp, "
    "cargo_weight_kg decimal(14,2), packages_count int, declared_value decimal(16,2), "
    "freight_cost decimal(14,2), status string, is_active boolean",
    "stg_fuel_load": "folio string, vehicle_plate string, operator_number string, "
    "load_datetime timestamp, liters decimal(14,2), price_per_liter decimal(10,2), "
    "total_cost decimal(14,2), odometer_km decimal(16,2), is_active boolean",
    "stg_maintenance": "folio string, vehicle_plate string, maintenance_type string, "
    "service_date date, odometer_km decimal(16,2), labor_cost decimal(14,2), "
    "parts_cost decimal(14,2), total_cost decimal(14,2), days_out_of_service int, "
    "status string, is_active boolean",
}

DIMENSION_DDL = {
    "dim_date": "date_key int, full_date date, year int, quarter int, month int, "
    "month_name string, week int, day int, day_of_week int, day_name string, "
    "fortnight int, is_weekend boolean",
    "dim_time": "time_key int, hour int, time_band string",
    "dim_customer": "customer_key bigint, code string, business_name string, "
    "city string, state string, customer_type string",
    "dim_vehicle": "vehicle_key bigint, plate string, economic_number string, "
    "brand string, model string, year int, vehicle_type string, age_range string, "
    "capacity_range string",
    "dim_operator": "operator_key bigint, employee_number string, full_name string, "
    "license_type string, seniority_range string",
    "dim_route": "route_key bigint, code string, name string, origin_city string, "
    "destination_city string, distance_km decimal(8,2), distance_range string, "
    "route_type string, zone string",
    "dim_delay_cause": "delay_cause_key bigint, code string, name string, category string",
}

FACT_DDL = {
    "fact_delivery": "folio string, date_id int, time_id int, customer_id bigint, "
    "route_id bigint, vehicle_id bigint, operator_id bigint, delay_cause_id bigint, "
    "cargo_weight_kg decimal(10,2), packages_count int, freight_cost decimal(10,2), "
    "planned_duration_min int, actual_duration_min int, delay_minutes int, "
    "is_delayed int, distance_km decimal(8,2), cost_per_km decimal(10,4)",
    "fact_fuel": "folio string, date_id int, time_id int, vehicle_id bigint, "
    "operator_id bigint, liters decimal(8,2), price_per_liter decimal(6,2), "
    "total_cost decimal(10,2), km_traveled decimal(10,2), "
    "efficiency_km_per_liter decimal(6,2)",
    "fact_maintenance": "folio string, date_id int, vehicle_id bigint, "
    "maintenance_type string, labor_cost decimal(10,2), parts_cost decimal(10,2), "
    "total_cost decimal(10,2), days_out_of_service int, odometer_km decimal(12,2)",
}

CONTROL_DDL = {
    "etl_log": "run_id string, phase string, table_name string, started_at timestamp, "
    "finished_at timestamp, rows_read bigint, rows_written bigint, rows_rejected bigint, "
    "status string, message string",
    "etl_error": "run_id string, source_table string, source_pk string, rule string, "
    "description string, raw_payload string, detected_at timestamp",
    "commits": "seq bigint, run_id string, rebuilt boolean, committed_at timestamp",
    "landings": "seq bigint, run_id string, whole boolean, landed_at timestamp",
}


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def staging_schema(table: str) -> T.StructType:
    return schema(f"{_PROVENANCE}, {STAGING_DDL[table]}")


def staging_columns(table: str) -> list[str]:
    return schema(STAGING_DDL[table]).fieldNames()


def warehouse_schema(table: str) -> T.StructType:
    return schema({**DIMENSION_DDL, **FACT_DDL, **CONTROL_DDL}[table])

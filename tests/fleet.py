"""A small fleet for tests: operational tables with two of everything."""

import datetime as dt
from decimal import Decimal

T0 = dt.datetime(2026, 1, 1)

DDL = {
    "customer": "id bigint, code string, business_name string, tax_id string, city string, "
    "state string, customer_type string, is_active boolean, updated_at timestamp",
    "vehicle": "id bigint, plate string, economic_number string, brand string, model string, "
    "year int, vehicle_type string, cargo_capacity_kg decimal(14,2), fuel_type string, "
    "current_odometer_km decimal(12,2), next_service_km decimal(12,2), "
    "last_service_date date, status string, is_active boolean, updated_at timestamp",
    "operator": "id bigint, employee_number string, first_name string, last_name string, "
    "license_type string, hire_date date, is_active boolean, updated_at timestamp",
    "route": "id bigint, code string, name string, origin_city string, destination_city string, "
    "distance_km decimal(14,2), estimated_duration_min int, route_type string, zone string, "
    "is_active boolean, updated_at timestamp",
    "delay_cause": "id bigint, code string, name string, category string, is_active boolean, "
    "updated_at timestamp",
    "delivery": "id bigint, folio string, customer_id bigint, route_id bigint, vehicle_id bigint, "
    "operator_id bigint, delay_cause_id bigint, scheduled_departure timestamp, "
    "actual_departure timestamp, scheduled_arrival timestamp, actual_arrival timestamp, "
    "cargo_weight_kg decimal(14,2), packages_count int, declared_value decimal(16,2), "
    "freight_cost decimal(14,2), status string, is_active boolean, updated_at timestamp",
    "fuel_load": "id bigint, folio string, vehicle_id bigint, operator_id bigint, "
    "load_datetime timestamp, liters decimal(14,2), price_per_liter decimal(10,2), "
    "total_cost decimal(14,2), odometer_km decimal(16,2), is_active boolean, updated_at timestamp",
    "maintenance": "id bigint, folio string, vehicle_id bigint, maintenance_type string, "
    "service_date date, odometer_km decimal(16,2), labor_cost decimal(14,2), "
    "parts_cost decimal(14,2), total_cost decimal(14,2), next_service_km decimal(12,2), "
    "days_out_of_service int, status string, is_active boolean, updated_at timestamp",
}


def rows():
    d = Decimal
    dep = dt.datetime(2026, 1, 5, 8)
    arr = dep + dt.timedelta(hours=1)

    def trip(i, folio, late, **over):
        base = dict(customer=1, status="DELIVERED", freight=d("1000.00"),
                    arrival=arr + dt.timedelta(minutes=late), cause=None)
        base |= over
        return (i, folio, base["customer"], 1, 1, 1, base["cause"], dep, None, arr,
                base["arrival"], d("100.00"), 3, d("0.00"), base["freight"], base["status"], True, T0)

    def load(i, day, km, liters):
        return (i, f"COM-{i}", 1, 1, dt.datetime(2026, 1, day, 9), d(liters), d("25.00"),
                d(liters) * 25, d(km), True, T0)

    return {
        "customer": [(1, "CLI-0001", "uno", "R1", "toluca", "mexico", "PREMIUM", True, T0),
                     (2, "CLI-0002", "dos", "R2", None, "mexico", None, False, T0)],
        "vehicle": [
            (1, "ABC-1234", "ECO-1", "kenworth", "t680", 2022, "TRUCK", d("20000"), "DIESEL",
             d("50000"), d("49000"), dt.date(2026, 7, 1), "ON_ROUTE", True, T0),
            (2, "XYZ-9", "ECO-2", "ford", "transit", 2015, "VAN", d("1500"), "DIESEL",
             d("1000"), d("1800"), dt.date(2026, 8, 1), "AVAILABLE", True, T0),
            (3, "SIN-1", "ECO-3", "ford", "x", 2015, "VAN", d("1500"), "DIESEL",
             d("1000"), d("90000"), None, "AVAILABLE", True, T0),
            (4, "FUE-1", "ECO-4", "ford", "x", 2015, "VAN", d("1500"), "DIESEL",
             d("1000"), d("900"), None, "OUT_OF_SERVICE", True, T0)],
        "operator": [(1, "OP-0001", "ana", "díaz", "E", dt.date(2020, 1, 1), True, T0)],
        "route": [(1, "RUT-001", "toluca - lerma", "toluca", "lerma", d("60.00"), 60, "LOCAL",
                   None, True, T0)],
        "delay_cause": [(1, "TRAFICO", "Tráfico", "EXTERNA", True, T0),
                        (2, "VIEJA", "Vieja", "EXTERNA", False, T0)],
        "delivery": [
            trip(1, "ENT-BOUND-15", 15), trip(2, "ENT-BOUND-16", 16),
            trip(3, "ENT-NEG", 5, freight=d("-1")),
            trip(4, "ENT-OPEN", 0, arrival=None, status="IN_TRANSIT"),
            trip(5, "ENT-BACK", -90), trip(6, "ENT-CAUSE", 40, cause=1)],
        "fuel_load": [load(1, 1, "10000", "100"), load(2, 2, "10300", "0"),
                      load(3, 3, "11000", "100")],
        "maintenance": [
            (1, "MAN-1", 1, "PREVENTIVE", dt.date(2026, 2, 1), d("51000"), d("100"), d("50"),
             d("150"), None, None, "IN_PROGRESS", True, T0),
            (2, "MAN-2", 1, "CORRECTIVE", dt.date(2026, 2, 2), d("40000"), d("100"), d("50"),
             d("150"), None, 2, "IN_PROGRESS", True, T0)],
    }


def sources(spark):
    return {name: spark.createDataFrame(data, DDL[name]) for name, data in rows().items()}

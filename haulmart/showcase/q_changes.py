"""Listings, capture rules and state changes of the running fleet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haulmart.plans import changes, listing, pages, quality
from haulmart.showcase import oracle as o
from haulmart.showcase.registry import AS_OF, Context, query

AT = dt.datetime(2026, 8, 16, 12)
NOW = "TIMESTAMP '2026-08-16 12:00:00'"
col = F.col

# -- listings -----------------------------------------------------------------

MATCHING = """
SELECT d.id, d.folio, d.scheduled_departure FROM src_delivery d
JOIN src_customer c ON c.id = d.customer_id JOIN src_route r ON r.id = d.route_id
JOIN src_vehicle v ON v.id = d.vehicle_id
WHERE d.is_active AND (upper(d.folio) LIKE '%HOUSEHOLD%' OR upper(c.business_name) LIKE '%HOUSEHOLD%'
  OR upper(r.code) LIKE '%HOUSEHOLD%' OR upper(v.plate) LIKE '%HOUSEHOLD%')
"""
# A trip whose corridor is missing from the sources is still listed.
MATCHING = MATCHING.replace("JOIN src_", "LEFT JOIN src_")


@query("p03_listing_search", "id i, folio s", MATCHING)
def _(x: Context):
    return listing.matching(x.src, "delivery", " household ")


@query("w09_offset_paging", "id i, folio s",
       MATCHING + " ORDER BY d.scheduled_departure DESC, d.id LIMIT 25 OFFSET 50")
def _(x: Context):
    return listing.page(x.src, "delivery", "Household", 3)


def _page_sql(number: str) -> str:
    """Rows of one page of all active deliveries; ``number`` may use ``n``, the rows in all."""
    return f"""SELECT {number} AS page, id, folio FROM (
  SELECT id, folio, n, row_number() OVER (ORDER BY scheduled_departure DESC NULLS FIRST, id) - 1 AS place
  FROM src_delivery, (SELECT count(*) AS n FROM src_delivery WHERE is_active) c WHERE is_active) r
WHERE place // 25 + 1 = {number}"""


@query("w09_deep_pages", "page i, id i, folio s", "\nUNION ALL\n".join(
    _page_sql(n) for n in ("1", "((n + 24) // 25 + 1) // 2", "(n + 24) // 25")))
def _(x: Context):
    """The first, the middle and the last page of all deliveries, through the directory."""
    written = pages.SortedListing.write(x.src, "delivery", x.scratch("pages-" + x.sf_dir.strip("/").replace("/", "-")))
    last = written.pages()
    parts = [written.page(n).select(F.lit(n).alias("page"), "id", "folio") for n in (1, (last + 1) // 2, last)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("p03_listing_literal_wildcard", "id i", "SELECT id FROM src_customer WHERE is_active AND "
       "(contains(code, '_1') OR contains(upper(business_name), '_1') OR contains(tax_id, '_1') "
       "OR contains(city, '_1'))")
def _(x: Context):
    return listing.matching(x.src, "customer", "_1")


@query("p04_capture_rules", "table_name s, natural_key s, rule s", f"""
SELECT 'route' AS table_name, code AS natural_key, 'distance_positive' AS rule FROM src_route
  WHERE distance_km <= 0
UNION ALL SELECT 'delivery', folio, 'arrival_after_departure' FROM src_delivery
  WHERE scheduled_arrival <= scheduled_departure
UNION ALL SELECT 'delivery', folio, 'weight_within_capacity' FROM src_delivery d
  JOIN src_vehicle v ON v.id = d.vehicle_id WHERE cargo_weight_kg <> 0
  AND cargo_weight_kg > cargo_capacity_kg
UNION ALL SELECT 'fuel_load', folio, 'liters_positive' FROM src_fuel_load WHERE liters <= 0
UNION ALL SELECT 'fuel_load', folio, 'liters_within_tank' FROM src_fuel_load f
  JOIN src_vehicle v ON v.id = f.vehicle_id WHERE liters > 0 AND liters > tank_capacity_l * 2
UNION ALL SELECT 'fuel_load', folio, 'odometer_non_negative' FROM src_fuel_load WHERE odometer_km < 0
UNION ALL SELECT 'maintenance', folio, 'costs_non_negative' FROM src_maintenance
  WHERE coalesce(labor_cost, 0) < 0 OR coalesce(parts_cost, 0) < 0
UNION ALL SELECT 'operator', employee_number, 'expiry_after_hire' FROM src_operator
  WHERE license_expiry < hire_date
UNION ALL SELECT 'vehicle', plate, 'year_in_range' FROM src_vehicle
  WHERE year < 1980 OR year > 2027""")
def _(x: Context):
    return quality.violations(x.src, AS_OF)


@query("p05_canonical_input", "id i, code s, plate s",
       "SELECT id, upper(trim(customer_code)) AS code, "
       "replace(upper(trim(vehicle_plate)), '-', '') AS plate FROM stg_delivery")
def _(x: Context):
    return x.stg["stg_delivery"].select(
        "id", quality.canonical_code(col("customer_code")).alias("code"),
        quality.canonical_plate(col("vehicle_plate")).alias("plate"),
    )


# -- arrivals -----------------------------------------------------------------

_STATE = {
    "DELIVERED": "Entregada", "DELAYED": "Entregada con retraso", "CANCELLED": "Cancelada",
}
_LATE = f"({o.delay('scheduled_arrival', 'arrived_at')} > 15)"


def _closed(status: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATE.items())
    return f"'La entrega ' || folio || ' ya está cerrada (' || CASE {status} {cases} END || ').'"


ARRIVALS = f"""
SELECT *, CASE WHEN pos > first_ok THEN {_closed("CASE WHEN win_late THEN 'DELAYED' ELSE 'DELIVERED' END")}
    ELSE own END AS reason
FROM (SELECT *, min(CASE WHEN own IS NULL THEN pos END) OVER (PARTITION BY folio) AS first_ok,
        arg_min(late, pos) FILTER (WHERE own IS NULL) OVER (PARTITION BY folio) AS win_late
  FROM (SELECT e.event_id, e.folio, e.arrived_at, x.id AS cause_id, {_LATE} AS late, d.vehicle_id,
      coalesce(d.actual_departure, d.scheduled_departure) AS departed,
      row_number() OVER (PARTITION BY e.folio ORDER BY e.arrived_at, e.event_id) AS pos,
      CASE WHEN d.status IN ('DELIVERED', 'DELAYED', 'CANCELLED') THEN
          {_closed('d.status').replace("|| folio", "|| e.folio")}
        WHEN e.arrived_at < coalesce(d.actual_departure, d.scheduled_departure)
          THEN 'La llegada no puede ser anterior a la salida.'
        WHEN {_LATE} AND coalesce(e.cause_code, '') = ''
          THEN 'Una entrega con retraso requiere que se indique la causa.'
        WHEN {_LATE} AND x.id IS NULL
          THEN 'Causa de retraso desconocida: ' || e.cause_code || '.' END AS own
    FROM ev_arrival e JOIN src_delivery d ON d.folio = e.folio
    LEFT JOIN src_delay_cause x ON x.code = e.cause_code AND x.is_active) a) b
"""


def _arrivals(x: Context):
    return changes.apply_arrivals(
        x.view("ev_arrival"), x.src["delivery"], x.src["delay_cause"], x.src["vehicle"], AT
    )


def _micros(*names: str):
    return {n: F.unix_micros(col(n).cast("timestamp")) for n in names}


@query("b01_apply_arrivals",
       "folio s, actual_arrival i, actual_departure i, delay_cause_id i, status s, updated_at i",
       f"""
SELECT d.folio, epoch_us(coalesce(a.arrived_at, d.actual_arrival)) AS actual_arrival,
  epoch_us(CASE WHEN a.folio IS NULL THEN d.actual_departure ELSE a.departed END) AS actual_departure,
  CASE WHEN a.folio IS NULL THEN d.delay_cause_id WHEN a.late THEN a.cause_id END AS delay_cause_id,
  CASE WHEN a.folio IS NULL THEN d.status WHEN a.late THEN 'DELAYED' ELSE 'DELIVERED' END AS status,
  epoch_us(CASE WHEN a.folio IS NULL THEN d.updated_at ELSE {NOW} END) AS updated_at
FROM src_delivery d LEFT JOIN (SELECT * FROM ({ARRIVALS}) v WHERE reason IS NULL) a
  ON a.folio = d.folio""")
def _(x: Context):
    return _arrivals(x).rows.withColumns(
        _micros("actual_arrival", "actual_departure", "updated_at")
    )


@query("b01_arrivals_free_vehicles", "plate s, status s", f"""
SELECT plate, CASE WHEN status = 'ON_ROUTE' AND id IN
  (SELECT vehicle_id FROM ({ARRIVALS}) v WHERE reason IS NULL) THEN 'AVAILABLE' ELSE status END AS status
FROM src_vehicle""")
def _(x: Context):
    return _arrivals(x).vehicles


@query("b01_arrivals_refused", "event_id i, folio s, reason s",
       f"SELECT event_id, folio, reason FROM ({ARRIVALS}) v WHERE reason IS NOT NULL")
def _(x: Context):
    return _arrivals(x).refused


# -- workshop completions -----------------------------------------------------

COMPLETIONS = """
SELECT *, CASE WHEN done OR pos > first_ok THEN 'El mantenimiento ' || folio || ' ya está completado.'
    WHEN odometer_km < met THEN 'El odómetro del servicio no puede ser menor al odómetro actual del vehículo ('
      || CAST(met AS DECIMAL(16,2)) || ' km).' END AS reason
FROM (SELECT *, min(CASE WHEN NOT done AND odometer_km >= met THEN pos END)
        OVER (PARTITION BY folio) AS first_ok
  FROM (SELECT *, greatest(start_km, max(CASE WHEN NOT done THEN odometer_km END) OVER (
        PARTITION BY vehicle_id ORDER BY service_date, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS met
    FROM (SELECT e.event_id, e.folio, m.vehicle_id, m.service_date, m.odometer_km,
        m.status = 'COMPLETED' AS done, v.current_odometer_km AS start_km,
        coalesce(e.next_service_km, m.odometer_km + 10000) AS target,
        row_number() OVER (PARTITION BY e.folio ORDER BY m.service_date, e.event_id) AS pos
      FROM ev_completion e JOIN src_maintenance m ON m.folio = e.folio
      JOIN src_vehicle v ON v.id = m.vehicle_id) a) b) c
"""


def _completions(x: Context, **options):
    return changes.apply_completions(
        x.view("ev_completion"), x.src["maintenance"], x.src["vehicle"], AT, **options
    )


@query("b02_apply_completions", "folio s, next_service_km d, status s, total_cost d", f"""
SELECT m.folio, coalesce(a.target, m.next_service_km) AS next_service_km,
  CASE WHEN a.folio IS NULL THEN m.status ELSE 'COMPLETED' END AS status,
  CASE WHEN a.folio IS NULL THEN m.total_cost ELSE m.labor_cost + m.parts_cost END AS total_cost
FROM src_maintenance m LEFT JOIN (SELECT * FROM ({COMPLETIONS}) v WHERE reason IS NULL) a
  ON a.folio = m.folio""")
def _(x: Context):
    return _completions(x).rows


@query("b02_completions_update_vehicles",
       "plate s, current_odometer_km d, next_service_km d, last_service_date s, status s", f"""
SELECT v.plate, coalesce(a.odometer_km, v.current_odometer_km) AS current_odometer_km,
  coalesce(a.target, v.next_service_km) AS next_service_km,
  coalesce(a.service_date, v.last_service_date) AS last_service_date,
  CASE WHEN a.vehicle_id IS NOT NULL AND v.status <> 'OUT_OF_SERVICE' THEN 'AVAILABLE'
    ELSE v.status END AS status
FROM src_vehicle v LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY vehicle_id
    ORDER BY service_date DESC, event_id DESC) AS newest FROM ({COMPLETIONS}) w
  WHERE reason IS NULL) a ON a.vehicle_id = v.id AND a.newest = 1""")
def _(x: Context):
    return _completions(x).vehicles


@query("b02_completions_refused", "event_id i, folio s, reason s",
       f"SELECT event_id, folio, reason FROM ({COMPLETIONS}) v WHERE reason IS NOT NULL")
def _(x: Context):
    return _completions(x).refused


@query("b02_completions_split", "event_id i, folio s, reason s",
       f"SELECT event_id, folio, reason FROM ({COMPLETIONS}) v WHERE reason IS NOT NULL")
def _(x: Context):
    """The way of crowded vehicles, taken for all of them."""
    return _completions(x, hot_rows=1).refused


@query("b03_soft_delete", "id i, is_active s, updated_at i", f"""
SELECT id, is_active AND NOT gone AS is_active,
  epoch_us(CASE WHEN gone THEN {NOW} ELSE updated_at END) AS updated_at
FROM (SELECT *, id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS gone
      FROM src_customer) t""")
def _(x: Context):
    ids = x.table("orders").filter("o_orderstatus = 'P'").select(col("o_custkey").alias("id"))
    return changes.deactivate(x.src["customer"], ids, AT).withColumns(_micros("updated_at"))

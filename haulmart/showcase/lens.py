"""The supplied order tables seen as the tables of a transport fleet.

Orders are trips, suppliers are trucks, part brands are drivers, nation pairs
are corridors and events are fuel loads or workshop orders. The projections use
only SQL that Spark and an independent engine both read, so the very same text
feeds both sides of a comparison. ``{name}`` stands for a supplied table and
``{TS}`` for the keyword of a zone-free timestamp literal.

``src_*`` are clean operational tables with ids. ``stg_*`` are landing tables
with everything a landing zone may contain: several versions of a row, stray
white space and case, missing values, broken references, impossible dates.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LENS: dict[str, str] = {}

LENS["src_customer"] = """
SELECT c_custkey AS id, 'CLI-' || c_custkey AS code,
  c_name || ' ' || c_mktsegment AS business_name, 'RFC' || c_custkey AS tax_id,
  n_name AS city, r_name AS state,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'PREMIUM' WHEN 'AUTOMOBILE' THEN 'OCCASIONAL'
    ELSE 'REGULAR' END AS customer_type,
  {TS}'2024-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 365 AS INT) AS updated_at,
  c_acctbal > -900 AS is_active
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
  JOIN {region} ON r_regionkey = n_regionkey
"""

LENS["src_vehicle"] = """
SELECT s_suppkey AS id, 'SUP' || s_suppkey AS plate, 'ECO-' || s_suppkey AS economic_number,
  n_name AS brand, s_name AS model, CAST(1978 + s_suppkey % 52 AS INT) AS year,
  CASE s_suppkey % 4 WHEN 0 THEN 'TRUCK' WHEN 1 THEN 'VAN' WHEN 2 THEN 'TRAILER'
    ELSE 'PICKUP' END AS vehicle_type,
  CAST(abs(s_acctbal) * 2 + 10 AS DECIMAL(14,2)) AS cargo_capacity_kg,
  CASE s_suppkey % 2 WHEN 0 THEN 'DIESEL' ELSE 'GASOLINE' END AS fuel_type,
  CAST(20 + s_suppkey % 80 AS DECIMAL(8,2)) AS tank_capacity_l,
  CAST(abs(s_acctbal) * 10 AS DECIMAL(12,2)) AS current_odometer_km,
  CAST(abs(s_acctbal) * 10 + (s_suppkey % 13 - 4) * 300.5 AS DECIMAL(12,2)) AS next_service_km,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE
    CAST(DATE '2026-08-01' - INTERVAL '1' DAY * CAST(s_suppkey % 400 AS INT) AS DATE)
  END AS last_service_date,
  CASE s_suppkey % 5 WHEN 0 THEN 'ON_ROUTE' WHEN 1 THEN 'IN_MAINTENANCE'
    WHEN 2 THEN 'OUT_OF_SERVICE' ELSE 'AVAILABLE' END AS status,
  {TS}'2024-01-01 00:00:00' + INTERVAL '1' DAY * CAST(s_suppkey % 365 AS INT) AS updated_at,
  s_suppkey % 11 <> 3 AS is_active
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
"""

LENS["src_operator"] = """
SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS id, upper(p_brand) AS employee_number,
  'Marca' AS first_name, min(p_type) AS last_name, 'LIC-' || p_brand AS license_number,
  CASE min(p_size) % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'E' END
    AS license_type,
  CAST(DATE '2018-01-01' + INTERVAL '1' DAY * CAST(min(p_size) * 400 AS INT) AS DATE) AS hire_date,
  CAST(DATE '2018-01-01' + INTERVAL '1' DAY * CAST(count(*) % 90 * 60 AS INT) AS DATE)
    AS license_expiry,
  {TS}'2024-01-01 00:00:00' + INTERVAL '1' DAY * CAST(min(p_partkey) % 365 AS INT) AS updated_at,
  max(p_size) >= 40 AS is_active
FROM {part} GROUP BY p_brand
"""

LENS["src_route"] = """
SELECT n1.n_nationkey * 25 + n2.n_nationkey AS id,
  'RUT-' || n1.n_nationkey || '-' || n2.n_nationkey AS code,
  n1.n_name || ' - ' || n2.n_name AS name, n1.n_name AS origin_city,
  n2.n_name AS destination_city,
  CAST(CASE WHEN (n1.n_nationkey + n2.n_nationkey) % 17 = 16 THEN 0
    ELSE 20 + 37 * abs(n1.n_nationkey - n2.n_nationkey) END AS DECIMAL(14,2)) AS distance_km,
  CAST(45 + 40 * abs(n1.n_nationkey - n2.n_nationkey) AS INT) AS estimated_duration_min,
  CASE WHEN n1.n_nationkey = n2.n_nationkey THEN 'LOCAL'
    WHEN n1.n_regionkey = n2.n_regionkey THEN 'REGIONAL' ELSE 'FORANEA' END AS route_type,
  CASE WHEN r_name = 'ASIA' THEN NULL ELSE r_name END AS zone,
  {TS}'2024-01-01 00:00:00' + INTERVAL '1' DAY * CAST(n1.n_nationkey AS INT) AS updated_at,
  n1.n_nationkey % 6 <> 5 AS is_active
FROM (SELECT DISTINCT c_nationkey AS a, c_custkey % 25 AS b FROM {customer}) p
  JOIN {nation} n1 ON n1.n_nationkey = p.a
  JOIN {nation} n2 ON n2.n_nationkey = p.b
  JOIN {region} ON r_regionkey = n1.n_regionkey
"""

LENS["src_delay_cause"] = """
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS code, 'causa ' || lower(r_name) AS name,
  CASE r_regionkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'interna' ELSE 'MECANICA' END AS category,
  {TS}'2024-01-01 00:00:00' AS updated_at, r_regionkey <> 3 AS is_active
FROM {region}
"""

LENS["src_delivery"] = """
SELECT o_orderkey AS id, 'ENT-' || o_orderkey AS folio, o_custkey AS customer_id,
  (o_custkey % 25) * 25 + o_orderkey % 25 AS route_id,
  CAST(floor(o_custkey / 15) AS BIGINT) AS vehicle_id, o_orderkey % 25 + 1 AS operator_id,
  CASE WHEN o_orderkey % 7 < 5 THEN o_orderkey % 7 END AS delay_cause_id,
  dep AS scheduled_departure,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE dep + INTERVAL '7' MINUTE END AS actual_departure,
  dep + INTERVAL '1' MINUTE * CAST(o_orderkey % 500 - 1 AS INT) AS scheduled_arrival,
  CASE WHEN o_orderstatus = 'F' THEN dep + INTERVAL '1' MINUTE
    * CAST(o_orderkey % 500 + o_custkey % 61 - 20 AS INT) END AS actual_arrival,
  CAST(floor(o_totalprice / 40) AS DECIMAL(14,2)) AS cargo_weight_kg,
  CAST(o_orderkey % 40 AS INT) AS packages_count,
  CAST(o_totalprice AS DECIMAL(16,2)) AS declared_value,
  CAST(floor(o_totalprice / 100) AS DECIMAL(14,2)) AS freight_cost,
  CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'IN_TRANSIT' ELSE 'SCHEDULED' END
    AS status,
  dep AS updated_at, o_orderkey % 50 <> 0 AS is_active
FROM (SELECT *, o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS dep
  FROM {orders}) d
"""

LENS["src_fuel_load"] = """
SELECT event_id AS id, 'COM-' || event_id AS folio, user_id AS vehicle_id,
  event_id % 27 + 1 AS operator_id, ts AS load_datetime, 'Estacion ' || event_type AS station_name,
  CAST(value - 1 AS DECIMAL(14,2)) AS liters, CAST(20 + event_id % 5 AS DECIMAL(10,2))
    AS price_per_liter,
  CAST(CAST(value - 1 AS DECIMAL(14,2)) * (20 + event_id % 5) AS DECIMAL(14,2)) AS total_cost,
  CAST((year(ts) - 2024) * 527040 + (dayofyear(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts)
    - CASE WHEN event_id % 91 = 0 THEN 900 ELSE 0 END AS DECIMAL(16,2)) AS odometer_km,
  ts AS updated_at, event_type <> 'signup' AS is_active
FROM {events}
"""

LENS["src_maintenance"] = """
SELECT event_id AS id, 'MAN-' || event_id AS folio, user_id AS vehicle_id,
  CASE event_id % 2 WHEN 0 THEN 'PREVENTIVE' ELSE 'CORRECTIVE' END AS maintenance_type,
  CAST(ts AS DATE) AS service_date,
  CAST((user_id * 7919) % 99000 + dayofyear(ts) * 40 + event_id % 90 AS DECIMAL(16,2))
    AS odometer_km,
  'Taller ' || event_id % 9 AS workshop,
  CAST(value AS DECIMAL(14,2)) AS labor_cost, CAST(value * 2 - 20 AS DECIMAL(14,2)) AS parts_cost,
  CAST(value * 3 - 20 AS DECIMAL(14,2)) AS total_cost,
  CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 1000 + 50000 AS DECIMAL(12,2)) END
    AS next_service_km,
  CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(event_id % 4 AS INT) END AS days_out_of_service,
  CASE event_id % 6 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'SCHEDULED' ELSE 'IN_PROGRESS' END AS status,
  ts AS updated_at, true AS is_active
FROM {events} WHERE event_type = 'error'
"""

LENS["stg_customer"] = """
SELECT id, id AS source_id, {TS}'2024-01-01 00:00:00' AS extracted_at,
  '  ' || lower(code) || ' ' AS code, lower(business_name) || '   ' AS business_name,
  ' ' || lower(tax_id) AS tax_id, city, CASE state WHEN 'EUROPE' THEN ' ' ELSE state END AS state,
  CASE customer_type WHEN 'REGULAR' THEN '' ELSE lower(customer_type) END AS customer_type,
  is_active
FROM src_customer
UNION ALL
SELECT id, id AS source_id, {TS}'2024-02-01 00:00:00' AS extracted_at,
  CASE WHEN id % 40 = 7 THEN '   ' ELSE code END AS code,
  business_name || '  de cv' AS business_name, tax_id, NULL AS city, state,
  customer_type, is_active
FROM src_customer WHERE id % 5 = 2
"""

LENS["stg_vehicle"] = """
SELECT id, id AS source_id, {TS}'2024-01-01 00:00:00' AS extracted_at,
  'sup-' || id AS plate, lower(economic_number) AS economic_number, brand, model, year,
  lower(vehicle_type) AS vehicle_type, cargo_capacity_kg, fuel_type, is_active
FROM src_vehicle
UNION ALL
SELECT id, id AS source_id, {TS}'2024-02-01 00:00:00' AS extracted_at,
  CASE WHEN id % 12 = 4 THEN '--' ELSE 'SUP ' || id END AS plate, economic_number, brand,
  model || ' bis' AS model, CASE WHEN id % 6 = 1 THEN NULL ELSE year END AS year,
  vehicle_type, cargo_capacity_kg, fuel_type, is_active
FROM src_vehicle WHERE id % 3 = 1
"""

LENS["stg_operator"] = """
SELECT p_partkey AS id, p_partkey AS source_id,
  {TS}'2024-01-01 00:00:00' + INTERVAL '1' DAY * CAST(p_partkey % 3 AS INT) AS extracted_at,
  CASE WHEN p_partkey % 101 = 5 THEN NULL ELSE ' ' || lower(p_brand) END AS employee_number,
  'marca' AS first_name, lower(p_type) AS last_name,
  CASE p_size % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'a' WHEN 2 THEN 'B' WHEN 3 THEN 'c' ELSE 'E' END
    AS license_type,
  CASE WHEN p_size = 50 THEN NULL ELSE
    CAST(DATE '2010-01-01' + INTERVAL '1' DAY * CAST(p_size * 120 AS INT) AS DATE) END AS hire_date,
  true AS is_active
FROM {part}
"""

LENS["stg_route"] = """
SELECT id, id AS source_id, {TS}'2024-01-01 00:00:00' AS extracted_at, lower(code) AS code,
  lower(name) AS name, lower(origin_city) AS origin_city, destination_city,
  distance_km, estimated_duration_min, lower(route_type) AS route_type, zone, is_active
FROM src_route
UNION ALL
SELECT id, id AS source_id, {TS}'2024-02-01 00:00:00' AS extracted_at, code, name, origin_city,
  destination_city, CAST(CASE WHEN id % 4 = 0 THEN NULL ELSE -1 END AS DECIMAL(14,2)) AS distance_km,
  estimated_duration_min, route_type, zone, is_active
FROM src_route WHERE route_type = 'LOCAL'
"""

LENS["stg_delay_cause"] = """
SELECT id, id AS source_id, {TS}'2024-01-01 00:00:00' AS extracted_at,
  ' ' || lower(code) AS code, name, category, is_active
FROM src_delay_cause
"""

LENS["stg_delivery"] = """
SELECT (l_partkey * 100000 + l_suppkey) * 100 + qty AS id, CAST(NULL AS BIGINT) AS source_id,
  l_shipdate AS extracted_at,
  CASE WHEN l_partkey % 499 = 3 THEN ' ' ELSE 'ent-' || l_orderkey || '-' || l_linenumber END
    AS folio,
  CASE WHEN o_orderkey % 89 = 0 THEN 'CLI-X' ELSE 'cli-' || o_custkey END AS customer_code,
  'rut-' || c_nationkey || '-' || s_nationkey AS route_code,
  CASE WHEN l_partkey % 97 = 0 THEN 'XX-' || l_suppkey ELSE 'sup.' || l_suppkey END
    AS vehicle_plate,
  lower(p_brand) || ' ' AS operator_number,
  CASE l_returnflag WHEN 'A' THEN lower(r_name) WHEN 'R' THEN 'otra' END AS delay_cause_code,
  dep AS scheduled_departure,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL
    ELSE dep + INTERVAL '1' MINUTE * CAST(l_linenumber AS INT) END AS actual_departure,
  dep + INTERVAL '1' MINUTE * planned AS scheduled_arrival,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN NULL
    WHEN tax = 8 THEN dep - INTERVAL '1' HOUR
    ELSE dep + INTERVAL '1' MINUTE * (planned + qty * 3 - 80 + disc * 4
        + (c_nationkey + s_nationkey) % 7 * 5
        + CASE WHEN hour(dep) BETWEEN 7 AND 9 OR hour(dep) BETWEEN 17 AND 19 THEN 20 ELSE 0 END)
      + INTERVAL '10' SECOND * CAST(l_linenumber AS INT) END AS actual_arrival,
  CAST(qty * 25 AS DECIMAL(14,2)) AS cargo_weight_kg,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE qty END AS packages_count,
  CAST(l_extendedprice AS DECIMAL(16,2)) AS declared_value,
  CAST(CASE WHEN tax = 7 AND disc < 3 THEN -l_extendedprice ELSE l_extendedprice END
    AS DECIMAL(14,2)) AS freight_cost,
  'DELIVERED' AS status, true AS is_active
FROM (SELECT *, CAST(round(l_quantity) AS INT) AS qty, CAST(round(l_discount * 100) AS INT) AS disc,
    CAST(round(l_tax * 100) AS INT) AS tax,
    CAST(45 + 40 * abs(c_nationkey - s_nationkey) AS INT) AS planned,
    o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS dep
  FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
    JOIN {customer} ON c_custkey = o_custkey JOIN {supplier} ON s_suppkey = l_suppkey
    JOIN {part} ON p_partkey = l_partkey JOIN {nation} ON n_nationkey = c_nationkey
    JOIN {region} ON r_regionkey = n_regionkey) t
"""

LENS["stg_fuel_load"] = """
SELECT event_id AS id, event_id AS source_id, ts AS extracted_at,
  CASE WHEN event_id % 203 = 9 THEN NULL ELSE
    ' com-' || (event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) END AS folio,
  CASE event_id % 3 WHEN 0 THEN 'sup-' ELSE 'SUP ' END || user_id AS vehicle_plate,
  'brand#' || (event_id % 27 + 1) AS operator_number, ts AS load_datetime,
  CAST(value - 1 AS DECIMAL(14,2)) AS liters,
  CAST(20 + event_id % 5 AS DECIMAL(10,2)) AS price_per_liter,
  CAST(CAST(value - 1 AS DECIMAL(14,2)) * (20 + event_id % 5) AS DECIMAL(14,2)) AS total_cost,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE
    CAST((year(ts) - 2024) * 527040 + (dayofyear(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts)
      AS DECIMAL(16,2)) END AS odometer_km,
  true AS is_active
FROM {events}
"""

LENS["stg_maintenance"] = """
SELECT event_id AS id, event_id AS source_id, ts AS extracted_at,
  'man-' || (event_id - event_id % 2) AS folio, 'sup-' || user_id AS vehicle_plate,
  CASE event_id % 2 WHEN 0 THEN ' preventive' ELSE 'CORRECTIVE' END AS maintenance_type,
  CAST(ts AS DATE) AS service_date, CAST(event_id AS DECIMAL(16,2)) AS odometer_km,
  CAST(value AS DECIMAL(14,2)) AS labor_cost, CAST(value * 2 - 20 AS DECIMAL(14,2)) AS parts_cost,
  CAST(value * 3 - 20 AS DECIMAL(14,2)) AS total_cost,
  CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(event_id % 4 AS INT) END AS days_out_of_service,
  'COMPLETED' AS status, true AS is_active
FROM {events} WHERE event_type = 'error' OR event_type = 'view'
"""

# Events told as the control table of past runs.
LENS["run_log"] = """
SELECT 'run-' || user_id AS run_id,
  CASE event_type WHEN 'purchase' THEN 'LOAD' WHEN 'click' THEN 'TRANSFORM' ELSE 'EXTRACT' END
    AS phase,
  'stg_' || event_type AS table_name, ts AS started_at,
  ts + INTERVAL '1' SECOND * CAST(event_id % 600 AS INT) AS finished_at,
  event_id AS rows_read, event_id AS rows_written, event_id % 3 AS rows_rejected,
  CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status, '' AS message
FROM {events}
"""

# Arrivals reported for trips: three reports share one trip.
LENS["ev_arrival"] = """
SELECT o_orderkey AS event_id, d.folio,
  d.scheduled_arrival + INTERVAL '1' MINUTE * CAST(o_custkey % 90 - 30 AS INT) AS arrived_at,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'AFRICA' WHEN '2-HIGH' THEN 'EUROPE'
    WHEN '3-MEDIUM' THEN '' WHEN '5-LOW' THEN 'MIDDLE EAST' END AS cause_code
FROM {orders} JOIN src_delivery d ON d.id = o_orderkey - o_orderkey % 3
"""

# Workshop completions; every third order is reported twice.
LENS["ev_completion"] = """
SELECT id * 2 AS event_id, folio,
  CAST(CASE id % 7 WHEN 0 THEN 0 WHEN 1 THEN id + 120000 END AS DECIMAL(12,2)) AS next_service_km
FROM src_maintenance
UNION ALL
SELECT id * 2 + 1 AS event_id, folio, CAST(NULL AS DECIMAL(12,2)) AS next_service_km
FROM src_maintenance WHERE id % 3 = 0
"""

# Open trips as plans to score.
LENS["plan"] = """
SELECT d.folio AS plan_id, r.code AS route_code, CAST(d.id % 24 AS INT) AS departure_hour,
  CAST(d.id % 7 AS INT) AS day_of_week, d.cargo_weight_kg, d.packages_count,
  v.vehicle_type, '4-8' AS vehicle_age_range, '3-5' AS operator_seniority_range, c.customer_type
FROM src_delivery d JOIN src_route r ON r.id = d.route_id
  JOIN src_vehicle v ON v.id = d.vehicle_id JOIN src_customer c ON c.id = d.customer_id
WHERE d.actual_arrival IS NULL
"""

_TABLE = re.compile(r"\{([a-z]+)\}")


def needed(name: str, texts: dict[str, str]) -> list[str]:
    """``name`` and everything it reads among ``texts``, dependencies first."""
    order: list[str] = []

    def visit(current: str) -> None:
        for other in texts:
            if other != current and re.search(rf"\b{other}\b", texts[current]):
                visit(other)
        if current not in order:
            order.append(current)

    visit(name)
    return order


def view(spark: SparkSession, tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One lens table as a DataFrame over the supplied tables."""
    names = needed(name, LENS)
    parts = [f"{n} AS ({LENS[n].replace('{TS}', 'TIMESTAMP_NTZ ')})" for n in names]
    text = f"WITH {', '.join(parts)} SELECT * FROM {name}"
    return spark.sql(text, **{t: tables[t] for t in set(_TABLE.findall(text))})

"""Business reports, periods and star-schema joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F


from haulmart.plans import calendar, features, operational, reports
from haulmart.plans.period import Period, from_request, scope
from haulmart.plans.star import member
from haulmart.showcase import oracle as o
from haulmart.showcase.registry import AS_OF, Context, query

LATE = "count(*) FILTER (WHERE f.is_delayed = 1)"
YEAR_97 = Period(dt.date(1997, 1, 1), dt.date(1997, 12, 31))
IN_97 = "f.date_id BETWEEN 19970101 AND 19971231"


@query("a01_warehouse_is_empty", "is_empty i",
       "SELECT CASE WHEN EXISTS (SELECT 1 FROM f_delivery) THEN 0 ELSE 1 END AS is_empty")
def _(c: Context):
    empty = reports.is_empty(c.star)
    return c.spark.range(1).select(F.lit(empty).cast("int").alias("is_empty"))


@query("a02_data_bounds", "first_day s, last_day s",
       f"SELECT {o.key_day('min(date_id)')} AS first_day, {o.key_day('max(date_id)')} AS last_day "
       "FROM f_delivery")
def _(c: Context):
    return reports.data_bounds(c.star)


def _kpi_sql(where: str) -> str:
    return f"""
SELECT d.*, u.*, m.* FROM
 (SELECT count(*) AS deliveries, {LATE} AS delayed,
   {o.pct(f'count(*) - {LATE}', 'count(*)')} AS on_time_rate,
   coalesce({o.show(o.avg('delay_minutes'))}, 0) AS avg_delay_minutes,
   coalesce({o.show(o.avg('delay_minutes', 'is_delayed = 1'))}, 0) AS avg_delay_when_late,
   coalesce(sum(freight_cost), 0) AS total_freight, coalesce(sum(distance_km), 0) AS total_km
  FROM f_delivery f WHERE {where}) d,
 (SELECT coalesce({o.show(o.avg('CAST(efficiency_km_per_liter AS DECIMAL(18,2))'), 2)}, 0)
    AS avg_efficiency, coalesce(sum(total_cost), 0) AS fuel_cost
  FROM f_fuel f WHERE {where}) u,
 (SELECT coalesce(sum(total_cost), 0) AS maintenance_cost FROM f_maintenance f WHERE {where}) m
"""


KPI = ("deliveries i, delayed i, on_time_rate d, avg_delay_minutes d, avg_delay_when_late d, "
       "total_freight d, total_km d, avg_efficiency d, fuel_cost d, maintenance_cost d")


@query("a03_kpi_summary", KPI, _kpi_sql("true"))
def _(c: Context):
    return reports.kpi_summary(c.star)


@query("a03_kpi_summary_empty_period", KPI, _kpi_sql("f.date_id BETWEEN 19900101 AND 19901231"))
def _(c: Context):
    return reports.kpi_summary(c.star, Period(dt.date(1990, 1, 1), dt.date(1990, 12, 31)))


TREND = f"""
SELECT date_id // 100 AS year_month,
  {o.MONTHS}[CAST(date_id // 100 % 100 AS INT)][1:3] || ' ' || (date_id // 10000) AS label,
  count(*) AS deliveries, {LATE} AS delayed, sum(freight_cost) AS freight
FROM f_delivery f GROUP BY ALL
"""


@query("a04_monthly_trend", "year_month i, label s, deliveries i, delayed i, freight d", TREND)
def _(c: Context):
    return reports.monthly_trend(c.star)


def _top_routes(limit: int, where: str = "true") -> str:
    return f"""
SELECT r.code, r.name, r.zone, count(*) AS shipments, {o.pct(LATE, 'count(*)')} AS delay_rate
FROM f_delivery f JOIN c_route r ON r.code = f.route WHERE {where} GROUP BY r.code, r.name, r.zone
ORDER BY shipments DESC, r.code LIMIT {limit}
"""


TOP_ROUTES = "code s, name s, zone s, shipments i, delay_rate d"


@query("a05_top_routes", TOP_ROUTES, _top_routes(10))
def _(c: Context):
    return reports.top_routes(c.star)


def _worst_routes(limit: int) -> str:
    return f"""
SELECT r.code, r.name, r.zone, count(*) AS shipments, {o.pct(LATE, 'count(*)')} AS delay_rate,
  {o.show(o.avg('f.delay_minutes'))} AS avg_delay
FROM f_delivery f JOIN c_route r ON r.code = f.route GROUP BY r.code, r.name, r.zone
HAVING count(*) >= 20 ORDER BY {o.avg('f.delay_minutes')} DESC, r.code LIMIT {limit}
"""


@query("a06_worst_routes", TOP_ROUTES + ", avg_delay d", _worst_routes(10))
def _(c: Context):
    return reports.worst_routes(c.star)


def _top_operators(limit: int) -> str:
    return f"""
SELECT p.employee_number, p.full_name, count(*) AS deliveries,
  {o.pct(LATE, 'count(*)')} AS delay_rate
FROM f_delivery f JOIN c_operator p ON p.employee_number = f.operator
GROUP BY p.employee_number, p.full_name ORDER BY deliveries DESC, 1 LIMIT {limit}
"""


@query("a07_top_operators", "employee_number s, full_name s, deliveries i, delay_rate d",
       _top_operators(10))
def _(c: Context):
    return reports.top_operators(c.star)


DEMAND = f"""
SELECT r.route_type AS service_type, count(*) AS shipments,
  {o.pct('count(*)', 'sum(count(*)) OVER ()')} AS share,
  {o.pct(LATE, 'count(*)')} AS delay_rate, sum(freight_cost) AS freight,
  count(DISTINCT r.code) AS routes
FROM f_delivery f JOIN c_route r ON r.code = f.route GROUP BY r.route_type
"""
DEMAND_COLUMNS = "service_type s, shipments i, share d, delay_rate d, freight d, routes i"


@query("a08_demand_by_service_type", DEMAND_COLUMNS, DEMAND)
def _(c: Context):
    return reports.demand_by_service_type(c.star)


def _top_customers(limit: int) -> str:
    return f"""
SELECT k.code, k.business_name, k.city, k.customer_type, count(*) AS shipments,
  {o.pct(LATE, 'count(*)')} AS delay_rate, sum(freight_cost) AS freight
FROM f_delivery f JOIN c_customer k ON k.code = f.customer GROUP BY ALL
ORDER BY shipments DESC, k.code LIMIT {limit}
"""


@query("a09_top_customers",
       "code s, business_name s, city s, customer_type s, shipments i, delay_rate d, freight d",
       _top_customers(10))
def _(c: Context):
    return reports.top_customers(c.star)


def _heatmap(slots: str) -> str:
    return f"""
SELECT d.range AS day_of_week, {o.DAYS}[d.range + 1] AS day_name, h.range AS hour,
  coalesce(n, 0) AS total, max(coalesce(n, 0)) OVER () AS peak
FROM range(7) d CROSS JOIN range(24) h
LEFT JOIN ({slots}) s ON s.dow = d.range AND s.hour = h.range
"""


GRID = "day_of_week i, day_name s, hour i, total i, peak i"


@query("a10_hour_heatmap", GRID, _heatmap(
    f"SELECT {o.weekday('date_id')} AS dow, time_id AS hour, count(*) AS n FROM f_delivery "
    "GROUP BY ALL"))
def _(c: Context):
    return reports.hour_heatmap(c.star)


@query("j13_week_spine", GRID, _heatmap(
    f"SELECT {o.weekday('date_id')} AS dow, time_id AS hour, count(*) AS n FROM f_delivery f "
    f"WHERE {IN_97} GROUP BY ALL"))
def _(c: Context):
    return reports.hour_heatmap(c.star, YEAR_97)


PARETO = f"""
SELECT cause, total,
  {o.pct('sum(total) OVER (ORDER BY total DESC, cause ROWS UNBOUNDED PRECEDING)',
         'sum(total) OVER ()')} AS cumulative
FROM (SELECT x.name AS cause, count(*) AS total FROM f_delivery f
      JOIN c_cause x ON x.code = f.cause WHERE @ GROUP BY x.name) t
"""


@query("a11_delay_causes_pareto", "cause s, total i, cumulative d", PARETO.replace("@", "true"))
def _(c: Context):
    return reports.delay_causes_pareto(c.star)


@query("w05_running_share", "cause s, total i, cumulative d", PARETO.replace("@", IN_97))
def _(c: Context):
    return reports.delay_causes_pareto(c.star, YEAR_97)


COSTS = """
SELECT v.economic_number, v.plate, v.vehicle_type, v.age_range,
  coalesce(u.t, 0) AS fuel_cost, coalesce(m.t, 0) AS maintenance_cost,
  coalesce(u.t, 0) + coalesce(m.t, 0) AS total_cost
FROM c_vehicle v
LEFT JOIN (SELECT vehicle, sum(total_cost) AS t FROM f_fuel GROUP BY 1) u ON u.vehicle = v.plate
LEFT JOIN (SELECT vehicle, sum(total_cost) AS t FROM f_maintenance GROUP BY 1) m
  ON m.vehicle = v.plate
"""
COST_COLUMNS = ("economic_number s, plate s, vehicle_type s, age_range s, fuel_cost d, "
                "maintenance_cost d, total_cost d")


@query("a12_cost_by_vehicle", COST_COLUMNS, COSTS + "ORDER BY total_cost DESC, v.plate LIMIT 15")
def _(c: Context):
    return reports.cost_by_vehicle(c.star)


@query("j04_all_vehicle_costs", COST_COLUMNS, COSTS)
def _(c: Context):
    return reports.cost_by_vehicle(c.star, limit=None)


def _efficiency(limit: int) -> str:
    mean = "CAST(sum(CAST(efficiency_km_per_liter AS DECIMAL(18,2))) AS DOUBLE) / count(*)"
    return f"""
SELECT v.economic_number, v.vehicle_type, v.age_range, {o.show(mean, 2)} AS efficiency,
  sum(liters) AS liters
FROM f_fuel f JOIN c_vehicle v ON v.plate = f.vehicle
WHERE efficiency_km_per_liter IS NOT NULL GROUP BY 1, 2, 3
ORDER BY {mean}, 1, 2, 3 LIMIT {limit}
"""


@query("a13_efficiency_by_vehicle",
       "economic_number s, vehicle_type s, age_range s, efficiency d, liters d", _efficiency(15))
def _(c: Context):
    return reports.efficiency_by_vehicle(c.star)


def _cost_per_km(limit: int) -> str:
    mean = "CAST(sum(CAST(f.cost_per_km AS DECIMAL(20,4))) AS DOUBLE) / count(*)"
    return f"""
SELECT r.code, r.name, {o.show(mean, 2)} AS cost_per_km, count(*) AS shipments
FROM f_delivery f JOIN c_route r ON r.code = f.route GROUP BY r.code, r.name
ORDER BY {mean} DESC, r.code LIMIT {limit}
"""


CPK = "code s, name s, cost_per_km d, shipments i"


@query("a14_cost_per_km_by_route", CPK, _cost_per_km(15))
def _(c: Context):
    return reports.cost_per_km_by_route(c.star)


@query("w07_top_k", CPK, _cost_per_km(100))
def _(c: Context):
    return reports.cost_per_km_by_route(c.star, 100)


@query("w06_share_of_total", "service_type s, shipments i, share d", f"""
SELECT r.route_type AS service_type, count(*) AS shipments,
  {o.pct('count(*)', 'sum(count(*)) OVER ()')} AS share
FROM f_delivery f JOIN c_route r ON r.code = f.route WHERE {IN_97} GROUP BY 1""")
def _(c: Context):
    return reports.demand_by_service_type(c.star, YEAR_97)


# -- fuel, alerts, customers --------------------------------------------------


def _fuel_report(where: str) -> str:
    km, burned = "max(odometer_km) - min(odometer_km)", (
        "sum(liters) - arg_min(liters, {'a': load_datetime, 'b': f.id})"
    )
    return f"""
SELECT plate, economic_number, loads, liters, cost, km,
  CASE WHEN km > 0 AND burned > 0 THEN {o.ratio('km', 'burned', 2)} END AS efficiency
FROM (SELECT v.plate, v.economic_number, count(*) AS loads, sum(liters) AS liters,
        sum(total_cost) AS cost, {km} AS km, {burned} AS burned
      FROM src_fuel_load f JOIN src_vehicle v ON v.id = f.vehicle_id
      WHERE f.is_active AND {where} GROUP BY v.id, 1, 2) t
"""


FUEL = "plate s, economic_number s, loads i, liters d, cost d, km d, efficiency d"


@query("a15_fuel_efficiency_report", FUEL, _fuel_report("true"))
def _(c: Context):
    return operational.efficiency_report(c.src["fuel_load"], c.src["vehicle"])


@query("w08_nulls_first", FUEL, _fuel_report(
    "load_datetime >= TIMESTAMP '2024-01-05 06:00:00' "
    "AND load_datetime <= TIMESTAMP '2024-01-12 18:00:00'"))
def _(c: Context):
    return operational.efficiency_report(
        c.src["fuel_load"], c.src["vehicle"],
        dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 12, 18),
    )


@query("w10_earliest_per_group", "vehicle_id i, first_liters d",
       "SELECT vehicle_id, arg_min(liters, {'a': load_datetime, 'b': id}) AS first_liters "
       "FROM src_fuel_load WHERE is_active GROUP BY 1")
def _(c: Context):
    return c.src["fuel_load"].filter("is_active").groupBy("vehicle_id").agg(
        F.min(F.struct("load_datetime", "id", "liters"))["liters"].alias("first_liters")
    )


@query("j12_vehicle_of_load", "vehicle_type s, loads i, liters d",
       "SELECT vehicle_type, count(*) AS loads, sum(liters) AS liters FROM src_fuel_load f "
       "JOIN src_vehicle v ON v.id = f.vehicle_id GROUP BY 1")
def _(c: Context):
    named = c.src["fuel_load"].join(
        c.src["vehicle"].select(F.col("id").alias("vehicle_id"), "vehicle_type"), "vehicle_id"
    )
    return named.groupBy("vehicle_type").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("liters").alias("liters")
    )


_LEFT = "(next_service_km - current_odometer_km)"
_DAYS = f"date_diff('day', last_service_date, {o.AS_OF})"
_KM = f"CAST(round_even(CAST(abs({_LEFT}) AS DOUBLE), 0) AS BIGINT)"
ALERTS = f"""
SELECT plate, economic_number,
  CASE WHEN {_LEFT} <= 0 OR last_service_date IS NULL OR {_DAYS} > 180 THEN 'ALTA' ELSE 'MEDIA'
  END AS severity,
  CASE WHEN {_LEFT} <= 0 THEN 'Kilometraje vencido por ' || {_KM}
      || ' km respecto al próximo servicio.'
    WHEN last_service_date IS NULL THEN 'Sin registro de servicio previo.'
    WHEN {_DAYS} > 180 THEN 'Han pasado ' || {_DAYS} || ' días desde el último servicio.'
    ELSE 'Faltan ' || {_KM} || ' km para el próximo servicio.' END AS reason,
  {_LEFT} AS km_to_next_service, {_DAYS} AS days_since_service
FROM src_vehicle
WHERE is_active AND status <> 'OUT_OF_SERVICE'
  AND ({_LEFT} <= 1000 OR last_service_date IS NULL OR {_DAYS} > 180)
"""


@query("a16_maintenance_alerts",
       "plate s, economic_number s, severity s, reason s, km_to_next_service d, "
       "days_since_service i", ALERTS)
def _(c: Context):
    return operational.maintenance_alerts(c.src["vehicle"], AS_OF)


@query("a16_alert_tally", "severity s, alerts i",
       f"SELECT severity, count(*) AS alerts FROM ({ALERTS}) a GROUP BY 1")
def _(c: Context):
    return operational.alert_tally(operational.maintenance_alerts(c.src["vehicle"], AS_OF))


@query("a17_customer_deliveries", "code s, total_deliveries i",
       "SELECT c.code, count(d.id) AS total_deliveries FROM src_customer c "
       "LEFT JOIN src_delivery d ON d.customer_id = c.id GROUP BY 1")
def _(c: Context):
    return operational.deliveries_per_customer(c.src["customer"], c.src["delivery"])


PROFILE = ("route_code s, route_name s, route_type s, zone s, distance_km d, avg_duration_min d, "
           "delay_rate d, avg_delay_minutes d, avg_cargo_kg d, avg_cost_per_km d, "
           "monthly_shipments d")


@query("a18_route_profile", PROFILE, "SELECT * FROM profile")
def _(c: Context):
    return features.route_profile(c.star)


@query("a19_rejections_by_rule", "rule s, rejected i",
       "SELECT rule, count(*) AS rejected FROM rejects GROUP BY 1")
def _(c: Context):
    from haulmart.plans import audit

    found = [x.rejected.select("rule") for x in c.cleaned.values()]
    return audit.rejections_by_rule(audit.stack(found))


@query("a19_run_audit", "run_id s, phases i, failed i, rejected i, started s",
       "SELECT run_id, count(*) AS phases, count(*) FILTER (WHERE status = 'FAILED') AS failed, "
       "sum(rows_rejected) AS rejected, epoch_us(min(started_at)) AS started "
       "FROM run_log GROUP BY 1")
def _(c: Context):
    from haulmart.plans import audit

    return audit.run_overview(c.view("run_log")).withColumn(
        "started", F.unix_micros(F.col("started_at").cast("timestamp"))
    )


@query("a20_series_annotations",
       "label s, deliveries i, series_mean d, peak_value d, peak_label s, percent_of_total d",
       f"""SELECT label, deliveries, avg(deliveries) OVER () AS series_mean,
  CAST(max(deliveries) OVER () AS DOUBLE) AS peak_value,
  first_value(label) OVER (ORDER BY deliveries DESC, year_month) AS peak_label,
  CAST(deliveries AS DOUBLE) / sum(deliveries) OVER () * 100 AS percent_of_total
FROM ({TREND}) t""")
def _(c: Context):
    return reports.annotate(reports.monthly_trend(c.star), "label", "deliveries", "year_month")


DATE_KEYS = ("SELECT date_id FROM f_delivery UNION ALL SELECT date_id FROM f_fuel "
             "UNION ALL SELECT date_id FROM f_maintenance")


def _date_keys(c: Context):
    return [c.rows(g).select("date_key") for g in ("deliveries", "fuel_loads", "maintenances")]


@query("a21_calendar_bounds", "first_key i, last_key i",
       f"SELECT min(date_id) AS first_key, max(date_id) AS last_key FROM ({DATE_KEYS}) k")
def _(c: Context):
    return calendar.calendar_bounds(*_date_keys(c))


@query("u01_union_of_date_keys", "date_key i, rows i",
       f"SELECT date_id AS date_key, count(*) AS rows FROM ({DATE_KEYS}) k GROUP BY 1")
def _(c: Context):
    keys = _date_keys(c)
    stacked = keys[0].unionByName(keys[1]).unionByName(keys[2])
    return stacked.groupBy("date_key").agg(F.count(F.lit(1)).alias("rows"))


@query("e11_date_dimension",
       "date_key i, full_date s, year i, quarter i, month i, month_name s, week i, day i, "
       "day_of_week i, day_name s, fortnight i, is_weekend s", f"""
SELECT {o.date_key('d')} AS date_key, CAST(d AS DATE) AS full_date, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, {o.MONTHS}[month(d)] AS month_name, week(d) AS week,
  day(d) AS day, isodow(d) - 1 AS day_of_week, {o.DAYS}[isodow(d)] AS day_name,
  CASE WHEN day(d) <= 15 THEN 1 ELSE 2 END AS fortnight, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
  FROM (SELECT {o.key_day('min(date_id)')} AS lo, {o.key_day('max(date_id)')} AS hi
        FROM ({DATE_KEYS}) k) b) s""")
def _(c: Context):
    bounds = calendar.calendar_bounds(*_date_keys(c))
    return calendar.date_dimension(calendar.bounds_or_today(bounds, AS_OF))


@query("e10_time_dimension", "time_key i, hour i, time_band s, loads i", f"""
SELECT h.range AS time_key, h.range AS hour, {o.band('h.range')} AS time_band, count(f.id) AS loads
FROM range(24) h LEFT JOIN src_fuel_load f ON hour(f.load_datetime) = h.range GROUP BY 1, 2, 3""")
def _(c: Context):
    loads = c.src["fuel_load"].groupBy(F.hour("load_datetime").alias("time_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return calendar.time_dimension(c.spark).join(loads, "time_key", "left").withColumn(
        "loads", F.coalesce("n", F.lit(0))
    )


# -- periods ------------------------------------------------------------------


@query("p01_period_scope", "date_id i, deliveries i, freight d",
       f"SELECT date_id, count(*) AS deliveries, sum(freight_cost) AS freight FROM f_delivery f "
       f"WHERE {IN_97} GROUP BY 1")
def _(c: Context):
    return scope(c.star["fact_delivery"], YEAR_97).groupBy("date_id").agg(
        F.count(F.lit(1)).alias("deliveries"), F.sum("freight_cost").alias("freight")
    )


@query("p02_period_presets", "preset s, first_day s, last_day s, deliveries i", """
SELECT preset, CASE WHEN preset <> 'todo' THEN last - days END AS first_day,
  CASE WHEN preset <> 'todo' THEN last END AS last_day,
  count(*) FILTER (WHERE preset = 'todo' OR day BETWEEN last - days AND last) AS deliveries
FROM (VALUES ('mes', 30), ('trimestre', 91), ('anio', 365), ('todo', 0)) p(preset, days),
  (SELECT @ AS day, max(@) OVER () AS last FROM f_delivery) f
GROUP BY preset, days, last""".replace("@", o.key_day("date_id")))
def _(c: Context):
    last = reports.data_bounds(c.star).first()["last_day"]
    per_day = c.star["fact_delivery"].groupBy("date_id").agg(F.count(F.lit(1)).alias("n"))
    picks = None
    for preset in ("mes", "trimestre", "anio", "todo"):
        period = from_request(preset, last_day=last)
        row = scope(per_day, period).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("deliveries"))
        row = row.select(
            F.lit(preset).alias("preset"),
            F.lit(period.start).cast("date").alias("first_day"),
            F.lit(period.end).cast("date").alias("last_day"), "deliveries",
        )
        picks = row if picks is None else picks.unionByName(row)
    return picks


# -- star joins ---------------------------------------------------------------


@query("j01_feature_join", "route_type s, vehicle_type s, customer_type s, rows i, late i",
       "SELECT route_type, vehicle_type, customer_type, count(*) AS rows, sum(is_delayed) AS late "
       "FROM features GROUP BY ALL")
def _(c: Context):
    return features.delivery_features(c.star).groupBy(
        "route_type", "vehicle_type", "customer_type"
    ).agg(F.count(F.lit(1)).alias("rows"), F.sum("is_delayed").alias("late"))


@query("j02_route_months", "route_type s, year_month i, shipments i, routes i",
       "SELECT r.route_type, date_id // 100 AS year_month, count(*) AS shipments, "
       "count(DISTINCT r.code) AS routes FROM f_delivery f JOIN c_route r ON r.code = f.route "
       "GROUP BY ALL")
def _(c: Context):
    monthly = c.star["fact_delivery"].groupBy(
        "route_id", F.floor(F.col("date_id") / 100).alias("year_month")
    ).agg(F.count(F.lit(1)).alias("n"))
    return member(monthly, c.star, "dim_route", "route_id", "route_type").groupBy(
        "route_type", "year_month"
    ).agg(F.sum("n").alias("shipments"), F.count(F.lit(1)).alias("routes"))


@query("j03_dimension_navigation", "customer_type s, cause s, deliveries i",
       "SELECT k.customer_type, x.name AS cause, count(*) AS deliveries FROM f_delivery f "
       "JOIN c_customer k ON k.code = f.customer LEFT JOIN c_cause x ON x.code = f.cause "
       "GROUP BY ALL")
def _(c: Context):
    counts = c.star["fact_delivery"].groupBy("customer_id", "delay_cause_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    named = member(counts, c.star, "dim_customer", "customer_id", "customer_type")
    named = member(
        named, c.star, "dim_delay_cause", "delay_cause_id", F.col("name").alias("cause"),
        how="left",
    )
    return named.groupBy("customer_type", "cause").agg(F.sum("n").alias("deliveries"))


# -- registry and sinks -------------------------------------------------------

_REPORT_SQL = {
    "rutas": _top_routes(100),
    "rutas-retrasadas": _worst_routes(100),
    "operadores": _top_operators(100),
    "costos-vehiculo": COSTS + "ORDER BY total_cost DESC, v.plate LIMIT 200",
    "rendimiento": _efficiency(200),
    "demanda-servicio": DEMAND,
    "demanda-cliente": _top_customers(200),
    "costo-por-km": _cost_per_km(200),
}


@query("s08_csv_report", "codigo s, ruta s, zona s, envios i, retraso d",
       f"SELECT code AS codigo, name AS ruta, zone AS zona, shipments AS envios, "
       f"delay_rate AS retraso FROM ({_top_routes(100)}) t")
def _(c: Context):
    path = c.scratch("report-rutas")
    reports.write_csv(c.star, "rutas", path)
    read = c.spark.read.option("header", True).csv(path)
    return read.toDF("codigo", "ruta", "zona", "envios", "retraso")


@query("s09_report_registry", "slug s, title s, columns i, rows i",
       "\nUNION ALL\n".join(
           f"SELECT '{slug}' AS slug, '{reports.REPORTS[slug].label}' AS title, "
           f"{len(reports.REPORTS[slug].columns)} AS columns, count(*) AS rows FROM ({sql}) t"
           for slug, sql in _REPORT_SQL.items()))
def _(c: Context):
    out = None
    for slug, spec in reports.REPORTS.items():
        built = reports.report(c.star, slug)
        row = built.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(slug).alias("slug"), F.lit(spec.label).alias("title"),
            F.lit(len(built.columns)).alias("columns"), "rows",
        )
        out = row if out is None else out.unionByName(row)
    return out

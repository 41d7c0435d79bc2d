"""Independent SQL for every registered query, written for an ANSI engine.

Nothing here is shared with the library but the lens text: cleaning, verdicts,
reports and measures are stated a second time, in another engine's dialect.
"""

from __future__ import annotations

import re

from haulmart.showcase.lens import _TABLE, LENS, needed

AS_OF = "DATE '2026-08-16'"


# -- fragments ----------------------------------------------------------------


def code(x: str) -> str:
    return f"upper(trim(coalesce({x}, '')))"


def plate(x: str) -> str:
    return f"upper(regexp_replace(coalesce({x}, ''), '[^A-Za-z0-9]', '', 'g'))"


def title(x: str) -> str:
    flat = f"lower(regexp_replace(trim(coalesce({x}, '')), '\\s+', ' ', 'g'))"
    runs = f"regexp_extract_all({flat}, '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || t[2:]), '')"


def blank(x: str, fallback: str = "DESCONOCIDA") -> str:
    return f"CASE WHEN trim(coalesce({x}, '')) = '' THEN '{fallback}' ELSE {x} END"


def code_or(x: str, fallback: str) -> str:
    return f"coalesce(nullif({code(x)}, ''), '{fallback}')"


def age(year: str) -> str:
    y = f"greatest(2026 - {year}, 0)"
    return (
        f"CASE WHEN {year} IS NULL THEN NULL WHEN {y} <= 3 THEN '0-3' "
        f"WHEN {y} <= 8 THEN '4-8' ELSE '9+' END"
    )


def capacity(kg: str) -> str:
    return (
        f"CASE WHEN {kg} IS NULL THEN NULL WHEN {kg} < 2000 THEN 'LIGERA' "
        f"WHEN {kg} < 15000 THEN 'MEDIANA' ELSE 'PESADA' END"
    )


def distance(km: str) -> str:
    return (
        f"CASE WHEN {km} IS NULL THEN NULL WHEN {km} < 80 THEN 'CORTA' "
        f"WHEN {km} < 350 THEN 'MEDIA' ELSE 'LARGA' END"
    )


def years(day: str) -> str:
    """Completed years on the fixed day, by (month, day)."""
    return (
        f"greatest(2026 - year({day}) - CASE WHEN 816 < month({day}) * 100 + day({day}) "
        f"THEN 1 ELSE 0 END, 0)"
    )


def seniority(day: str) -> str:
    return (
        f"CASE WHEN {day} IS NULL THEN NULL WHEN {years(day)} <= 2 THEN '0-2' "
        f"WHEN {years(day)} <= 5 THEN '3-5' ELSE '6+' END"
    )


def even(top: str, bottom: str) -> str:
    """Integer quotient rounded half-even, for a non-negative exact fraction."""
    q, r = f"(({top}) // ({bottom}))", f"(({top}) % ({bottom}))"
    return (
        f"({q} + CASE WHEN 2 * {r} > ({bottom}) OR (2 * {r} = ({bottom}) AND {q} % 2 = 1) "
        f"THEN 1 ELSE 0 END)"
    )


def minutes(start: str, end: str) -> str:
    us = f"(epoch_us({end}) - epoch_us({start}))"
    return f"(CASE WHEN {us} < 0 THEN -{even('-' + us, '60000000')} ELSE {even(us, '60000000')} END)"


def date_key(x: str) -> str:
    return f"(year({x}) * 10000 + month({x}) * 100 + day({x}))"


def delay(scheduled: str, actual: str) -> str:
    return f"greatest({minutes(scheduled, actual)}, 0)"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def ratio(top: str, bottom: str, digits: int) -> str:
    """Exact ratio of two two-decimal amounts, half-even, as a double."""
    scale = 10**digits
    value = even(f"{cents(top)} * {scale}", cents(bottom))
    return f"(CAST({value} AS DOUBLE) / {scale})"


def show(x: str, digits: int = 1) -> str:
    return f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    share = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"
    return f"CASE WHEN coalesce({whole}, 0) = 0 THEN 0.0 ELSE {show(share)} END"


def avg(x: str, where: str = "true") -> str:
    return (
        f"(CAST(sum({x}) FILTER (WHERE {where}) AS DOUBLE) / "
        f"nullif(count({x}) FILTER (WHERE {where}), 0))"
    )


def band(hour: str) -> str:
    return (
        f"CASE WHEN {hour} < 6 THEN 'MADRUGADA' WHEN {hour} < 7 THEN 'MANANA' "
        f"WHEN {hour} < 10 THEN 'PICO_AM' WHEN {hour} < 17 THEN 'MEDIODIA' "
        f"WHEN {hour} < 20 THEN 'PICO_PM' ELSE 'NOCHE' END"
    )


MONTHS = (
    "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre',"
    "'Octubre','Noviembre','Diciembre']"
)
DAYS = "['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo']"


def key_day(x: str) -> str:
    return f"make_date(CAST({x} // 10000 AS INT), CAST({x} // 100 % 100 AS INT), CAST({x} % 100 AS INT))"


def weekday(x: str) -> str:
    return f"(isodow({key_day(x)}) - 1)"


def judged(source: str, key: str, own: str, order: str = "extracted_at DESC, id DESC") -> str:
    """Position of each row within its key and of the first acceptable one."""
    return f"""
SELECT *, min(CASE WHEN own IS NULL THEN pos END) OVER (PARTITION BY k) AS first_ok
FROM (SELECT *, {own} AS own,
        row_number() OVER (PARTITION BY k ORDER BY {order}) AS pos
      FROM (SELECT *, {key} AS k FROM {source}) a) b
"""


OK = "k <> '' AND own IS NULL AND pos = first_ok"
VERDICT = (
    "CASE WHEN k = '' THEN 'deduplicate' WHEN pos > first_ok THEN 'deduplicate' ELSE own END"
)


# -- shared tables ------------------------------------------------------------

SHARED: dict[str, str] = {}

SHARED["j_customer"] = judged("stg_customer", code("code"), "CAST(NULL AS VARCHAR)")
SHARED["c_customer"] = f"""
SELECT k AS code, {title('business_name')} AS business_name, {code('tax_id')} AS tax_id,
  {blank(title('city'))} AS city, {blank(title('state'))} AS state,
  {code_or('customer_type', 'REGULAR')} AS customer_type
FROM j_customer WHERE {OK}
"""
SHARED["j_vehicle"] = judged(
    "stg_vehicle", plate("plate"),
    "CASE WHEN year IS NULL OR cargo_capacity_kg IS NULL THEN 'missing_required' END",
)
SHARED["c_vehicle"] = f"""
SELECT k AS plate, {code('economic_number')} AS economic_number, {title('brand')} AS brand,
  {title('model')} AS model, year, {code('vehicle_type')} AS vehicle_type,
  {age('year')} AS age_range, {capacity('cargo_capacity_kg')} AS capacity_range
FROM j_vehicle WHERE {OK}
"""
SHARED["j_operator"] = judged(
    "stg_operator", code("employee_number"),
    "CASE WHEN hire_date IS NULL THEN 'missing_required' END",
)
SHARED["c_operator"] = f"""
SELECT k AS employee_number,
  {title("coalesce(first_name, '') || ' ' || coalesce(last_name, '')")} AS full_name,
  {code_or('license_type', 'C')} AS license_type, {seniority('hire_date')} AS seniority_range
FROM j_operator WHERE {OK}
"""
SHARED["j_route"] = judged(
    "stg_route", code("code"), "CASE WHEN NOT coalesce(distance_km > 0, false) THEN 'is_positive' END"
)
SHARED["c_route"] = f"""
SELECT k AS code, {title('name')} AS name, {blank(title('origin_city'))} AS origin_city,
  {blank(title('destination_city'))} AS destination_city, distance_km,
  {distance('distance_km')} AS distance_range, {code('route_type')} AS route_type,
  {code_or('zone', 'SIN_ZONA')} AS zone
FROM j_route WHERE {OK}
"""
SHARED["j_cause"] = judged("stg_delay_cause", code("code"), "CAST(NULL AS VARCHAR)")
SHARED["c_cause"] = f"""
SELECT k AS code, {title('name')} AS name, {code_or('category', 'EXTERNA')} AS category
FROM j_cause WHERE {OK}
UNION ALL
SELECT 'NO_ESPECIFICADA', 'No Especificada', 'EXTERNA'
WHERE NOT EXISTS (SELECT 1 FROM j_cause WHERE k = 'NO_ESPECIFICADA')
"""
SHARED["k_delivery"] = f"""
SELECT d.*, c.code AS has_customer, r.code AS has_route, v.plate AS has_vehicle,
  o.employee_number AS has_operator, x.code AS has_cause, r.distance_km AS route_km
FROM stg_delivery d
LEFT JOIN c_customer c ON c.code = {code('d.customer_code')}
LEFT JOIN c_route r ON r.code = {code('d.route_code')}
LEFT JOIN c_vehicle v ON v.plate = {plate('d.vehicle_plate')}
LEFT JOIN c_operator o ON o.employee_number = {code('d.operator_number')}
LEFT JOIN c_cause x ON x.code = {code('d.delay_cause_code')}
"""
MISSING = (
    "concat_ws(', ', CASE WHEN has_customer IS NULL THEN 'cliente' END, "
    "CASE WHEN has_route IS NULL THEN 'ruta' END, "
    "CASE WHEN has_vehicle IS NULL THEN 'vehículo' END, "
    "CASE WHEN has_operator IS NULL THEN 'operador' END)"
)
SHARED["j_delivery"] = judged(
    "k_delivery", code("folio"),
    f"""CASE WHEN NOT coalesce(freight_cost >= 0, false) THEN 'is_non_negative'
  WHEN actual_arrival IS NULL THEN 'open_delivery'
  WHEN NOT coalesce(actual_arrival >= coalesce(actual_departure, scheduled_departure), false)
    THEN 'dates_are_coherent'
  WHEN {MISSING} <> '' THEN 'referential_integrity'
  WHEN scheduled_departure IS NULL OR scheduled_arrival IS NULL THEN 'missing_required' END""",
)
_DELAY = delay("scheduled_arrival", "actual_arrival")
SHARED["f_delivery"] = f"""
SELECT k AS folio, has_customer AS customer, has_route AS route, has_vehicle AS vehicle,
  has_operator AS operator,
  CASE WHEN {_DELAY} > 15 THEN coalesce(has_cause, 'NO_ESPECIFICADA') END AS cause,
  {date_key('scheduled_departure')} AS date_id, hour(scheduled_departure) AS time_id,
  cargo_weight_kg, coalesce(packages_count, 0) AS packages_count, freight_cost,
  {minutes('scheduled_departure', 'scheduled_arrival')} AS planned_duration_min,
  {minutes('coalesce(actual_departure, scheduled_departure)', 'actual_arrival')}
    AS actual_duration_min,
  {_DELAY} AS delay_minutes, CASE WHEN {_DELAY} > 15 THEN 1 ELSE 0 END AS is_delayed,
  route_km AS distance_km, {ratio('freight_cost', 'route_km', 4)} AS cost_per_km
FROM j_delivery WHERE {OK}
"""
SHARED["k_fuel"] = f"""
SELECT s.*, v.plate AS has_vehicle, o.employee_number AS has_operator,
  CASE WHEN travelled > 0 AND liters > 0 THEN {ratio('travelled', 'liters', 2)} END AS efficiency
FROM (SELECT *, odometer_km - last_value(odometer_km IGNORE NULLS) OVER (
        PARTITION BY {plate('vehicle_plate')} ORDER BY vehicle_plate, load_datetime, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS travelled
      FROM stg_fuel_load) s
LEFT JOIN c_vehicle v ON v.plate = {plate('s.vehicle_plate')}
LEFT JOIN c_operator o ON o.employee_number = {code('s.operator_number')}
"""
SHARED["j_fuel"] = judged(
    "k_fuel", code("folio"),
    """CASE WHEN NOT coalesce(liters > 0, false) THEN 'is_positive'
  WHEN has_vehicle IS NULL OR has_operator IS NULL THEN 'referential_integrity'
  WHEN efficiency < 1 OR efficiency > 12 THEN 'is_efficiency_outlier' END""",
    "vehicle_plate, load_datetime, id",
)
SHARED["f_fuel"] = f"""
SELECT k AS folio, has_vehicle AS vehicle, has_operator AS operator,
  {date_key('load_datetime')} AS date_id, hour(load_datetime) AS time_id,
  liters, price_per_liter, total_cost, travelled AS km_traveled,
  efficiency AS efficiency_km_per_liter
FROM j_fuel WHERE {OK}
"""
SHARED["k_maintenance"] = f"""
SELECT m.*, v.plate AS has_vehicle FROM stg_maintenance m
LEFT JOIN c_vehicle v ON v.plate = {plate('m.vehicle_plate')}
"""
SHARED["j_maintenance"] = judged(
    "k_maintenance", code("folio"),
    """CASE WHEN has_vehicle IS NULL THEN 'referential_integrity'
  WHEN NOT coalesce(total_cost >= 0, false) THEN 'is_non_negative' END""",
)
SHARED["f_maintenance"] = f"""
SELECT k AS folio, has_vehicle AS vehicle, {date_key('service_date')} AS date_id,
  {code('maintenance_type')} AS maintenance_type, labor_cost, parts_cost, total_cost,
  coalesce(days_out_of_service, 0) AS days_out_of_service, odometer_km
FROM j_maintenance WHERE {OK}
"""
_REJECTS = {
    "stg_customer": ("j_customer", "CASE WHEN k = '' THEN CAST(source_id AS VARCHAR) ELSE k END",
                     "CASE WHEN k = '' THEN 'normalize_code' ELSE 'deduplicate' END"),
    "stg_vehicle": ("j_vehicle",
                    f"CASE WHEN {VERDICT} = 'deduplicate' THEN coalesce(plate, '') ELSE k END",
                    VERDICT),
    "stg_operator": ("j_operator",
                     f"CASE WHEN {VERDICT} = 'deduplicate' THEN coalesce(employee_number, '') "
                     "ELSE k END", VERDICT),
    "stg_route": ("j_route",
                  f"CASE WHEN {VERDICT} = 'deduplicate' THEN coalesce(code, '') ELSE k END",
                  VERDICT),
    "stg_delay_cause": ("j_cause", "k", VERDICT),
    "stg_delivery": ("j_delivery", "k", VERDICT),
    "stg_fuel_load": ("j_fuel", "k", VERDICT),
    "stg_maintenance": ("j_maintenance", "k", VERDICT),
}
SHARED["rejects"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS source_table, {pk} AS source_pk, {rule} AS rule "
    f"FROM {source} WHERE NOT ({OK})"
    for table, (source, pk, rule) in _REJECTS.items()
)
SHARED["profile"] = f"""
SELECT r.code AS route_code, r.name AS route_name, r.route_type, r.zone,
  {avg('f.distance_km')} AS distance_km, {avg('f.actual_duration_min')} AS avg_duration_min,
  {avg('f.is_delayed')} AS delay_rate, {avg('f.delay_minutes')} AS avg_delay_minutes,
  {avg('f.cargo_weight_kg')} AS avg_cargo_kg,
  CAST(sum(CAST(f.cost_per_km AS DECIMAL(20,4))) AS DOUBLE) / count(*) AS avg_cost_per_km,
  CAST(count(*) AS DOUBLE) / count(DISTINCT f.date_id // 100) AS monthly_shipments
FROM f_delivery f JOIN c_route r ON r.code = f.route GROUP BY ALL
"""
SHARED["features"] = f"""
SELECT f.folio, CAST(f.distance_km AS DOUBLE) AS distance_km, f.planned_duration_min,
  CAST(f.cargo_weight_kg AS DOUBLE) AS cargo_weight_kg, f.packages_count,
  {weekday('f.date_id')} AS day_of_week, r.code AS route_code, r.route_type, r.zone,
  r.distance_range, {band('f.time_id')} AS time_band, v.vehicle_type,
  v.age_range AS vehicle_age_range, o.seniority_range AS operator_seniority_range,
  c.customer_type, CASE WHEN {weekday('f.date_id')} >= 5 THEN 'true' ELSE 'false' END AS is_weekend,
  f.delay_minutes, f.is_delayed
FROM f_delivery f JOIN c_route r ON r.code = f.route JOIN c_vehicle v ON v.plate = f.vehicle
JOIN c_operator o ON o.employee_number = f.operator JOIN c_customer c ON c.code = f.customer
"""


# The same tables over landings of the operational sources: the landing
# extract first, then every shared table under the prefix "lnd_".
_LANDING = {
    "lnd_customer": "SELECT * FROM src_customer",
    "lnd_vehicle": "SELECT * FROM src_vehicle",
    "lnd_operator": "SELECT * FROM src_operator",
    "lnd_route": "SELECT * FROM src_route",
    "lnd_delay_cause": "SELECT * FROM src_delay_cause",
    "lnd_delivery": """
SELECT d.*, c.code AS customer_code, r.code AS route_code, v.plate AS vehicle_plate,
  o.employee_number AS operator_number, x.code AS delay_cause_code
FROM src_delivery d LEFT JOIN src_customer c ON c.id = d.customer_id
LEFT JOIN src_route r ON r.id = d.route_id LEFT JOIN src_vehicle v ON v.id = d.vehicle_id
LEFT JOIN src_operator o ON o.id = d.operator_id LEFT JOIN src_delay_cause x ON x.id = d.delay_cause_id
""",
    "lnd_fuel_load": """
SELECT f.*, v.plate AS vehicle_plate, o.employee_number AS operator_number
FROM src_fuel_load f LEFT JOIN src_vehicle v ON v.id = f.vehicle_id
LEFT JOIN src_operator o ON o.id = f.operator_id
""",
    "lnd_maintenance": """
SELECT m.*, v.plate AS vehicle_plate FROM src_maintenance m LEFT JOIN src_vehicle v ON v.id = m.vehicle_id
""",
}
_LOADED = {}
for _name, _text in SHARED.items():
    for _other in SHARED:
        _text = re.sub(rf"\b{_other}\b", f"lnd_{_other}", _text)
    _text = re.sub(r"(?<!')\bstg_(\w+)", r"lnd_\1", _text)
    _text = _text.replace("extracted_at DESC, id DESC", "id DESC")
    _text = _text.replace("CAST(source_id AS VARCHAR)", "CAST(id AS VARCHAR)")
    _LOADED[f"lnd_{_name}"] = _text


def _plain(text: str) -> str:
    return _TABLE.sub(lambda m: m.group(1), text.replace("{TS}", "TIMESTAMP "))


def assemble(body: str) -> str:
    """Prefix ``body`` with every lens and shared table it needs."""
    texts = {**{n: _plain(t) for n, t in LENS.items()}, **SHARED, **_LANDING, **_LOADED, "_body": body}
    names = needed("_body", texts)[:-1]
    heads = ", ".join(f"{n} AS ({texts[n]})" for n in names)
    return f"WITH {heads} {body}" if names else body

"""Cleaning rules and derived values, column by column over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmart.functions import cleaning as c
from haulmart.functions import derive as d
from haulmart.functions import render as r
from haulmart.plans import operational
from haulmart.showcase import oracle as o
from haulmart.showcase.registry import AS_OF, Context, query

col = F.col


@query("f01_normalize_text", "p_partkey i, text s",
       f"SELECT p_partkey, {o.title(chr(39) + '  ' + chr(39) + ' || upper(p_name) || ' + chr(39) + '   o' + chr(39) * 2 + 'neil 3rd-' + chr(39) + ' || p_type')} AS text FROM part")
def _(x: Context):
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("   o'neil 3rd-"), col("p_type"))
    return x.table("part").select("p_partkey", c.normalize_text(raw).alias("text"))


@query("f02_normalize_code", "id i, code s",
       f"SELECT id, {o.code('customer_code')} AS code FROM stg_delivery")
def _(x: Context):
    return x.stg["stg_delivery"].select("id", c.normalize_code(col("customer_code")).alias("code"))


@query("f03_normalize_plate", "id i, plate s",
       f"SELECT id, {o.plate('vehicle_plate')} AS plate FROM stg_delivery")
def _(x: Context):
    return x.stg["stg_delivery"].select("id", c.normalize_plate(col("vehicle_plate")).alias("plate"))


@query("f04_default_if_blank", "id i, city s, state s",
       f"SELECT id, {o.blank('city')} AS city, {o.blank('state')} AS state FROM stg_customer")
def _(x: Context):
    return x.stg["stg_customer"].select(
        "id", *[c.default_if_blank(col(n)).alias(n) for n in ("city", "state")]
    )


@query("f05_code_fallback", "id i, license_type s",
       f"SELECT id, {o.code_or('license_type', 'C')} AS license_type FROM stg_operator")
def _(x: Context):
    return x.stg["stg_operator"].select("id", c.code_or(col("license_type"), "C").alias("license_type"))


@query("f06_is_positive", "id i, ok s",
       "SELECT id, coalesce(liters > 0, false) AS ok FROM stg_fuel_load")
def _(x: Context):
    return x.stg["stg_fuel_load"].select("id", c.is_positive(col("liters")).alias("ok"))


@query("f07_is_non_negative", "id i, ok s",
       "SELECT id, coalesce(total_cost >= 0, false) AS ok FROM stg_maintenance")
def _(x: Context):
    return x.stg["stg_maintenance"].select("id", c.is_non_negative(col("total_cost")).alias("ok"))


@query("f08_dates_are_coherent", "id i, ok s",
       "SELECT id, CASE WHEN actual_departure IS NULL THEN false WHEN actual_arrival IS NULL "
       "THEN true ELSE actual_arrival >= actual_departure END AS ok FROM stg_delivery")
def _(x: Context):
    return x.stg["stg_delivery"].select(
        "id", c.dates_are_coherent(col("actual_departure"), col("actual_arrival")).alias("ok")
    )


@query("f09_is_efficiency_outlier", "id i, outlier s",
       "SELECT id, CASE WHEN liters > 5 THEN NOT (liters BETWEEN 1 AND 12) ELSE "
       "coalesce(NOT (odometer_km BETWEEN 1 AND 12), false) END AS outlier FROM stg_fuel_load")
def _(x: Context):
    value = F.when(col("liters") > 5, col("liters")).otherwise(col("odometer_km"))
    return x.stg["stg_fuel_load"].select("id", c.is_efficiency_outlier(value).alias("outlier"))


@query("f10_age_range", "id i, bucket s", f"SELECT id, {o.age('year')} AS bucket FROM src_vehicle")
def _(x: Context):
    return x.src["vehicle"].select("id", c.age_range(col("year"), AS_OF.year).alias("bucket"))


@query("f11_distance_range", "code s, bucket s",
       f"SELECT code, {o.distance('distance_km')} AS bucket FROM src_route")
def _(x: Context):
    return x.src["route"].select("code", c.distance_range(col("distance_km")).alias("bucket"))


@query("f12_capacity_range", "id i, bucket s",
       f"SELECT id, {o.capacity('cargo_capacity_kg')} AS bucket FROM src_vehicle")
def _(x: Context):
    return x.src["vehicle"].select("id", c.capacity_range(col("cargo_capacity_kg")).alias("bucket"))


@query("f13_seniority_range", "id i, years i, bucket s",
       f"SELECT id, CASE WHEN hire_date IS NOT NULL THEN {o.years('hire_date')} END AS years, "
       f"{o.seniority('hire_date')} AS bucket FROM stg_operator")
def _(x: Context):
    return x.stg["stg_operator"].select(
        "id", c.full_years(col("hire_date"), AS_OF).alias("years"),
        c.seniority_range(col("hire_date"), AS_OF).alias("bucket"),
    )


@query("f14_time_band", "event_id i, band s",
       f"SELECT event_id, {o.band('hour(ts)')} AS band FROM events")
def _(x: Context):
    return x.table("events").select("event_id", d.time_band(F.hour("ts")).alias("band"))


@query("f15_minutes", "id i, early i, late i",
       f"SELECT id, {o.minutes('scheduled_arrival', 'actual_arrival')} AS early, "
       f"{o.minutes('scheduled_departure', 'actual_arrival')} AS late FROM stg_delivery")
def _(x: Context):
    return x.stg["stg_delivery"].select(
        "id", d.minutes(col("scheduled_arrival"), col("actual_arrival")).alias("early"),
        d.minutes(col("scheduled_departure"), col("actual_arrival")).alias("late"),
    )


@query("f16_date_and_time_keys", "event_id i, date_key i, time_key i",
       f"SELECT event_id, {o.date_key('ts')} AS date_key, hour(ts) AS time_key FROM events")
def _(x: Context):
    return x.table("events").select(
        "event_id", d.date_key(col("ts")).alias("date_key"), d.time_key(col("ts")).alias("time_key")
    )


@query("f16_business_zone", "event_id i, date_key i, time_key i",
       f"SELECT event_id, {o.date_key('local')} AS date_key, hour(local) AS time_key FROM ("
       "SELECT event_id, timezone('America/Mexico_City', timezone('UTC', CAST(ts AS TIMESTAMP))) "
       "AS local FROM events) e")
def _(x: Context):
    """Instants by the clock of the business, whatever the session's zone."""
    events = x.table("events").select("event_id", d.moment_in(col("ts"), "UTC").alias("ts"))
    local = d.wall_clock(col("ts"), events.schema["ts"].dataType, "America/Mexico_City")
    return events.select(
        "event_id", d.date_key(local).alias("date_key"), d.time_key(local).alias("time_key")
    )


@query("f17_delivery_measures",
       "folio s, planned i, actual i, delay i, is_delayed i",
       "SELECT folio, planned_duration_min AS planned, actual_duration_min AS actual, "
       "delay_minutes AS delay, is_delayed FROM f_delivery")
def _(x: Context):
    return x.rows("deliveries").select(
        "folio", col("planned_duration_min").alias("planned"),
        col("actual_duration_min").alias("actual"), col("delay_minutes").alias("delay"),
        "is_delayed",
    )


@query("f18_cost_per_km", "folio s, freight_cost d, distance_km d, cost_per_km d",
       "SELECT folio, freight_cost, distance_km, cost_per_km FROM f_delivery")
def _(x: Context):
    return x.rows("deliveries").select("folio", "freight_cost", "distance_km", "cost_per_km")


@query("f19_load_efficiency", "folio s, km d, liters d, efficiency d",
       "SELECT folio, km_traveled AS km, liters, efficiency_km_per_liter AS efficiency FROM f_fuel")
def _(x: Context):
    return x.rows("fuel_loads").select(
        "folio", col("km_traveled").alias("km"), "liters",
        col("efficiency_km_per_liter").alias("efficiency"),
    )


@query("f20_full_name", "id i, raw s, shown s",
       "SELECT id, trim(first_name || ' ' || last_name) AS raw, "
       f"{o.title(chr(39) * 2 + ' || first_name || ' + chr(39) + ' ' + chr(39) + ' || last_name')}"
       " AS shown FROM stg_operator")
def _(x: Context):
    name = d.full_name(col("first_name"), col("last_name"))
    return x.stg["stg_operator"].select("id", name.alias("raw"), c.normalize_text(name).alias("shown"))


@query("f21_vehicle_state", "id i, km_to_next_service d, days_since_service i, needs_maintenance s",
       f"""SELECT id, next_service_km - current_odometer_km AS km_to_next_service,
  date_diff('day', last_service_date, {o.AS_OF}) AS days_since_service,
  next_service_km - current_odometer_km <= 1000 OR last_service_date IS NULL
    OR date_diff('day', last_service_date, {o.AS_OF}) > 180 AS needs_maintenance
FROM src_vehicle""")
def _(x: Context):
    return operational.vehicle_state(x.src["vehicle"], AS_OF)


@query("f22_average_speed", "code s, speed d",
       "SELECT code, CASE WHEN estimated_duration_min = 0 THEN 0 ELSE "
       f"{o.ratio('distance_km * 60', 'CAST(estimated_duration_min AS DECIMAL(12,2))', 2)} END "
       "AS speed FROM src_route")
def _(x: Context):
    return x.src["route"].select(
        "code", d.average_speed(col("distance_km"), col("estimated_duration_min")).alias("speed")
    )


@query("f23_delivery_properties", "id i, delay i, is_delayed i, is_open s, transit i", f"""
SELECT id, CASE WHEN actual_arrival IS NULL THEN 0 ELSE {o.delay('scheduled_arrival', 'actual_arrival')}
  END AS delay,
  CASE WHEN actual_arrival IS NOT NULL AND {o.delay('scheduled_arrival', 'actual_arrival')} > 15
    THEN 1 ELSE 0 END AS is_delayed,
  status NOT IN ('DELIVERED', 'DELAYED', 'CANCELLED') AS is_open,
  {o.minutes('actual_departure', 'actual_arrival')} AS transit
FROM src_delivery""")
def _(x: Context):
    delay = d.delay_minutes(col("scheduled_arrival"), col("actual_arrival"))
    return x.src["delivery"].select(
        "id", delay.alias("delay"), d.is_delayed(delay).alias("is_delayed"),
        d.is_open(col("status")).alias("is_open"),
        d.minutes(col("actual_departure"), col("actual_arrival")).alias("transit"),
    )


@query("f24_license_validity", "id i, valid s",
       f"SELECT id, license_expiry >= {o.AS_OF} AS valid FROM src_operator")
def _(x: Context):
    return x.src["operator"].select("id", d.license_is_valid(col("license_expiry"), AS_OF).alias("valid"))


@query("f25_derived_totals", "kind s, id i, total d",
       "SELECT 'fuel' AS kind, id, liters * price_per_liter AS total FROM src_fuel_load "
       "UNION ALL SELECT 'maintenance', id, labor_cost + parts_cost FROM src_maintenance")
def _(x: Context):
    fuel = x.src["fuel_load"].select(
        F.lit("fuel").alias("kind"), "id",
        d.fuel_total(col("liters"), col("price_per_liter")).alias("total"),
    )
    work = x.src["maintenance"].select(
        F.lit("maintenance").alias("kind"), "id",
        d.maintenance_total(col("labor_cost"), col("parts_cost")).alias("total"),
    )
    return fuel.unionByName(work)


@query("f26_json_snapshot", "id i, payload s",
       "SELECT id, to_json({'folio': folio, 'vehicle_plate': vehicle_plate, "
       "'total_cost': CAST(total_cost AS VARCHAR), 'service_date': CAST(service_date AS VARCHAR), "
       "'days_out_of_service': CAST(days_out_of_service AS VARCHAR)}) AS payload "
       "FROM stg_maintenance")
def _(x: Context):
    return x.stg["stg_maintenance"].select(
        "id",
        r.snapshot("folio", "vehicle_plate", "total_cost", "service_date",
                   "days_out_of_service").alias("payload"),
    )


@query("f27_spelled_date", "id i, day s",
       f"SELECT id, day(scheduled_departure) || ' de ' || "
       f"lower({o.MONTHS}[month(scheduled_departure)]) || ' de ' || year(scheduled_departure) AS day "
       "FROM src_delivery")
def _(x: Context):
    return x.src["delivery"].select("id", r.spell_date(col("scheduled_departure")).alias("day"))


@query("f28_display_labels", "id i, kind s, status s, active s, serviced s", """
SELECT id, CASE vehicle_type WHEN 'TRUCK' THEN 'Camión' WHEN 'VAN' THEN 'Camioneta'
    WHEN 'TRAILER' THEN 'Tráiler' ELSE 'Pick-up' END AS kind,
  CASE status WHEN 'AVAILABLE' THEN 'Disponible' WHEN 'ON_ROUTE' THEN 'En ruta'
    WHEN 'IN_MAINTENANCE' THEN 'En mantenimiento' ELSE 'Fuera de servicio' END AS status,
  CASE WHEN is_active THEN 'Sí' ELSE 'No' END AS active,
  coalesce(CAST(last_service_date AS VARCHAR), '') AS serviced
FROM src_vehicle""")
def _(x: Context):
    return x.src["vehicle"].select(
        "id", r.label(col("vehicle_type"), "vehicle_type").alias("kind"),
        r.label(col("status"), "vehicle_status").alias("status"),
        r.yes_no(col("is_active")).alias("active"),
        F.coalesce(col("last_service_date").cast("string"), F.lit("")).alias("serviced"),
    )

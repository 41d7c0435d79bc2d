"""Extract, clean, load, publish; verdicts, chains and keys."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haulmart.functions import derive as d
from haulmart.operators import keys
from haulmart.plans import audit, load, operational, transform
from haulmart.plans.load import LoadError
from haulmart.plans.run import Run, run_etl
from haulmart.showcase import oracle as o
from haulmart.showcase.registry import AS_OF, Context, query
from haulmart.sources import extract
from haulmart.sources.store import Store

RUN = "run-1"
AT = dt.datetime(2024, 3, 1)
col = F.col

# -- sources ------------------------------------------------------------------

LANDED = {t: f"lnd_{t.removeprefix('stg_')}" for t in extract.SOURCES}


@query("s01_full_extract", "table_name s, rows i, ids i", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, sum(id) AS ids FROM {lnd}"
    for t, lnd in LANDED.items()))
def _(x: Context):
    return audit.stack([
        extract.land(x.src, t, RUN, AT).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("source_id").alias("ids")
        ).select(F.lit(t).alias("table_name"), "rows", "ids")
        for t in extract.SOURCES
    ])


@query("s01_crashed_full_extract", "table_name s, rows i, ids i", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, sum(id) AS ids FROM {lnd}"
    for t, lnd in LANDED.items()))
def _(x: Context):
    """A full extract that breaks off at its last table leaves the landing tables as they were."""
    store = Store(x.spark, x.scratch("crashed-" + x.sf_dir.strip("/").replace("/", "-")))
    Run(store, "full", AS_OF).extract(x.src)
    emptied = {name: rows.limit(0) for name, rows in x.src.items()}
    unreadable = F.raise_error(F.lit("unreadable")).cast("string")
    emptied["maintenance"] = x.src["maintenance"].withColumn("folio", unreadable)
    try:
        Run(store, "full", AS_OF).extract(emptied)
    except PySparkException as error:
        if "unreadable" not in str(error):
            raise
    return audit.stack([
        store.staging(t).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("source_id").alias("ids")
        ).select(F.lit(t).alias("table_name"), "rows", "ids")
        for t in extract.SOURCES
    ])


DELIVERY = ("source_id i, folio s, customer_code s, route_code s, vehicle_plate s, "
            "operator_number s, delay_cause_code s, freight_cost d, status s")


@query("s02_incremental_extract", DELIVERY,
       "SELECT id AS source_id, * FROM lnd_delivery "
       "WHERE updated_at > TIMESTAMP '2000-05-05 05:00:00'")
def _(x: Context):
    return extract.land(x.src, "stg_delivery", RUN, AT, dt.datetime(2000, 5, 5, 5))


@query("s03_watermark", "watermark i",
       "SELECT epoch_us(max(finished_at)) AS watermark FROM run_log "
       "WHERE phase = 'LOAD' AND status = 'SUCCESS'")
def _(x: Context):
    return extract.watermark(x.view("run_log")).select(
        F.unix_micros(col("watermark").cast("timestamp")).alias("watermark")
    )


@query("s04_denormalise", DELIVERY, "SELECT id AS source_id, * FROM lnd_delivery")
def _(x: Context):
    return extract.land(x.src, "stg_delivery", RUN, AT)


@query("s05_provenance", "source_id i, run_id s, extracted_at s, folio s, vehicle_plate s",
       "SELECT id AS source_id, 'run-1' AS run_id, '2024-03-01 00:00:00' AS extracted_at, folio, "
       "vehicle_plate FROM lnd_fuel_load")
def _(x: Context):
    return extract.land(x.src, "stg_fuel_load", RUN, AT).withColumn(
        "extracted_at", F.date_format("extracted_at", "yyyy-MM-dd HH:mm:ss")
    )


@query("s07_warehouse_scan", "year_month i, deliveries i, freight d, late i",
       "SELECT date_id // 100 AS year_month, count(*) AS deliveries, sum(freight_cost) AS freight, "
       "sum(is_delayed) AS late FROM lnd_f_delivery GROUP BY 1")
def _(x: Context):
    store, _ = x.warehouse()
    return store.table("fact_delivery").groupBy(
        F.floor(col("date_id") / 100).alias("year_month")
    ).agg(
        F.count(F.lit(1)).alias("deliveries"), F.sum("freight_cost").alias("freight"),
        F.sum("is_delayed").alias("late"),
    )


@query("s12_atomic_publish", "facts_before i, facts_after i, failures_logged i",
       "SELECT count(*) AS facts_before, count(*) AS facts_after, 1 AS failures_logged "
       "FROM lnd_f_delivery")
def _(x: Context):
    store, summary = x.warehouse("published")
    before = store.table("fact_delivery").count()
    groups = {
        g: x.spark.read.parquet(f"{store.root}/work/run={summary.run_id}/{g}")
        for g in transform.SOURCE_OF
    }
    broken = groups["deliveries"].withColumn("customer_code", F.lit("NO-SUCH-CUSTOMER"))
    run = Run(store, "rebuild", AS_OF)
    try:
        run.load({**groups, "deliveries": broken})
    except LoadError:
        pass
    failed = store.log().filter((col("run_id") == run.run_id) & (col("status") == "FAILED"))
    after = store.table("fact_delivery").agg(F.count(F.lit(1)).alias("facts_after"))
    return after.select(
        F.lit(before).alias("facts_before"), "facts_after",
        F.lit(failed.count()).alias("failures_logged"),
    )


# -- clean tables -------------------------------------------------------------


def _clean(name: str, columns: str, group: str, table: str) -> None:
    query(name, columns, f"SELECT * FROM {table}")(lambda x: x.rows(group))


_clean("e01_clean_customers",
       "code s, business_name s, tax_id s, city s, state s, customer_type s",
       "customers", "c_customer")
_clean("e02_clean_vehicles",
       "plate s, economic_number s, brand s, model s, year i, vehicle_type s, age_range s, "
       "capacity_range s", "vehicles", "c_vehicle")
_clean("e03_clean_operators", "employee_number s, full_name s, license_type s, seniority_range s",
       "operators", "c_operator")
_clean("e04_clean_routes",
       "code s, name s, origin_city s, destination_city s, distance_km d, distance_range s, "
       "route_type s, zone s", "routes", "c_route")
_clean("e05_clean_delay_causes", "code s, name s, category s", "delay_causes", "c_cause")
_clean("u02_unspecified_marker", "code s, category s", "delay_causes", "c_cause")

FACT = ("folio s, customer_code s, route_code s, vehicle_plate s, operator_number s, "
        "delay_cause_code s, date_key i, time_key i, cargo_weight_kg d, packages_count i, "
        "freight_cost d, planned_duration_min i, actual_duration_min i, delay_minutes i, "
        "is_delayed i, distance_km d, cost_per_km d")
FACT_SQL = ("SELECT *, customer AS customer_code, route AS route_code, vehicle AS vehicle_plate, "
            "operator AS operator_number, cause AS delay_cause_code, date_id AS date_key, "
            "time_id AS time_key FROM f_delivery")
FUEL = ("folio s, vehicle_plate s, operator_number s, date_key i, time_key i, liters d, "
        "price_per_liter d, total_cost d, km_traveled d, efficiency_km_per_liter d")
FUEL_SQL = ("SELECT *, vehicle AS vehicle_plate, operator AS operator_number, "
            "date_id AS date_key, time_id AS time_key FROM f_fuel")
WORK = ("folio s, vehicle_plate s, date_key i, maintenance_type s, labor_cost d, parts_cost d, "
        "total_cost d, days_out_of_service i, odometer_km d")
WORK_SQL = "SELECT *, vehicle AS vehicle_plate, date_id AS date_key FROM f_maintenance"


@query("e06_clean_deliveries", FACT, FACT_SQL)
def _(x: Context):
    return x.rows("deliveries")


@query("e07_clean_fuel_loads", FUEL, FUEL_SQL)
def _(x: Context):
    return x.rows("fuel_loads")


@query("e08_clean_maintenances", WORK, WORK_SQL)
def _(x: Context):
    return x.rows("maintenances")


@query("w01_newest_wins", "code s, business_name s, city s",
       "SELECT code, business_name, city FROM c_customer")
def _(x: Context):
    return x.rows("customers")


@query("w02_first_accepted_wins", "source_pk s, rule s, rows i",
       "SELECT source_pk, rule, count(*) AS rows FROM rejects "
       "WHERE source_table IN ('stg_delivery', 'stg_route') GROUP BY ALL")
def _(x: Context):
    both = audit.stack([x.cleaned[g].rejected for g in ("deliveries", "routes")])
    return both.groupBy("source_pk", "rule").agg(F.count(F.lit(1)).alias("rows"))


@query("w03_odometer_chain", "id i, travelled d", "SELECT id, travelled FROM k_fuel")
def _(x: Context):
    return transform.odometer_chain(x.stg["stg_fuel_load"]).select(
        "id", col("_travelled").alias("travelled")
    )


@query("e14_phase_log", "table_name s, rows_read i, rows_written i, rows_rejected i", "\nUNION ALL\n".join(
    f"SELECT '{stg}' AS table_name, (SELECT count(*) FROM {stg}) AS rows_read, "
    f"(SELECT count(*) FROM {clean}) AS rows_written, "
    f"(SELECT count(*) FROM rejects WHERE source_table = '{stg}') AS rows_rejected"
    for stg, clean in (
        ("stg_customer", "c_customer"), ("stg_vehicle", "c_vehicle"),
        ("stg_operator", "c_operator"), ("stg_route", "c_route"),
        ("stg_delay_cause", "c_cause"), ("stg_delivery", "f_delivery"),
        ("stg_fuel_load", "f_fuel"), ("stg_maintenance", "f_maintenance"))))
def _(x: Context):
    """What the transform phase wrote into the log of the landed warehouse."""
    log = x.landed_warehouse().log()
    return log.filter((col("phase") == "TRANSFORM") & (col("status") == "SUCCESS"))


# Clean rows of each landing table and where they are loaded.
_LOG = (
    ("customer", "c_customer", "dim_customer"), ("vehicle", "c_vehicle", "dim_vehicle"),
    ("operator", "c_operator", "dim_operator"), ("route", "c_route", "dim_route"),
    ("delay_cause", "c_cause", "dim_delay_cause"), ("delivery", "f_delivery", "fact_delivery"),
    ("fuel_load", "f_fuel", "fact_fuel"), ("maintenance", "f_maintenance", "fact_maintenance"),
)


def _logged(phase: str, table: str, read: str, written: str, rejected: str = "0") -> str:
    return (f"SELECT '{phase}' AS phase, '{table}' AS table_name, {read} AS rows_read, "
            f"{written} AS rows_written, {rejected} AS rows_rejected")


def _count_of(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


_DAYS = " UNION ALL ".join(f"SELECT date_id FROM lnd_f_{f}" for f in ("delivery", "fuel", "maintenance"))


@query("e14_all_phases", "phase s, table_name s, rows_read i, rows_written i, rows_rejected i", "\nUNION ALL\n".join([
    *[_logged("EXTRACT", f"stg_{t}", _count_of(f"lnd_{t}"), _count_of(f"lnd_{t}")) for t, _, _ in _LOG],
    *[_logged("TRANSFORM", f"stg_{t}", _count_of(f"lnd_{t}"), _count_of(f"lnd_{clean}"),
              f"(SELECT count(*) FROM lnd_rejects WHERE source_table = 'stg_{t}')") for t, clean, _ in _LOG],
    *[_logged("LOAD", loaded, _count_of(f"lnd_{clean}"), _count_of(f"lnd_{clean}")) for _, clean, loaded in _LOG],
    _logged("LOAD", "dim_time", "0", "24"),
    _logged("LOAD", "dim_date", "0", f"(SELECT date_diff('day', {o.key_day('min(date_id)')}, "
            f"{o.key_day('max(date_id)')}) + 1 FROM ({_DAYS}) k)"),
]))
def _(x: Context):
    """The whole log of a run from the sources: counts taken by the writes of all three phases."""
    store, summary = x.warehouse()
    return store.log().filter((col("run_id") == summary.run_id) & (col("status") == "SUCCESS"))


@query("e15_quarantine", "source_table s, source_pk s, rule s",
       "SELECT source_table, source_pk, rule FROM rejects")
def _(x: Context):
    return x.landed_warehouse().errors()


@query("j05_referential_integrity", "source_pk s, description s", f"""
SELECT k AS source_pk, 'Referencia inexistente: ' || {o.MISSING} || '.' AS description
FROM j_delivery WHERE {o.VERDICT} = 'referential_integrity' AND NOT ({o.OK})""")
def _(x: Context):
    return x.cleaned["deliveries"].rejected.filter(col("rule") == "referential_integrity")


@query("j06_cause_validity", "folio s, cause s", "SELECT folio, cause FROM f_delivery")
def _(x: Context):
    return x.rows("deliveries").select("folio", col("delay_cause_code").alias("cause"))


@query("j07_distance_lookup", "route_code s, distance_km d, deliveries i",
       "SELECT route AS route_code, distance_km, count(*) AS deliveries FROM f_delivery GROUP BY ALL")
def _(x: Context):
    return x.rows("deliveries").groupBy("route_code", "distance_km").agg(
        F.count(F.lit(1)).alias("deliveries")
    )


# -- keys and loads -----------------------------------------------------------


def _numbered(x: Context) -> dict:
    return {
        s.table: keys.number_rows(
            x.rows(s.group).select(s.natural, *s.attributes), s.natural, s.surrogate
        )
        for s in load.DIMENSIONS
    }


def _round_trip(x: Context, fact: str):
    """Natural keys to surrogates and back through the dimensions."""
    dims = _numbered(x)
    rows = load.resolve(x.rows(load.FACTS[fact][0]), dims, fact)
    for column, table, surrogate, natural, target in load.FACTS[fact][1]:
        back = dims[table].select(col(surrogate).alias(target), col(natural).alias(f"back_{column}"))
        rows = rows.join(back, target, "left")
    return rows


@query("j08_surrogate_resolution",
       "folio s, customer s, route s, vehicle s, operator s, cause s",
       "SELECT folio, customer, route, vehicle, operator, cause FROM f_delivery")
def _(x: Context):
    return _round_trip(x, "fact_delivery").withColumnsRenamed({
        "back_customer_code": "customer", "back_route_code": "route",
        "back_vehicle_plate": "vehicle", "back_operator_number": "operator",
        "back_delay_cause_code": "cause",
    })


@query("e12_load_facts", "fact s, folio s, vehicle s, total d",
       "SELECT 'fact_delivery' AS fact, folio, vehicle, freight_cost AS total FROM f_delivery "
       "UNION ALL SELECT 'fact_fuel', folio, vehicle, total_cost FROM f_fuel "
       "UNION ALL SELECT 'fact_maintenance', folio, vehicle, total_cost FROM f_maintenance")
def _(x: Context):
    dims = _numbered(x)
    out = []
    for fact, amount in (("fact_delivery", "freight_cost"), ("fact_fuel", "total_cost"),
                         ("fact_maintenance", "total_cost")):
        clean = x.rows(load.FACTS[fact][0])
        nothing = clean.select("folio").limit(0)
        rows = load.fact_rows(clean, nothing, dims, fact).join(
            dims["dim_vehicle"].select(col("vehicle_key").alias("vehicle_id"), "plate"),
            "vehicle_id",
        )
        out.append(rows.select(
            F.lit(fact).alias("fact"), "folio", col("plate").alias("vehicle"),
            col(amount).cast("double").alias("total"),
        ))
    return audit.stack(out)


@query("j09_insert_only", "folio s, date_key i",
       "SELECT folio, date_id AS date_key FROM f_delivery WHERE folio NOT IN "
       "(SELECT folio FROM f_delivery WHERE date_id < 19980101)")
def _(x: Context):
    rows = x.rows("deliveries")
    return keys.insert_only(rows.filter(col("date_key") < 19980101), rows, "folio")


CUSTOMER = ("business_name", "city", "state", "customer_type")


@query("j10_type_one_merge", "code s, business_name s, city s, customer_type s, change s", """
SELECT code, CASE WHEN r THEN business_name || ' Nuevo' ELSE business_name END AS business_name,
  city, customer_type, CASE WHEN r AND e THEN 'updated' WHEN r THEN 'inserted' ELSE 'kept' END AS change
FROM (SELECT *, CAST(substr(code, 5) AS BIGINT) % 3 <> 0 AS r,
        CAST(substr(code, 5) AS BIGINT) % 2 = 0 AS e FROM c_customer) t WHERE r OR e""")
def _(x: Context):
    rows, number = x.rows("customers"), F.substring("code", 5, 20).cast("bigint")
    incoming = rows.filter(number % 3 != 0).withColumn(
        "business_name", F.concat("business_name", F.lit(" Nuevo"))
    )
    return keys.merge(rows.filter(number % 2 == 0), incoming, "code", CUSTOMER)


@query("e09_dimension_upsert", "code s, business_name s, kept_key i, keys i", """
SELECT code, CASE WHEN r THEN business_name || ' Nuevo' ELSE business_name END AS business_name,
  CASE WHEN e THEN 1 ELSE 0 END AS kept_key, count(*) OVER () AS keys
FROM (SELECT *, CAST(substr(code, 5) AS BIGINT) % 3 <> 0 AS r,
        CAST(substr(code, 5) AS BIGINT) % 2 = 0 AS e FROM c_customer) t WHERE r OR e""")
def _(x: Context):
    rows, number = x.rows("customers"), F.substring("code", 5, 20).cast("bigint")
    existing = keys.number_rows(
        rows.filter(number % 2 == 0).select("code", *CUSTOMER), "code", "customer_key"
    )
    incoming = rows.filter(number % 3 != 0).withColumn(
        "business_name", F.concat("business_name", F.lit(" Nuevo"))
    )
    last = existing.count()
    merged = keys.upsert(existing, incoming, "customer_key", "code", CUSTOMER, last)
    distinct = merged.agg(F.count_distinct("customer_key")).first()[0]
    was = existing.select("code", col("customer_key").alias("was"))
    return merged.join(was, "code", "left").select(
        "code", "business_name",
        F.coalesce((col("was") == col("customer_key")).cast("int"), F.lit(0)).alias("kept_key"),
        F.lit(distinct).alias("keys"),
    )


# -- pipeline -----------------------------------------------------------------

LOADED = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, count(*) AS rows FROM {sql}"
    for table, sql in (
        ("dim_customer", "lnd_c_customer"), ("dim_vehicle", "lnd_c_vehicle"),
        ("dim_operator", "lnd_c_operator"), ("dim_route", "lnd_c_route"),
        ("dim_delay_cause", "lnd_c_cause"), ("fact_delivery", "lnd_f_delivery"),
        ("fact_fuel", "lnd_f_fuel"), ("fact_maintenance", "lnd_f_maintenance"),
        ("etl_error", "lnd_rejects"),
    ))


def _counts(x: Context, loaded: dict[str, int], rejected: int):
    rows = [(t, n) for t, n in loaded.items() if t not in ("dim_date", "dim_time")]
    return x.spark.createDataFrame([*rows, ("etl_error", rejected)], "table_name string, rows bigint")


@query("e16_etl_run", "table_name s, rows i", LOADED)
def _(x: Context):
    _, summary = x.warehouse()
    return _counts(x, summary.loaded, summary.rejected)


@query("e13_rebuild", "table_name s, rows i", LOADED)
def _(x: Context):
    """A rebuild over a loaded warehouse, from the sources on, ends with the same content."""
    store, _ = x.warehouse("rebuilt")
    again = run_etl(x.spark, x.src, store.root, AS_OF, "rebuild")
    return _counts(x, again.loaded, again.rejected)


@query("e16_incremental_run", "table_name s, extracted i, facts i, customers i, renamed i", """
SELECT 'customer' AS table_name, (SELECT count(*) FROM src_customer WHERE id % 10 = 3) AS extracted,
  (SELECT count(*) FROM lnd_f_delivery) AS facts, (SELECT count(*) FROM lnd_c_customer) AS customers,
  (SELECT count(*) FROM src_customer WHERE id % 10 = 3 AND trim(code) <> '') AS renamed""")
def _(x: Context):
    """Load, rename some customers, run again from the watermark of the log."""
    store, _ = x.warehouse("resumed")
    later = extract.extract_watermark(store.log()).select(
        (col("watermark") + F.expr("INTERVAL 1 DAY")).alias("later")
    ).first()["later"]
    changed = dict(x.src.items())
    touched = col("id") % 10 == 3
    moment = d.instant(later, changed["customer"].schema["updated_at"].dataType, "UTC")
    changed["customer"] = changed["customer"].withColumns({
        "updated_at": F.when(touched, moment).otherwise(col("updated_at")),
        "business_name": F.when(touched, F.lit("Renamed")).otherwise(col("business_name")),
    })
    second = run_etl(x.spark, changed, store.root, AS_OF)
    renamed = store.table("dim_customer").filter(col("business_name") == "Renamed")
    return renamed.agg(F.count(F.lit(1)).alias("renamed")).select(
        F.lit("customer").alias("table_name"),
        F.lit(second.extracted["stg_customer"]).alias("extracted"),
        F.lit(store.table("fact_delivery").count()).alias("facts"),
        F.lit(store.table("dim_customer").count()).alias("customers"), "renamed",
    )


# -- fuel loads of the running fleet ------------------------------------------

PREVIOUS = """
SELECT id, liters, odometer_km,
  (SELECT arg_max(p.odometer_km, {'a': p.load_datetime, 'b': p.id}) FROM src_fuel_load p
   WHERE p.vehicle_id = f.vehicle_id AND p.is_active AND p.load_datetime < f.load_datetime)
    AS previous_odometer_km
FROM src_fuel_load f
"""


@query("j11_previous_load", "id i, previous_odometer_km d", PREVIOUS)
def _(x: Context):
    return operational.previous_load(x.src["fuel_load"])


@query("j11_previous_load_split", "id i, previous_odometer_km d", PREVIOUS)
def _(x: Context):
    return operational.previous_load(x.src["fuel_load"], hot_rows=1)


@query("w04_load_distance_and_efficiency", "id i, km_traveled d, efficiency_km_per_liter d", f"""
SELECT id, km AS km_traveled, CASE WHEN km > 0 AND liters > 0 THEN {o.ratio('km', 'liters', 2)} END
  AS efficiency_km_per_liter
FROM (SELECT *, odometer_km - previous_odometer_km AS km FROM ({PREVIOUS}) p) t""")
def _(x: Context):
    return operational.load_efficiency(x.src["fuel_load"])

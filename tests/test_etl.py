import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from haulmart.operators.keys import insert_only
from haulmart.plans import features, reports
from haulmart.plans.period import ALL, Period, from_request
from haulmart.plans.run import Run, run_etl
from haulmart.plans.load import LoadError
from haulmart.plans.star import Star
from haulmart.sources import catalogue
from haulmart.sources.schemas import DIMENSION_DDL, FACT_DDL, schema, warehouse_schema
from haulmart.sources.store import Store
from tests.fleet import sources

AS_OF = dt.date(2026, 8, 16)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dw"))
    return root, run_etl(spark, sources(spark), root, AS_OF, "rebuild")


def test_counts_add_up(spark, loaded):
    root, summary = loaded
    log = Store(spark, root).log().filter(F.col("phase") == "TRANSFORM").collect()
    assert {r.table_name: (r.rows_read, r.rows_written, r.rows_rejected) for r in log
            if r.table_name in ("stg_delivery", "stg_fuel_load", "stg_maintenance")} == {
        "stg_delivery": (6, 3, 3), "stg_fuel_load": (3, 2, 1), "stg_maintenance": (2, 2, 0)}
    assert summary.rejected == 4
    assert summary.extracted["stg_delivery"] == 6


def test_delay_boundary_and_cause(spark, loaded):
    facts = {r.folio: r for r in Store(spark, loaded[0]).table("fact_delivery").collect()}
    causes = {r.delay_cause_key: r.code for r in
              Store(spark, loaded[0]).table("dim_delay_cause").collect()}
    assert facts["ENT-BOUND-15"].is_delayed == 0 and facts["ENT-BOUND-15"].delay_cause_id is None
    assert facts["ENT-BOUND-16"].is_delayed == 1
    assert causes[facts["ENT-BOUND-16"].delay_cause_id] == "NO_ESPECIFICADA"
    assert causes[facts["ENT-CAUSE"].delay_cause_id] == "TRAFICO"
    assert str(facts["ENT-BOUND-15"].cost_per_km) == "16.6667"
    assert facts["ENT-BOUND-15"].date_id == 20260105 and facts["ENT-BOUND-15"].time_id == 8


def test_rules_named_in_quarantine(spark, loaded):
    errors = {(r.source_pk, r.rule) for r in Store(spark, loaded[0]).errors().collect()}
    assert errors == {("ENT-NEG", "is_non_negative"), ("ENT-OPEN", "open_delivery"),
                      ("ENT-BACK", "dates_are_coherent"), ("COM-2", "is_positive")}


def test_odometer_chain_passes_refused_rows(spark, loaded):
    fact = {r.folio: r for r in Store(spark, loaded[0]).table("fact_fuel").collect()}["COM-3"]
    assert str(fact.km_traveled) == "700.00" and str(fact.efficiency_km_per_liter) == "7.00"


def test_declared_schemas(spark, loaded):
    store = Store(spark, loaded[0])
    for table, ddl in {**DIMENSION_DDL, **FACT_DDL}.items():
        assert store.table(table).schema == schema(ddl)


def test_second_run_changes_nothing(spark, loaded):
    root, _ = loaded
    store = Store(spark, root)
    keys = {r.code: r.customer_key for r in store.table("dim_customer").collect()}
    again = run_etl(spark, sources(spark), root, AS_OF, "full")
    assert again.loaded["fact_delivery"] == 3 and again.loaded["dim_customer"] == 2
    assert {r.code: r.customer_key for r in store.table("dim_customer").collect()} == keys


def test_incremental_takes_only_later_rows(spark, tmp_path):
    root = str(tmp_path)
    run_etl(spark, sources(spark), root, AS_OF, "rebuild")
    changed = sources(spark)
    later = dt.datetime.now() + dt.timedelta(hours=1)
    changed["customer"] = changed["customer"].withColumns({
        "updated_at": F.when(F.col("id") == 1, F.lit(later)).otherwise(F.col("updated_at")),
        "business_name": F.lit("nuevo nombre")})
    second = run_etl(spark, changed, root, AS_OF)
    assert second.extracted["stg_customer"] == 1 and second.extracted["stg_delivery"] == 0
    store = Store(spark, root)
    names = {r.code: r.business_name for r in store.table("dim_customer").collect()}
    assert names == {"CLI-0001": "Nuevo Nombre", "CLI-0002": "Dos"}
    repeats = store.errors().filter(
        (F.col("run_id") == second.run_id) & (F.col("rule") == "deduplicate"))
    assert [r.source_pk for r in repeats.collect()] == ["CLI-0001"]


def test_failed_load_leaves_the_old_version(spark, loaded):
    root, summary = loaded
    store = Store(spark, root)
    before = store.table("fact_delivery").count()
    run = Run(store, "rebuild", AS_OF)
    groups = run.transform()
    broken = groups["deliveries"].withColumn("customer_code", F.lit("NO-SUCH-CUSTOMER"))
    with pytest.raises(LoadError):
        run.load({**groups, "deliveries": broken})
    assert store.table("fact_delivery").count() == before
    rows = store.log().filter((F.col("run_id") == run.run_id) & (F.col("phase") == "LOAD")).collect()
    assert [(r.table_name, r.status) for r in rows] == [("(fase completa)", "FAILED")]


def test_a_failed_extract_is_logged(spark, tmp_path):
    broken = sources(spark)
    broken["delivery"] = broken["delivery"].withColumn(
        "folio", F.raise_error(F.lit("unreadable")).cast("string"))
    run = Run(Store(spark, str(tmp_path)), "full", AS_OF)
    with pytest.raises(Exception, match="unreadable"):
        run.extract(broken)
    logged = run.store.log().collect()
    assert [r.status for r in sorted(logged, key=lambda r: r.started_at)] == ["SUCCESS"] * 5 + ["FAILED"]
    assert {r.table_name for r in logged if r.status == "FAILED"} == {"stg_delivery"}


def test_dangling_ids_land_and_are_refused(spark, tmp_path):
    lake = sources(spark)
    lake["delivery"] = lake["delivery"].withColumn(
        "customer_id", F.when(F.col("folio") == "ENT-BOUND-15", 999).otherwise(F.col("customer_id")))
    summary = run_etl(spark, lake, str(tmp_path), AS_OF, "rebuild")
    assert summary.extracted["stg_delivery"] == 6 and summary.loaded["fact_delivery"] == 2
    errors = Store(spark, str(tmp_path)).errors().filter("source_pk = 'ENT-BOUND-15'").collect()
    assert [r.rule for r in errors] == ["referential_integrity"]


def test_one_version_has_one_author(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit("one", True, dt.datetime(2026, 1, 1))
    assert store.committed() == ["one"]

    class Late(Store):
        """A run that looked for commits before the first was there."""

        def _commits(self):
            return spark.createDataFrame([], warehouse_schema("commits"))

    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        Late(spark, str(tmp_path)).commit("two", True, dt.datetime(2026, 1, 1))
    assert store.committed() == ["one"]


@pytest.fixture
def session_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("session_zone,zone", [
    ("UTC", "America/Mexico_City"), ("America/Mexico_City", "America/Mexico_City"), ("Asia/Kolkata", "UTC"),
], indirect=["session_zone"])
def test_business_dates_do_not_follow_the_session(spark, tmp_path, session_zone, zone):
    """Zone-free times keep their date and hour, zoned ones take those of the business zone."""
    free = sources(spark)
    wall = F.lit("2026-01-05 22:30:00").cast("timestamp_ntz")
    free["fuel_load"] = free["fuel_load"].withColumn("load_datetime", wall)
    run_etl(spark, free, str(tmp_path / "free"), AS_OF, "rebuild", zone=zone)
    got = Store(spark, str(tmp_path / "free")).table("fact_fuel").select("date_id", "time_id").distinct()
    assert [tuple(r) for r in got.collect()] == [(20260105, 22)]

    zoned = dict(free)
    moment = F.timestamp_seconds(F.lit(1767673800))  # 2026-01-06 04:30 UTC
    zoned["fuel_load"] = free["fuel_load"].withColumn("load_datetime", moment)
    run_etl(spark, zoned, str(tmp_path / "zoned"), AS_OF, "rebuild", zone=zone)
    got = Store(spark, str(tmp_path / "zoned")).table("fact_fuel").select("date_id", "time_id").distinct()
    assert [tuple(r) for r in got.collect()] == [(20260106, 4) if zone == "UTC" else (20260105, 22)]


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        Run(Store(spark, str(tmp_path)), "sometimes", AS_OF)


def test_reports(spark, loaded):
    star = Star.from_store(Store(spark, loaded[0]))
    kpi = reports.kpi_summary(star).first()
    assert (kpi.deliveries, kpi.delayed, kpi.on_time_rate) == (3, 2, 33.3)
    assert kpi.avg_delay_minutes == 23.7 and kpi.avg_delay_when_late == 28.0
    nothing = reports.kpi_summary(star, Period(dt.date(1990, 1, 1), dt.date(1990, 12, 31))).first()
    assert all(not v for v in nothing)
    pareto = reports.delay_causes_pareto(star).collect()
    assert pareto[-1].cumulative == 100.0
    assert [r.total_cost for r in reports.cost_by_vehicle(star).collect()][-1] == 0
    assert reports.hour_heatmap(star).count() == 168
    for slug, spec in reports.REPORTS.items():
        assert reports.report(star, slug).columns == [h for _, h in spec.columns]
    with pytest.raises(ValueError):
        reports.report(star, "nada")
    assert reports.worst_routes(star).count() == 0
    assert features.route_profile(star).first().monthly_shipments == 3.0


def test_periods():
    last = dt.date(2026, 3, 31)
    assert from_request("mes", last_day=last) == Period(dt.date(2026, 3, 1), last)
    assert from_request("todo", last, last, last) == ALL
    assert from_request(None, last, dt.date(2026, 1, 1)) == ALL
    assert from_request("siglo", last, last) == ALL
    assert Period(last, None).label() == "desde 31 de marzo de 2026"
    assert Period(None, last).label() == "hasta 31 de marzo de 2026"
    assert ALL.label() == "todo el histórico"


def test_fixture_catalogue(spark, tmp_path):
    path = tmp_path / "causes.json"
    path.write_text(
        '[{"model": "cause", "pk": 1, "fields": {"code": "TRAFICO", "name": "Tráfico", '
        '"category": "EXTERNA", "is_active": true, "created_at": "2026-08-16T00:00:00Z", '
        '"updated_at": "2026-08-16T00:00:00Z"}}]', encoding="utf-8")
    row = catalogue.read_fixture(spark, str(path)).first()
    assert (row.id, row.code, row.is_active) == (1, "TRAFICO", True)
    assert catalogue.delay_causes(spark).count() == 8


def test_a_broken_full_extract_replaces_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    Run(store, "full", AS_OF).extract(sources(spark))
    broken = {name: rows.limit(1) for name, rows in sources(spark).items()}
    broken["maintenance"] = broken["maintenance"].withColumn(
        "folio", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        Run(store, "full", AS_OF).extract(broken)
    assert store.staging("stg_delivery").count() == 6 and len(store.landed()) == 1
    whole = Run(store, "full", AS_OF)
    assert whole.extract({n: r.limit(1) for n, r in sources(spark).items()})["stg_delivery"] == 1
    assert store.staging("stg_delivery").count() == 1 and store.landed() == [whole.run_id]


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    # Shuffled, sorted, in many tasks; and none at all.
    rows = spark.range(10_001).repartition(13).sort("id")
    kept, n = store.counted_work("r", "some", rows)
    assert n == kept.count() == 10_001
    assert store.counted_work("r", "none", rows.filter("id < 0"))[1] == 0
    assert store.counted_work("r", "local", spark.createDataFrame([], "id long"))[1] == 0


def test_facts_that_meet_an_unwritten_table_are_not_shuffled(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    unwritten = store.fact("fact_delivery", [])
    assert unwritten.schema == warehouse_schema("fact_delivery") and unwritten.count() == 0
    assert store.log().schema == warehouse_schema("etl_log") and store.log().count() == 0
    clean = spark.range(10).select(F.col("id").cast("string").alias("folio"))
    new = insert_only(unwritten, clean, "folio")
    assert new.count() == 10
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString()


def test_the_log_agrees_with_the_files(spark, loaded):
    root, summary = loaded
    store = Store(spark, root)
    log = store.log().filter(F.col("run_id") == summary.run_id).collect()
    assert len(log) == 26
    for r in log:
        if r.phase == "EXTRACT":
            landed = spark.read.parquet(f"{root}/staging/run={summary.run_id}/{r.table_name}")
            assert r.rows_written == landed.count()
        if r.phase == "LOAD" and r.table_name.startswith(("fact", "dim_date", "dim_time")):
            assert r.rows_written == spark.read.parquet(f"{root}/{r.table_name}/run={summary.run_id}").count()

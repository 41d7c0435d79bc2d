import datetime as dt
import time
from pathlib import Path

from pyspark.sql import functions as F

from haulmart.plans import run, transform
from haulmart.plans.run import run_etl
from haulmart.showcase.registry import Context, context
from haulmart.sources import store as st
from haulmart.sources.store import Store
from tests.fleet import sources

AS_OF = dt.date(2026, 1, 10)
SMOKE = "/root/testdata/sf0.001"
FACTS = ("fact_delivery", "fact_fuel", "fact_maintenance")


def shuffled(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in Path(d).rglob("shuffle_*.data")}


def test_a_written_table_leaves_no_shuffle_file(spark, tmp_path):
    before = shuffled(spark)
    store = Store(spark, str(tmp_path))
    rows = spark.range(100_000).withColumn("h", F.xxhash64("id")).repartition(5, "h")
    assert store.counted_work("r", "some", rows)[1] == 100_000
    for _ in range(50):
        if not shuffled(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffled(spark) - before
    assert spark.conf.get(st._CLEANUP, "false") == "false" and not st._open


def test_a_run_in_slices_gives_the_same_tables(spark, tmp_path, monkeypatch):
    def tables(name):
        run_etl(spark, sources(spark), str(tmp_path / name), AS_OF, "rebuild")
        store = Store(spark, str(tmp_path / name))
        facts = [sorted(map(str, store.table(f).collect())) for f in FACTS]
        log = store.log().filter("phase <> 'EXTRACT'").select(
            "phase", "table_name", "rows_read", "rows_written", "rows_rejected")
        refused = store.errors().drop("run_id", "detected_at")
        return facts, sorted(map(str, log.collect())), sorted(map(str, refused.collect()))

    whole = tables("whole")
    # Two slices of every fact table; no universe may be broadcast.
    monkeypatch.setattr(run, "slices", lambda size: 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    modes = []
    monkeypatch.setattr(Store, "write", lambda self, *a, of=Store.write: modes.append(a[3:]) or of(self, *a))
    try:
        assert tables("sliced") == whole and whole[0][0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ("append",) in modes
    left = {p.name for p in (tmp_path / "sliced" / "work").glob("*/*")}
    assert "customers_absent" in left and not {n for n in left if n.endswith(("_judged", "_keys"))}


def test_codes_that_a_universe_lacks_stand_for_it(spark):
    x = context(spark, SMOKE)
    landed, rows = x.stg["stg_delivery"], x.members.__getitem__
    groups = ("customers", "routes", "vehicles", "operators", "delay_causes")
    absent = transform.absent_of_deliveries(landed, {g: rows(g) for g in ("customers", "vehicles")})
    found = [
        transform.deliveries(landed, *map(rows, groups), absent=a) for a in (None, absent)
    ]
    for part in ("rows", "rejected"):
        met, told = (getattr(f, part) for f in found)
        assert met.exceptAll(told).isEmpty() and told.exceptAll(met).isEmpty() and met.count()


def test_a_landing_in_slices_has_every_row_once(spark, monkeypatch):
    x = Context(spark, SMOKE)
    whole = x.stg["stg_delivery"]
    monkeypatch.setattr(st, "SLICE_BYTES", st.bytes_at(spark, f"{SMOKE}/lineitem.parquet") // 3)
    parts = list(x._parts("stg_delivery"))
    assert len(parts) in (3, 4) and all(p.count() for p in parts)
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    assert whole.exceptAll(together).isEmpty() and together.exceptAll(whole).isEmpty()
    assert list(x._parts("stg_fuel_load")) == [x.stg["stg_fuel_load"]]

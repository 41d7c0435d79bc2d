import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.functions import derive as d
from haulmart.showcase.registry import Context
from haulmart.sources import extract
from tests.fleet import sources


def test_facts_look_members_up_in_written_tables(spark, tmp_path):
    own = sources(spark)
    x = Context(spark, str(tmp_path))
    x.stg = {t: extract.land(own, t, "r", dt.datetime(2026, 1, 9)) for t in extract.SOURCES}
    for group in ("customers", "vehicles", "operators", "routes", "delay_causes"):
        assert sorted(x.members[group].collect()) == sorted(x.rows(group).collect())
    read = x.cleaned["deliveries"].verdict.judged.inputFiles()
    assert {f.rsplit("/", 2)[1] for f in read} == {
        "customers", "vehicles", "operators", "routes", "delay_causes"}


def test_a_session_in_the_zone_of_the_business_casts_to_the_same(spark):
    zone, before = "America/Mexico_City", spark.conf.get("spark.sql.session.timeZone")
    walls = [None, "1899-05-01 10:00:00.000001", "2022-04-03 02:30:00", "2022-10-30 01:30:00.5",
             "2026-07-01 23:59:59.999999"]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = spark.createDataFrame([(w,) for w in walls], "w string").select(
            F.col("w").cast("timestamp_ntz").alias("w"))
        at = rows.select(
            d.moment_in(F.col("w"), zone).alias("a"),
            d.moment_in(F.col("w"), zone, d.session_zone(rows)).alias("b"))
        assert at.filter(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()
        back = at.select(
            d.wall_clock(F.col("a"), T.TimestampType(), zone).alias("a"),
            d.wall_clock(F.col("a"), T.TimestampType(), zone, zone).alias("b"))
        assert back.filter(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

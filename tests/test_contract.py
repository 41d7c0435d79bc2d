"""The registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registered
from tools.compare import TABLES, key, same

BASE = "/root/testdata/sf0.001"
SAMPLE = [
    "a03_kpi_summary", "a05_top_routes", "a13_efficiency_by_vehicle", "e06_clean_deliveries",
    "e07_clean_fuel_loads", "e15_quarantine", "w03_odometer_chain", "b01_arrivals_refused",
    "b02_completions_refused", "p04_capture_rules", "m09_confusion_matrix", "m15_silhouette",
]


@pytest.fixture(scope="module")
def duck():
    link = duckdb.connect()
    for table in TABLES:
        link.execute(f"CREATE VIEW {table} AS SELECT * FROM '{BASE}/{table}.parquet'")
    return link


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    frame = registered.queries()[name](spark, BASE)
    cursor = duck.execute(registered.oracle_sql()[name])
    assert frame.columns == [d[0] for d in cursor.description]
    got = sorted((tuple(r) for r in frame.collect()), key=key)
    want = sorted(cursor.fetchall(), key=key)
    assert len(got) == len(want) and all(map(same, got, want))


def test_every_query_has_sql_that_binds(duck):
    for sql in registered.oracle_sql().values():
        duck.execute(f"EXPLAIN {sql}")


def test_entry(spark):
    assert registered.entry(spark).count() > 0

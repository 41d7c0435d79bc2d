import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from haulmart.functions import cleaning as c
from haulmart.functions import derive as d
from haulmart.functions import render as r


def column(spark, values, kind, make):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [x.o for x in frame.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


TEXTS = [
    "  toluca   centro ", "o'neil 3rd", "ÁRBOL ñandú x-y_z", "中a b", "ªb ßx", "a\x1cb\x85c",
    "", None, "RUTA mx-15 d.f.",
]


def test_text_matches_python_title(spark):
    expected = ["" if t is None else re.sub(r"\s+", " ", t.strip()).title() for t in TEXTS]
    assert column(spark, TEXTS, "string", c.normalize_text) == expected


def test_codes_and_plates(spark):
    assert column(spark, ["  cli-0001 ", None, " x "], "string", c.normalize_code) == [
        "CLI-0001", "", "X"]
    assert column(spark, [" abc-12-34 ", None, "a.b ñ1"], "string", c.normalize_plate) == [
        "ABC1234", "", "AB1"]
    assert column(spark, [None, "  ", "x"], "string", c.default_if_blank) == [
        "DESCONOCIDA", "DESCONOCIDA", "x"]
    assert column(spark, [None, " ", "premium"], "string", lambda v: c.code_or(v, "REGULAR")) == [
        "REGULAR", "REGULAR", "PREMIUM"]


def test_outlier_band(spark):
    values = [Decimal(v) if v else None
              for v in ("3.20", "0.40", "14.00", None, "8.75", "11.99", "12.00", "12.01", "1.00")]
    assert column(spark, values, "decimal(6,2)", c.is_efficiency_outlier) == [
        False, True, True, False, False, False, False, True, False]


def test_buckets(spark):
    assert column(spark, [2023, 2022, 2018, 2017, 2030], "int", lambda v: c.age_range(v, 2026)) == [
        "0-3", "4-8", "4-8", "9+", "0-3"]
    km = [Decimal(v) for v in ("79.99", "80.00", "349.99", "350.00")]
    assert column(spark, km, "decimal(8,2)", c.distance_range) == ["CORTA", "MEDIA", "MEDIA", "LARGA"]
    kg = [Decimal(v) for v in ("1999.99", "2000", "14999.99", "15000")]
    assert column(spark, kg, "decimal(10,2)", c.capacity_range) == [
        "LIGERA", "MEDIANA", "MEDIANA", "PESADA"]
    assert column(spark, list(range(24)), "int", d.time_band) == (
        ["MADRUGADA"] * 6 + ["MANANA"] + ["PICO_AM"] * 3 + ["MEDIODIA"] * 7 + ["PICO_PM"] * 3
        + ["NOCHE"] * 4)


def test_seniority_compares_month_and_day(spark):
    days = [dt.date(2026, 1, 1), dt.date(2021, 1, 1), dt.date(2012, 1, 1), dt.date(2030, 1, 1)]
    assert column(spark, days, "date", lambda v: c.seniority_range(v, dt.date(2026, 8, 16))) == [
        "0-2", "3-5", "6+", "0-2"]
    leap = column(spark, [dt.date(2020, 2, 29)], "date",
                  lambda v: c.full_years(v, dt.date(2023, 2, 28)))
    assert leap == [2]


@pytest.mark.parametrize("seconds, expected", [(30, 0), (90, 2), (150, 2), (-90, -2), (89, 1)])
def test_minutes_round_half_even(spark, seconds, expected):
    base = dt.datetime(2026, 1, 5, 8)
    frame = spark.createDataFrame(
        [(base, base + dt.timedelta(seconds=seconds))], "a timestamp_ntz, b timestamp_ntz")
    assert frame.select(d.minutes(F.col("a"), F.col("b"))).first()[0] == expected
    assert expected == int(round(seconds / 60))


def test_rounding_matches_python(spark):
    rng = random.Random(7)
    values = [6.35, 6.25, 0.05, 1.15, 2.675] + [rng.random() * 1000 for _ in range(300)]
    assert column(spark, values, "double", lambda v: r.rounded(v, 1)) == [
        round(v, 1) for v in values]


def test_ratios(spark):
    frame = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("8.00")), (Decimal("1.00"), Decimal("0.00"))],
        "a decimal(14,2), b decimal(14,2)")
    rows = frame.select(d.cost_per_km(F.col("a"), F.col("b")), d.efficiency(F.col("a"), F.col("b")))
    assert [tuple(x) for x in rows.collect()] == [
        (Decimal("0.1250"), Decimal("0.12")), (Decimal("0.0000"), None)]


def test_snapshot_keeps_nulls(spark):
    frame = spark.createDataFrame([("A", None)], "folio string, liters decimal(8,2)")
    assert frame.select(r.snapshot("folio", "liters")).first()[0] == '{"folio":"A","liters":null}'


def test_labels_and_dates(spark):
    assert column(spark, ["TRUCK", "??", None], "string", lambda v: r.label(v, "vehicle_type")) == [
        "Camión", "??", ""]
    assert column(spark, [True, False, None], "boolean", r.yes_no) == ["Sí", "No", ""]
    assert column(spark, [dt.date(2026, 3, 1)], "date", r.spell_date) == ["1 de marzo de 2026"]

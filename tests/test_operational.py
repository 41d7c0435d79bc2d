import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from haulmart.plans import changes, listing, operational
from tests.fleet import DDL, T0, rows, sources

AS_OF = dt.date(2026, 8, 16)
AT = dt.datetime(2026, 8, 16, 12)


def test_fuel_report(spark):
    loads = [(i, f"C{i}", 1, 1, dt.datetime(2026, 1, i), Decimal("200"), Decimal("25"),
              Decimal("5000"), Decimal(100000 + 600 * (i - 1)), True, T0) for i in (1, 2, 3)]
    frame = spark.createDataFrame(loads, DDL["fuel_load"])
    row = operational.efficiency_report(frame, sources(spark)["vehicle"]).first()
    assert (row.loads, row.liters, row.cost, row.km) == (3, 600, 15000, 1200)
    assert str(row.efficiency) == "3.00"


def test_alerts(spark):
    found = [(r.plate, r.severity, r.reason) for r in
             operational.maintenance_alerts(sources(spark)["vehicle"], AS_OF).collect()]
    assert found == [
        ("ABC-1234", "ALTA", "Kilometraje vencido por 1000 km respecto al próximo servicio."),
        ("SIN-1", "ALTA", "Sin registro de servicio previo."),
        ("XYZ-9", "MEDIA", "Faltan 800 km para el próximo servicio.")]


@pytest.mark.parametrize("hot_rows", [1, 30, 10**6])
def test_previous_load(spark, hot_rows):
    rng = random.Random(11)
    data = [(i, f"C{i}", 1 if rng.random() < 0.5 else rng.randrange(2, 5), 1,
             None if i % 17 == 0 else
             dt.datetime(2026, 1, 1) + dt.timedelta(seconds=20 * rng.randrange(60)),
             Decimal("10"), Decimal("1"), Decimal("10"), Decimal(rng.randrange(500)),
             rng.random() < 0.8, T0) for i in range(200)]
    expected = {}
    for r in data:
        earlier = [p for p in data if p[2] == r[2] and p[9] and p[4] and r[4] and p[4] < r[4]]
        expected[r[0]] = max(earlier, key=lambda p: (p[4], p[0]))[8] if earlier else None
    frame = spark.createDataFrame(data, DDL["fuel_load"])
    out = operational.previous_load(frame, hot_rows).collect()
    assert len(out) == len(data)
    assert {r.id: r.previous_odometer_km for r in out} == expected


def arrivals(spark, *events):
    frame = spark.createDataFrame(
        events, "event_id bigint, folio string, arrived_at timestamp, cause_code string")
    s = sources(spark)
    return changes.apply_arrivals(frame, s["delivery"], s["delay_cause"], s["vehicle"], AT, 1)


def test_arrival_rules(spark):
    due = dt.datetime(2026, 1, 5, 9)
    late = due + dt.timedelta(minutes=30)
    cases = [("ENT-BOUND-15", due, None, "ya está cerrada (Entregada)"),
             ("ENT-OPEN", due - dt.timedelta(hours=2), None, "anterior a la salida"),
             ("ENT-OPEN", late, None, "requiere que se indique la causa"),
             ("ENT-OPEN", late, "VIEJA", "desconocida: VIEJA")]
    for n, (folio, at, cause, text) in enumerate(cases):
        refused = arrivals(spark, (n, folio, at, cause)).refused.collect()
        assert len(refused) == 1 and text in refused[0].reason


def test_arrival_closes_once(spark):
    due = dt.datetime(2026, 1, 5, 9)
    out = arrivals(spark, (1, "ENT-OPEN", due + dt.timedelta(minutes=30), "TRAFICO"),
                   (2, "ENT-OPEN", due + dt.timedelta(minutes=40), "TRAFICO"),
                   (3, "ENT-OPEN", due + dt.timedelta(minutes=20), None))
    row = out.rows.filter("folio = 'ENT-OPEN'").first()
    assert (row.status, row.delay_cause_id, row.actual_departure) == (
        "DELAYED", 1, dt.datetime(2026, 1, 5, 8))
    assert out.vehicles.filter("id = 1").first().status == "AVAILABLE"
    reasons = {r.event_id: r.reason for r in out.refused.collect()}
    assert set(reasons) == {2, 3} and "Entregada con retraso" in reasons[2]


def test_completion(spark):
    s = sources(spark)
    events = spark.createDataFrame(
        [(1, "MAN-1", Decimal("0")), (2, "MAN-2", None), (3, "MAN-1", None)],
        "event_id bigint, folio string, next_service_km decimal(12,2)")
    out = changes.apply_completions(events, s["maintenance"], s["vehicle"], AT, hot_rows=1)
    vehicle = out.vehicles.filter("id = 1").first()
    assert (vehicle.current_odometer_km, vehicle.next_service_km, vehicle.status) == (
        51000, 0, "AVAILABLE")
    reasons = {r.event_id: r.reason for r in out.refused.collect()}
    assert "odómetro actual del vehículo (51000.00 km)" in reasons[2]
    assert "ya está completado" in reasons[3]


@pytest.mark.parametrize("hot_rows", [1, 2, 10**6])
def test_every_completion_has_a_verdict(spark, hot_rows):
    s = sources(spark)
    undated = s["maintenance"].withColumn(
        "service_date", F.when(F.col("folio") != "MAN-1", F.col("service_date")))
    events = spark.createDataFrame(
        [(1, "MAN-1", None), (2, "MAN-2", None), (3, "MAN-1", None), (4, "MAN-2", None)],
        "event_id bigint, folio string, next_service_km decimal(12,2)")
    verdicts = changes.completion_verdicts(events, undated, s["vehicle"], hot_rows).collect()
    assert sorted(r.event_id for r in verdicts) == [1, 2, 3, 4]
    # The undated order comes first; the other's reading is below what it left.
    assert {r.event_id for r in verdicts if r.reason is None} == {1}


def test_soft_delete(spark):
    s = sources(spark)
    out = changes.deactivate(s["customer"], spark.createDataFrame([(1,)], "id bigint"), AT)
    assert {r.id: r.is_active for r in out.collect()} == {1: False, 2: False}
    assert out.filter("id = 1").first().updated_at == AT


def test_listing(spark):
    s = sources(spark)
    assert [r.folio for r in listing.page(s, "delivery", "bound").collect()] == [
        "ENT-BOUND-15", "ENT-BOUND-16"]
    assert listing.matching(s, "customer", "%").count() == 0
    assert listing.matching(s, "customer").count() == 1
    assert listing.page(s, "delivery", "UNO", 2).count() == 0
    assert len(rows()["delivery"]) == listing.matching(s, "delivery", "uno").count()

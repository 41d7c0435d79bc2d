"""An incremental run that judges what changed ends like one that judges everything."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from haulmart.plans.run import run_etl
from haulmart.sources.store import Store
from tests.fleet import DDL, rows

AS_OF = dt.date(2026, 8, 16)
LATER = dt.datetime(2027, 1, 1)


def frames(spark, data):
    return {name: spark.createDataFrame(part, DDL[name]) for name, part in data.items()}


def first():
    """The small fleet, more vehicles and trips, and trips and loads of members that come later."""
    data, d = rows(), Decimal
    data["vehicle"] += [(10 + i, f"TRK-{i}", f"E{i}", "m", "x", 2020, "TRUCK", d("9000"), "DIESEL", d(1), d(2), None,
                         "AVAILABLE", True, data["vehicle"][0][-1]) for i in range(6)]
    trip = data["delivery"][0]
    data["delivery"] += [(100 + i, f"ENT-{i % 25}", *trip[2:]) for i in range(30)]
    data["delivery"] += [(200, "ENT-NEWCLI", 77, *trip[3:]), (201, "  ", *trip[2:]), (202, "ENT-NEWROUTE", trip[2], 88, *trip[4:])]
    load = data["fuel_load"][0]
    for v in range(6):
        data["fuel_load"] += [
            (100 + 10 * v + k, f"FL-{v}-{k}", 10 + v, 1, dt.datetime(2026, 1, 2 + 2 * k, 9), d("100"), d("25"), d("2500"),
             d(10_000 + 700 * k), *load[9:]) for k in range(5)
        ]
    # A folio that stands on two vehicles, and one that will only be accepted after a late reading.
    data["fuel_load"] += [(300, "FL-0-2", 14, 1, dt.datetime(2026, 3, 1), d("100"), d("25"), d("2500"), d("20000"), *load[9:]),
                          (301, "FL-FAR", 12, 1, dt.datetime(2026, 4, 1), d("100"), d("25"), d("2500"), d("99000"), *load[9:])]
    data["maintenance"] += [(50, "MAN-LATE", 99, *data["maintenance"][0][3:])]
    return data


def second(data):
    """Changed and new rows of all eight tables, among them a late load in the middle of a chain."""
    d, out = Decimal, {k: list(v) for k, v in data.items()}

    def change(table, id_, **over):
        names = [c.split()[0] for c in DDL[table].split(", ")]
        at = next(i for i, r in enumerate(out[table]) if r[0] == id_)
        out[table][at] = tuple({**dict(zip(names, out[table][at])), **over, "updated_at": LATER}[n] for n in names)

    def add(table, like, **over):
        names = [c.split()[0] for c in DDL[table].split(", ")]
        base = dict(zip(names, next(r for r in out[table] if r[0] == like)))
        out[table].append(tuple({**base, **over, "updated_at": LATER}[n] for n in names))

    change("customer", 1, business_name="otra")
    add("customer", 1, id=77, code="CLI-0077")
    add("vehicle", 10, id=99, plate="NEW-99")
    change("vehicle", 11, brand="volvo")
    change("operator", 1, last_name="paz")
    add("route", 1, id=88, code="RUT-088", distance_km=d("400"))
    change("delay_cause", 2, name="Otra")
    change("delivery", 4, actual_arrival=dt.datetime(2026, 1, 5, 9, 30))
    add("delivery", 1, id=400, folio="ENT-400")
    add("delivery", 1, id=401, folio=" ent-3 ", freight_cost=d("-5"))
    add("delivery", 1, id=402, folio="")
    change("delivery", 200)
    change("delivery", 202, packages_count=4)
    add("fuel_load", 110, id=500, folio="FL-MID", load_datetime=dt.datetime(2026, 1, 5, 9), odometer_km=d("10900"))
    add("fuel_load", 121, id=501, folio="FL-NEAR", load_datetime=dt.datetime(2026, 3, 31), odometer_km=d("98300"))
    change("maintenance", 50)
    change("maintenance", 1, total_cost=d("175"))
    return out


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """Stores and runs of the same two extracts, narrowed and whole."""
    made = {}
    for narrow in (True, False):
        root = str(tmp_path_factory.mktemp("delta") / str(narrow))
        run_etl(spark, frames(spark, first()), root, AS_OF, "rebuild")
        run = run_etl(spark, frames(spark, second(first())), root, AS_OF, since=dt.datetime(2026, 12, 31), narrow=narrow)
        made[narrow] = (Store(spark, root), run)
    return made


def content(rows):
    return sorted(map(str, (tuple(r) for r in rows.collect())))


def test_facts_and_dimensions_are_the_same(both):
    for table in ("fact_delivery", "fact_fuel", "fact_maintenance", "dim_customer", "dim_vehicle", "dim_operator",
                  "dim_route", "dim_delay_cause", "dim_date", "dim_time"):
        assert content(both[True][0].table(table)) == content(both[False][0].table(table)), table
    facts = {r.folio: r for r in both[True][0].table("fact_fuel").collect()}
    # The late reading is refused itself, but makes the load after it plausible.
    assert facts["FL-MID"].km_traveled == 200 and facts["FL-FAR"].km_traveled == 700 and "FL-NEAR" not in facts
    loaded = {r.folio for r in both[True][0].table("fact_delivery").collect()}
    assert {"ENT-400", "ENT-NEWCLI", "ENT-NEWROUTE", "ENT-OPEN"} <= loaded
    assert "MAN-LATE" in {r.folio for r in both[True][0].table("fact_maintenance").collect()}


def test_only_what_changed_is_judged(both):
    def judged(narrow):
        store, run = both[narrow]
        log = store.log().filter((F.col("run_id") == run.run_id) & (F.col("phase") == "TRANSFORM"))
        return {r.table_name: r.rows_read for r in log.collect()}

    few, all_ = judged(True), judged(False)
    # Seven landed rows, with the rows of their folios.
    assert few["stg_delivery"] <= 16 < 40 < all_["stg_delivery"]
    # Two trucks of six, with the folio that one of them shares.
    assert few["stg_fuel_load"] <= 17 < 35 < all_["stg_fuel_load"]
    assert few["stg_maintenance"] <= 4
    assert all(few[t] == all_[t] for t in ("stg_customer", "stg_vehicle", "stg_operator", "stg_route"))


def test_what_is_judged_is_quarantined_alike(both):
    def rejects(narrow):
        store, run = both[narrow]
        return [r.asDict() for r in store.errors().filter(F.col("run_id") == run.run_id).collect()]

    plain = lambda r: (r["source_table"], r["source_pk"], r["rule"], r["description"], r["raw_payload"])
    few, all_ = sorted(map(plain, rejects(True))), sorted(map(plain, rejects(False)))
    assert set(few) <= set(all_) and len(few) < len(all_)
    # Every refusal of a folio that was touched is there.
    touched = {r[1] for r in few if r[0] == "stg_delivery"}
    assert [r for r in all_ if r[0] == "stg_delivery" and r[1] in touched and r[1]] == [
        r for r in few if r[0] == "stg_delivery" and r[1]]
    assert {"ENT-3"} <= touched


def test_a_run_that_was_not_published_is_judged_again(spark, tmp_path, monkeypatch):
    from haulmart.plans import run as module

    root, data = str(tmp_path / "w"), first()
    run_etl(spark, frames(spark, data), root, AS_OF, "rebuild")
    broken = lambda *a: (_ for _ in ()).throw(RuntimeError("no"))
    with monkeypatch.context() as patch:
        patch.setattr(module, "fact_rows", broken)
        with pytest.raises(module.LoadError):
            run_etl(spark, frames(spark, second(data)), root, AS_OF, since=dt.datetime(2026, 12, 31))
    run_etl(spark, frames(spark, data), root, AS_OF, since=dt.datetime(2028, 1, 1))
    assert "ENT-400" in {r.folio for r in Store(spark, root).table("fact_delivery").collect()}

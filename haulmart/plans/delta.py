"""Which landed facts an incremental run has to judge again.

The verdict on a folio follows from the landed rows of that folio, from the
members that its rows refer to and, for fuel, from the readings of the vehicle
before it. Verdicts of a published run stand as long as none of these changed.
So a run judges the folios that have a row landed since the last published run,
those with a load on a vehicle that has such a load, and those that refer to a
member which is known only now. Members never become unknown, and a fact once
loaded is not loaded again, so the other folios would come out as before.

Landed history is read for its keys alone; rows of other folios are left out of
every shuffle behind a semi-join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions import cleaning as c

# Writes rows under a name and reads them back.
Keep = Callable[[DataFrame, str], DataFrame]

# For each group of facts: landed column, its normal form, group and natural key of the member.
_VEHICLE = ("vehicle_plate", c.normalize_plate, "vehicles", "plate")
_OPERATOR = ("operator_number", c.normalize_code, "operators", "employee_number")
MEMBERS = {
    "deliveries": (
        ("customer_code", c.normalize_code, "customers", "code"),
        ("route_code", c.normalize_code, "routes", "code"),
        _VEHICLE, _OPERATOR,
    ),
    "fuel_loads": (_VEHICLE, _OPERATOR),
    "maintenances": (_VEHICLE,),
}
AGAIN = "_again"


def is_fresh(published: Sequence[str]) -> Column:
    """True for rows that no published run has judged."""
    return ~F.coalesce(F.col("run_id").isin(*published), F.lit(False))


def new_members(cleaned: DataFrame, known: DataFrame, natural: str) -> DataFrame:
    """Natural keys that are clean now and were not in the published dimension."""
    return cleaned.select(natural).join(known.select(natural), natural, "left_anti")


def touched_folios(
    landed: DataFrame,
    published: Sequence[str],
    members: Mapping[str, DataFrame],
    group: str,
) -> DataFrame:
    """(folio) to judge again; ``members`` has the new ones of each group that has any."""
    keyed = landed.withColumns({"_folio": c.normalize_code(F.col("folio")), "_fresh": is_fresh(published)})
    parts = [keyed.filter("_fresh").select("_folio")]
    if group == "fuel_loads":
        plate = c.normalize_plate(F.col("vehicle_plate"))
        moved = keyed.filter("_fresh").select(plate.alias("_moved")).distinct()
        parts.append(keyed.join(moved, plate == F.col("_moved"), "left_semi").select("_folio"))
    for column, normal, of, natural in MEMBERS[group]:
        if of in members:
            new = members[of].select(F.col(natural).alias("_member"))
            parts.append(
                keyed.join(new, normal(F.col(column)) == F.col("_member"), "left_semi").select("_folio")
            )
    folios = parts[0]
    for more in parts[1:]:
        folios = folios.unionByName(more)
    return folios.filter("_folio <> ''").distinct()


def marked(landed: DataFrame, folios: DataFrame, published: Sequence[str]) -> DataFrame:
    """The rows to judge again under ``AGAIN``, and fuel's rows of their vehicles beside them.

    A row without a folio is judged once, by the run that lands it.
    """
    key = c.normalize_code(F.col("folio"))
    flagged = folios.select(F.col("_folio"), F.lit(True).alias("_listed"))
    again = F.coalesce(F.col("_listed"), F.lit(False)) | ((key == "") & is_fresh(published))
    rows = landed.join(flagged, key == F.col("_folio"), "left").withColumn(AGAIN, again)
    return rows.drop("_folio", "_listed")


def narrowed(
    staging: Mapping[str, DataFrame],
    published: Sequence[str],
    members: Mapping[str, DataFrame],
    tables: Mapping[str, str],
    keep: Keep,
) -> dict[str, DataFrame]:
    """Landing tables of facts cut down to what a run has to judge.

    Fuel keeps every row of the vehicles concerned, as the chain of readings
    needs them; which of them to judge is told by ``AGAIN``. The list of folios
    of each group is written, as several joins read it.
    """
    out = dict(staging)
    for group in MEMBERS:
        landed = staging[tables[group]]
        folios = keep(touched_folios(landed, published, members, group), f"{group}_touched")
        rows = marked(landed, folios, published)
        if group == "fuel_loads":
            rows = keep(_with_vehicles(rows), f"{group}_narrowed")
        else:
            rows = rows.filter(AGAIN).drop(AGAIN)
        out[tables[group]] = rows
    return out


def _with_vehicles(rows: DataFrame) -> DataFrame:
    """Rows to judge and all others of the same vehicles."""
    plate = c.normalize_plate(F.col("vehicle_plate"))
    concerned = rows.filter(AGAIN).select(plate.alias("_concerned")).distinct()
    return rows.join(concerned, plate == F.col("_concerned"), "left_semi")

"""Listings of the source tables: search, order, page."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Listing:
    """Search fields, order ("-" is descending) and page size of one table.

    A field "target.column" is looked up through ``<target>_id``.
    """

    search: tuple[str, ...]
    order: str
    page: int = 20


# Fixed values
LISTINGS = {
    "customer": Listing(("code", "business_name", "tax_id", "city"), "code"),
    "vehicle": Listing(("economic_number", "plate", "brand", "model"), "economic_number"),
    "operator": Listing(
        ("employee_number", "first_name", "last_name", "license_number"), "employee_number"
    ),
    "route": Listing(("code", "name", "origin_city", "destination_city", "zone"), "code"),
    "delivery": Listing(
        ("folio", "customer.business_name", "route.code", "vehicle.plate"),
        "-scheduled_departure", 25,
    ),
    "fuel_load": Listing(
        ("folio", "vehicle.plate", "vehicle.economic_number", "station_name"),
        "-load_datetime", 25,
    ),
    "maintenance": Listing(
        ("folio", "vehicle.plate", "vehicle.economic_number", "workshop"), "-service_date", 25
    ),
}


def contains(column: Column, term: str) -> Column:
    """Case-insensitive, with ``%`` and ``_`` standing for themselves."""
    return F.upper(column).contains(term.upper())


def ordered(name: str) -> Column:
    if name.startswith("-"):
        return F.col(name[1:]).desc_nulls_first()
    return F.col(name).asc_nulls_last()


def matching(sources: Mapping[str, DataFrame], table: str, term: str = "") -> DataFrame:
    """Active rows where any search field contains the term."""
    spec = LISTINGS[table]
    rows = sources[table].filter("is_active")
    term = term.strip()
    if not term:
        return rows
    columns = rows.columns
    found = F.lit(False)
    wanted: dict[str, list[str]] = {}
    for name in spec.search:
        target, _, column = name.rpartition(".")
        if target:
            wanted.setdefault(target, []).append(column)
        else:
            found = found | F.coalesce(contains(F.col(column), term), F.lit(False))
    for target, names in wanted.items():
        # The match is decided on the small side; only a flag is joined.
        hit = F.lit(False)
        for column in names:
            hit = hit | F.coalesce(contains(F.col(column), term), F.lit(False))
        flagged = sources[target].select(
            F.col("id").alias(f"{target}_id"), hit.alias(f"_hit_{target}")
        )
        rows = rows.join(flagged, f"{target}_id", "left")
        found = found | F.coalesce(F.col(f"_hit_{target}"), F.lit(False))
    return rows.filter(found).select(*columns)


def page(
    sources: Mapping[str, DataFrame], table: str, term: str = "", number: int = 1
) -> DataFrame:
    """One page of a listing; ties are ordered by id."""
    spec = LISTINGS[table]
    return (
        matching(sources, table, term)
        .orderBy(ordered(spec.order), "id")
        .offset((number - 1) * spec.page)
        .limit(spec.page)
    )

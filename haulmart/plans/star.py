"""The star schema as a set of DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.plans.load import DIMENSIONS, FACTS
from haulmart.sources.store import Store


@dataclass(frozen=True)
class Star:
    """Facts point at dimensions through ``<member>_id`` = ``<member>_key``."""

    tables: Mapping[str, DataFrame]

    def __getitem__(self, table: str) -> DataFrame:
        return self.tables[table]

    @classmethod
    def from_store(cls, store: Store) -> Star:
        runs = store.committed()
        names = [*[d.table for d in DIMENSIONS], "dim_date", "dim_time"]
        tables = {n: store.dimension(n, runs) for n in names}
        tables.update({n: store.fact(n, runs) for n in FACTS})
        return cls(tables)

    @classmethod
    def from_clean(cls, groups: Mapping[str, DataFrame]) -> Star:
        """A star over clean rows that have not been loaded."""
        tables = {d.table: star_table(d.table, groups[d.group]) for d in DIMENSIONS}
        tables.update({f: star_table(f, groups[group]) for f, (group, _) in FACTS.items()})
        return cls(tables)


def star_table(table: str, clean: DataFrame) -> DataFrame:
    """Clean rows as a dimension or fact, linked by natural instead of surrogate keys."""
    if table in FACTS:
        renames = {column: target for column, _, _, _, target in FACTS[table][1]}
        return clean.withColumnsRenamed(renames | {"date_key": "date_id", "time_key": "time_id"})
    spec = next(d for d in DIMENSIONS if d.table == table)
    return clean.select(
        F.col(spec.natural).alias(spec.surrogate), spec.natural, *spec.attributes
    )


def member(fact_or_totals: DataFrame, star: Star, table: str, id_column: str,
           *attributes: str, how: str = "inner") -> DataFrame:
    """Attach attributes of a dimension to rows that carry its id."""
    spec = next(d for d in DIMENSIONS if d.table == table)
    dim = star[table].select(F.col(spec.surrogate).alias(id_column), *attributes)
    return fact_or_totals.join(dim, id_column, how)

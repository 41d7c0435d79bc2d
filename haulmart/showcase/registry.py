"""Registered queries: what the library computes, and the same in plain SQL."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.plans import transform
from haulmart.plans.load import DIMENSIONS
from haulmart.plans.run import Run, Summary, run_etl
from haulmart.plans.star import Star
from haulmart.showcase import lens, oracle
from haulmart.sources.extract import SOURCES, zoned
from haulmart.sources.schemas import staging_schema
from haulmart.sources.store import Store, application_folder, bytes_at, put, slices

AS_OF = dt.date(2026, 8, 16)

# Result columns are compared as text, whole numbers or doubles.
_SPARK_TYPES = {"s": "string", "i": "bigint", "d": "double"}
_SQL_TYPES = {"s": "VARCHAR", "i": "BIGINT", "d": "DOUBLE"}

_warehouses: dict[tuple[str, str, str], tuple[Store, Summary]] = {}


_SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id"}


class Lazy(Mapping):
    """A mapping whose values are built on first use."""

    def __init__(self, build: Callable[[str], DataFrame], names: Iterable[str]) -> None:
        self._build, self._names, self._built = build, tuple(names), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Context:
    """Lens tables and what follows from them, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.lens = Lazy(self._lens, lens.LENS)
        self.tables = Lazy(self._table, lens.TABLES)
        self.src = Lazy(
            lambda n: self.lens[f"src_{n}"],
            [n.removeprefix("src_") for n in lens.LENS if n.startswith("src_")],
        )
        self.stg = Lazy(self.lens.__getitem__, [n for n in lens.LENS if n.startswith("stg_")])
        self.cleaned = Lazy(self._clean, transform.SOURCE_OF)
        self.members = Lazy(self._members, [d.group for d in DIMENSIONS])

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def _table(self, name: str) -> DataFrame:
        """A supplied table, spread over the cores where its file is one block.

        A file with a single row group reads as one task, however many cores
        wait. Input that already fills the cores is left as it is.
        """
        rows = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        if name in _SPREAD_BY and rows.rdd.getNumPartitions() < cores:
            rows = rows.repartition(cores, _SPREAD_BY[name])
        return rows

    def view(self, name: str) -> DataFrame:
        return self.lens[name]

    def _lens(self, name: str) -> DataFrame:
        return lens.view(self.spark, self.tables, name)

    def _clean(self, group: str) -> transform.Cleaned:
        landed, rows = self.stg[transform.SOURCE_OF[group]], self.members.__getitem__
        match group:
            case "customers":
                return transform.customers(landed)
            case "vehicles":
                return transform.vehicles(landed, AS_OF)
            case "operators":
                return transform.operators(landed, AS_OF)
            case "routes":
                return transform.routes(landed)
            case "delay_causes":
                return transform.delay_causes(landed)
            case "deliveries":
                return transform.deliveries(
                    landed, rows("customers"), rows("routes"), rows("vehicles"),
                    rows("operators"), rows("delay_causes"),
                )
            case "fuel_loads":
                return transform.fuel_loads(landed, rows("vehicles"), rows("operators"))
            case _:
                return transform.maintenances(landed, rows("vehicles"))

    @property
    def star(self) -> Star:
        """The stored star over the landing tables, which reports read."""
        return Star.from_store(self.landed_warehouse())

    def landed_warehouse(self) -> Store:
        """A warehouse transformed and loaded from the landing tables, once per session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, "landed")
        if key not in _warehouses:
            store = Store(self.spark, self.scratch("landed-" + re.sub(r"\W+", "-", self.sf_dir)))
            run = Run(store, "rebuild", AS_OF)
            for table in SOURCES:
                mode = "overwrite"
                for part in self._parts(table):
                    rows = zoned(part.withColumn("run_id", F.lit(run.run_id)), run.zone)
                    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in staging_schema(table)]
                    store.land(table, run.run_id, rows.select(*typed), mode)
                    mode = "append"
            store.list_landing(run.run_id, True, dt.datetime.now(dt.timezone.utc))
            groups = run.transform()
            loaded = run.load(groups)
            # The facts hold what the clean tables did, and no query reads these.
            store.discard_work(run.run_id, *groups)
            _warehouses[key] = (store, Summary(run.run_id, {}, loaded, run.rejected))
        return _warehouses[key][0]

    def _parts(self, table: str) -> Iterator[DataFrame]:
        """A landing table, in slices by order where it joins very many lines."""
        count = 1
        if table == "stg_delivery":
            count = slices(bytes_at(self.spark, f"{self.sf_dir}/lineitem.parquet"))
        if count == 1:
            yield self.stg[table]
            return
        lines = self.tables["lineitem"]
        for n in range(count):
            some = lines.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(count)) == n)
            yield lens.view(self.spark, {**self.tables, "lineitem": some}, table)

    def _members(self, group: str) -> DataFrame:
        """Clean rows of a dimension as facts look them up, written once as in a run.

        Spark then knows how few they are before it shuffles any fact to meet them.
        """
        path = self.scratch(f"members-{uuid.uuid4().hex}/{group}")
        rows = self.rows(group)
        put(rows, path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def rows(self, group: str) -> DataFrame:
        return self.cleaned[group].rows

    def scratch(self, name: str) -> str:
        return f"{application_folder(self.spark)}/{name}"

    def warehouse(self, name: str = "warehouse") -> tuple[Store, Summary]:
        """A warehouse loaded from the operational tables, once per session and name.

        A query that goes on to change its warehouse names one of its own.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _warehouses:
            root = self.scratch(f"{name}-" + re.sub(r"\W+", "-", self.sf_dir))
            summary = run_etl(self.spark, self.src, root, AS_OF, "rebuild")
            _warehouses[key] = (Store(self.spark, root), summary)
        return _warehouses[key]


_contexts: dict[tuple[str, str], Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    """The lens of one session and folder; what it holds of data lies in files."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _contexts:
        _contexts[key] = Context(spark, sf_dir)
    return _contexts[key]


@dataclass(frozen=True)
class Query:
    name: str
    columns: tuple[tuple[str, str], ...]
    build: Callable[[Context], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.build(context(spark, sf_dir))
        return out.select(
            *[F.col(f"`{c}`").cast(_SPARK_TYPES[k]).alias(c) for c, k in self.columns]
        )

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shown = ", ".join(f'CAST("{c}" AS {_SQL_TYPES[k]}) AS "{c}"' for c, k in self.columns)
        return oracle.assemble(f"SELECT {shown} FROM ({self.sql}) AS result")


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    """Register a builder under ``name``; ``columns`` is "name kind, …"."""

    def register(build: Callable[[Context], DataFrame]):
        pairs = tuple(tuple(c.split()) for c in columns.split(","))
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, pairs, build, sql)
        return build

    return register

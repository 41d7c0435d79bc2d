"""Warehouse directory: versions become visible only when a run commits.

Every run writes under its own ``run=<id>`` folder. A reader looks at the
commit table first and then only at folders of committed runs, so a failed or
half-finished load is never seen. Dimensions are whole snapshots per run; facts
only ever gain rows, so a version is the list of runs since the last rebuild.
Landing tables have a list of their own: a run's extract counts once all of its
tables lie there, and a whole one replaces those before it by being listed.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.sources.schemas import DIMENSION_DDL, FACT_DDL, staging_schema, warehouse_schema


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    Only a session on one machine may do without the setting. Elsewhere each
    executor would write to a disk of its own, so a missing one is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder under {context.master}")
    return f"file://{context._jvm.System.getProperty('java.io.tmpdir')}/haulmart"


def application_folder(spark: SparkSession) -> str:
    """A folder of this application below the scratch root, deleted when it ends."""
    context = spark.sparkContext
    folder = f"{scratch_root(spark)}/{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def bytes_at(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path; none if nothing is there."""
    context = spark.sparkContext
    sought = context._jvm.org.apache.hadoop.fs.Path(path)
    system = sought.getFileSystem(context._jsc.hadoopConfiguration())
    return system.getContentSummary(sought).getLength() if system.exists(sought) else 0


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_tidying = threading.Lock()
# How many blocks of each session are open, and the setting before the first of them.
_open: dict[int, tuple[int, str | None]] = {}


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that made them, not with the driver's next collection."""
    session = id(spark)
    with _tidying:
        depth, before = _open.get(session, (0, None))
        if not depth:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _open[session] = depth + 1, before
    try:
        yield
    finally:
        with _tidying:
            depth, before = _open.pop(session)
            if depth > 1:
                _open[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def put(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows for this job's own use: closely packed, and no shuffle file left behind."""
    with tidy(rows.sparkSession):
        rows.write.mode(mode).option("compression", "zstd").parquet(path)


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the folder of the application, where they take less room than a cache."""
    path = f"{application_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    put(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


# Tasks that the rows of one month are dealt to.
MONTH_FILES = 64
# Bytes of a table that are shuffled by one job; a larger one is worked on slice by slice,
# so that what a job shuffles does not grow with the table.
SLICE_BYTES = 2 << 30


def slices(size: int) -> int:
    """Jobs that a table of so many bytes is dealt to."""
    return max(1, -(-size // SLICE_BYTES))


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _read(self, table: str, *paths: str) -> DataFrame:
        schema = staging_schema(table) if table.startswith("stg_") else warehouse_schema(table)
        # Nothing written yet is an empty table; one run's folder missing among others is an error.
        if not paths or (len(paths) == 1 and not self._exists(paths[0])):
            return self._nothing(schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _nothing(self, schema: T.StructType) -> DataFrame:
        """A table without rows, known as such while a plan is made.

        A frame made from a list in Python has no known size: facts that meet it
        would all be shuffled and sorted to find nothing there.
        """
        none = self.spark.range(1).filter(F.lit(False))
        return none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _exists(self, path: str) -> bool:
        """Whether a path, or anything that fits a pattern, is there."""
        context = self.spark.sparkContext
        sought = context._jvm.org.apache.hadoop.fs.Path(path)
        return bool(sought.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(sought))

    def _put(self, rows: DataFrame, path: str, mode: str) -> int:
        """Write rows and return how many were written.

        They are counted in the footers of the files; no row is read again. An
        observation would count them too, but no fitted classifier can be sent
        to a task of a session that has observed anything: its summary holds
        the session, whose observations cannot be serialised.
        """
        before = self._rows_at(path) if mode == "append" else 0
        put(rows, path, mode)
        return self._rows_at(path) - before

    def _rows_at(self, path: str) -> int:
        # Without columns only footers are read.
        if not self._exists(path):
            return 0
        with tidy(self.spark):
            return self.spark.read.schema(T.StructType()).parquet(path).count()

    def _commits(self) -> DataFrame:
        return self._read("commits", f"{self.root}/commits/*")

    def _landings(self) -> DataFrame:
        return self._read("landings", f"{self.root}/landings/*")

    @staticmethod
    def _since_last(entries: DataFrame, anew: str) -> list[str]:
        """Runs from the last one that begins ``anew``, oldest first; one small row per run."""
        runs = entries.orderBy("seq").collect()
        start = max((i for i, r in enumerate(runs) if r[anew]), default=0)
        return [r.run_id for r in runs[start:]]

    def _enter(self, table: str, entries: DataFrame, run_id: str, anew: bool, at: dt.datetime) -> None:
        """Add a run to a list: a folder of its own number, complete or absent.

        Two runs that take the same number write the same folder, and the
        second is refused, so an entry has one author.
        """
        last = entries.agg(F.max("seq")).first()[0]
        seq = (last or 0) + 1
        self.spark.createDataFrame(
            [(seq, run_id, anew, at)], warehouse_schema(table)
        ).coalesce(1).write.mode("error").parquet(f"{self.root}/{table}/{seq:012d}")

    def committed(self) -> list[str]:
        """Runs of the visible version, oldest first."""
        return self._since_last(self._commits(), "rebuilt")

    def commit(self, run_id: str, rebuilt: bool, at: dt.datetime) -> None:
        """Publish a run."""
        self._enter("commits", self._commits(), run_id, rebuilt, at)

    def land(self, table: str, run_id: str, rows: DataFrame, mode: str = "overwrite") -> int:
        """Write one landing table, or a slice of it, of an extract that is not listed yet."""
        ordered = rows.select(*staging_schema(table).fieldNames())
        return self._put(ordered, f"{self.root}/staging/run={run_id}/{table}", mode)

    def list_landing(self, run_id: str, whole: bool, at: dt.datetime) -> None:
        """Make an extract visible, in place of all earlier ones if it is whole."""
        self._enter("landings", self._landings(), run_id, whole, at)

    def landed(self) -> list[str]:
        """Extracts that the landing tables consist of, oldest first."""
        return self._since_last(self._landings(), "whole")

    def staging(self, table: str) -> DataFrame:
        return self._read(table, *[f"{self.root}/staging/run={r}/{table}" for r in self.landed()])

    def landed_bytes(self, table: str) -> int:
        return sum(bytes_at(self.spark, f"{self.root}/staging/run={r}/{table}") for r in self.landed())

    def dimension(self, table: str, runs: Sequence[str]) -> DataFrame:
        return self._read(table, *[f"{self.root}/{table}/run={r}" for r in runs[-1:]])

    def fact(self, table: str, runs: Sequence[str]) -> DataFrame:
        return self._read(table, *[f"{self.root}/{table}/run={r}" for r in runs])

    def table(self, table: str) -> DataFrame:
        """A dimension or fact of the visible version."""
        runs = self.committed()
        return self.dimension(table, runs) if table in DIMENSION_DDL else self.fact(table, runs)

    def write(self, table: str, run_id: str, rows: DataFrame, mode: str = "overwrite") -> int:
        """Write one table, or a slice of it, of an unpublished version, typed as declared; its rows."""
        target = warehouse_schema(table)
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
        if table in FACT_DDL:
            # A month lies in a bounded number of files, sorted by date, which lets
            # date filters skip row groups; a hot month is still many tasks' work.
            month = F.floor(F.col("date_id") / 100)
            typed = typed.repartition(
                month, F.pmod(F.hash("folio"), F.lit(MONTH_FILES))
            ).sortWithinPartitions("date_id")
        return self._put(typed, f"{self.root}/{table}/run={run_id}", mode)

    def work(self, run_id: str, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate result and read it back, cutting its lineage."""
        return self.counted_work(run_id, name, rows)[0]

    def counted_work(
        self, run_id: str, name: str, rows: DataFrame, mode: str = "overwrite"
    ) -> tuple[DataFrame, int]:
        """The same with the number of rows that were written."""
        path = f"{self.root}/work/run={run_id}/{name}"
        n = self._put(rows, path, mode)
        return self.spark.read.schema(rows.schema).parquet(path), n

    def work_bytes(self, run_id: str, name: str) -> int:
        return bytes_at(self.spark, f"{self.root}/work/run={run_id}/{name}")

    def discard_work(self, run_id: str, *names: str) -> None:
        """Delete intermediate results that nothing reads any more."""
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/work/run={run_id}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def append(self, table: str, rows: DataFrame) -> int:
        target = warehouse_schema(table)
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
        return self._put(typed, f"{self.root}/{table}", "append")

    def quarantine(self, run_id: str, table: str, rows: DataFrame, mode: str = "overwrite") -> int:
        """Keep what a run refused of one table, or of a slice, in a folder that no other job writes to."""
        target = warehouse_schema("etl_error")
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
        return self._put(typed, f"{self.root}/etl_error/{run_id}-{table}", mode)

    def log(self) -> DataFrame:
        return self._read("etl_log", f"{self.root}/etl_log")

    def errors(self) -> DataFrame:
        return self._read("etl_error", f"{self.root}/etl_error/*")

"""One run of extract, transform and load, with its log and quarantine."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.operators.hotkeys import HOT_ROWS
from haulmart.operators.keys import upsert
from haulmart.plans import calendar, delta, transform
from haulmart.plans.load import DIMENSIONS, FACTS, LoadError, fact_rows
from haulmart.sources.extract import SOURCES, extract_watermark, land
from haulmart.sources.schemas import warehouse_schema
from haulmart.sources.store import Store, slices

MODES = ("incremental", "full", "rebuild")
# Tables of one phase that are worked on at once: most of their jobs are too
# small to fill a cluster, and Spark runs the jobs of several threads side by side.
AT_ONCE = 4


def _now() -> dt.datetime:
    """An instant with its zone, so that no driver's clock setting enters."""
    return dt.datetime.now(dt.timezone.utc)


@dataclass
class Tally:
    read: int = 0
    written: int = 0
    rejected: int = 0


@dataclass
class Run:
    store: Store
    mode: str
    as_of: dt.date
    since: dt.datetime | None = None
    hot_rows: int = HOT_ROWS
    zone: str = "UTC"
    # Judge only what changed since the published version, where there is one.
    narrow: bool = True
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    pending: list[tuple] = field(default_factory=list)
    # Refused rows of each landing table.
    refused: dict[str, int] = field(default_factory=dict)
    # Clean tables as written by this run, with their numbers of rows.
    sizes: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode!r}; expected one of {MODES}")

    @property
    def full(self) -> bool:
        return self.mode != "incremental"

    @contextmanager
    def phase(self, phase: str, table: str):
        """Time and count one table of one phase; the row is logged on exit."""
        tally, started = Tally(), _now()
        status, message = "SUCCESS", ""
        try:
            yield tally
        except Exception as error:
            status, message = "FAILED", f"{type(error).__name__}: {error}"
            raise
        finally:
            self.pending.append(
                (self.run_id, phase, table, started, _now(), tally.read, tally.written,
                 tally.rejected, status, message)
            )

    def flush(self) -> None:
        """Append the log rows gathered so far, a few per phase."""
        rows, self.pending = self.pending, []
        if rows:
            frame = self.store.spark.createDataFrame(rows, warehouse_schema("etl_log"))
            self.store.append("etl_log", frame.coalesce(1))

    def watermark(self) -> dt.datetime | None:
        if self.full:
            return None
        return self.since or extract_watermark(self.store.log()).first()["watermark"]

    @property
    def rejected(self) -> int:
        return sum(self.refused.values())

    def _each(self, work: Callable, names: Iterable) -> dict:
        """``work`` of every name, several at once; the first error is raised when all have ended."""
        names = list(names)
        target = inheritable_thread_target(self.store.spark)(work)
        with ThreadPoolExecutor(AT_ONCE) as pool:
            begun = [pool.submit(target, name) for name in names]
        return {name: done.result() for name, done in zip(names, begun)}

    # -- phases -------------------------------------------------------------

    def extract(self, sources: Mapping[str, DataFrame]) -> dict[str, int]:
        counts, resume, at = {}, self.watermark(), _now()
        try:
            for table in SOURCES:
                with self.phase("EXTRACT", table) as tally:
                    rows = land(sources, table, self.run_id, at, resume, self.zone)
                    tally.read = tally.written = self.store.land(table, self.run_id, rows)
                counts[table] = tally.written
            # Not before all tables lie there, so a failed extract replaces nothing.
            self.store.list_landing(self.run_id, self.full, _now())
        finally:
            self.flush()
        return counts

    def _settle(
        self, group: str, cleaned: transform.Cleaned, table: str, sliced: bool = False
    ) -> DataFrame:
        """Write one clean table and its rejects, counted as they are written.

        A large table may be ``sliced`` by natural key. Judged rows go once all is written.
        """
        with self.phase("TRANSFORM", table) as tally:
            counts: dict[str, int] = {}

            def keep(rows: DataFrame, name: str) -> DataFrame:
                kept, counts[name] = self.store.counted_work(self.run_id, f"{group}_{name}", rows)
                return kept

            cleaned, at, mode = cleaned.settled(keep), _now(), "overwrite"
            tally.read = counts["judged"]
            for part in cleaned.slices(slices(self.store.landed_bytes(table)) if sliced else 1):
                rows, n = self.store.counted_work(self.run_id, group, part.rows, mode)
                tally.written += n
                rejected = part.rejected.select(
                    F.lit(self.run_id).alias("run_id"),
                    F.lit(table).alias("source_table"),
                    "source_pk", "rule", "description", "raw_payload",
                    F.lit(at).alias("detected_at"),
                )
                tally.rejected += self.store.quarantine(self.run_id, table, rejected, mode)
                mode = "append"
            self.sizes[group], self.refused[table] = (rows, tally.written), tally.rejected
            self.store.discard_work(self.run_id, *[f"{group}_{name}" for name in counts])
        return rows

    def _settle_all(
        self, cleaned: Mapping[str, transform.Cleaned], sliced: bool = False
    ) -> dict[str, DataFrame]:
        return self._each(
            lambda group: self._settle(group, cleaned[group], transform.SOURCE_OF[group], sliced),
            cleaned,
        )

    def _absent(self, staging: DataFrame, groups: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Codes that deliveries name and a universe too large to broadcast lacks, written."""
        conf = self.store.spark._jsparkSession.sessionState().conf()
        large = {
            g: groups[g] for g in ("customers", "vehicles")
            if self.store.work_bytes(self.run_id, g) > conf.autoBroadcastJoinThreshold()
        }
        found = transform.absent_of_deliveries(staging, large)
        return self._each(lambda g: self.store.work(self.run_id, f"{g}_absent", found[g]), found)

    def _size(self, group: str, rows: DataFrame) -> int:
        """Rows of a clean table, counted again only if another one stands in for it."""
        written, n = self.sizes.get(group, (None, 0))
        return n if rows is written else rows.count()

    def transform(self) -> dict[str, DataFrame]:
        staging = {table: self.store.staging(table) for table in SOURCES}
        groups: dict[str, DataFrame] = {}
        try:
            groups |= self._settle_all(transform.clean_dimensions(staging, self.as_of))
            only = None
            if self.narrow and not self.full and (published := self.store.committed()):
                staging, only = self._narrowed(staging, groups, published), F.col(delta.AGAIN)
            groups |= self._settle_all(transform.clean_facts(
                staging, groups, self.hot_rows, zone=self.zone, fuel_only=only,
                absent=self._absent(staging["stg_delivery"], groups),
            ), sliced=True)
        finally:
            # What failed is logged too; the run ends with the error itself.
            self.flush()
        return groups

    def _narrowed(
        self, staging: Mapping[str, DataFrame], groups: Mapping[str, DataFrame], published: list[str]
    ) -> dict[str, DataFrame]:
        """Landed facts that a published run has not judged, or that now meet a new member."""
        def new_of(spec):
            known = self.store.dimension(spec.table, published)
            new = delta.new_members(groups[spec.group], known, spec.natural)
            return self.store.counted_work(self.run_id, f"{spec.group}_new", new)

        found = self._each(new_of, DIMENSIONS)
        members = {spec.group: new for spec, (new, n) in found.items() if n}
        return delta.narrowed(
            staging, published, members, {g: transform.SOURCE_OF[g] for g in delta.MEMBERS},
            lambda rows, name: self.store.work(self.run_id, name, rows),
        )

    def load(self, groups: Mapping[str, DataFrame]) -> dict[str, int]:
        """Publish a new version, or leave the old one and log one failure."""
        started, earlier = _now(), list(self.pending)
        try:
            counts = self._load(groups)
        except Exception as error:
            self.pending = [
                *earlier,
                (self.run_id, "LOAD", "(fase completa)", started, _now(), 0, 0, 0, "FAILED",
                 f"{type(error).__name__}: {str(error)[:2000]}"),
            ]
            self.flush()
            raise LoadError(f"load of run {self.run_id} failed") from error
        self.flush()
        return counts

    def _load(self, groups: Mapping[str, DataFrame]) -> dict[str, int]:
        store, spark = self.store, self.store.spark
        rebuilt = self.mode == "rebuild"
        visible = store.committed()
        base = [] if rebuilt else visible
        def load_dimension(spec) -> int:
            with self.phase("LOAD", spec.table) as tally:
                existing = store.dimension(spec.table, base)
                incoming = groups[spec.group].select(spec.natural, *spec.attributes)
                last = (existing.agg(F.max(spec.surrogate)).first()[0] or 0) if base else 0
                tally.read = tally.written = self._size(spec.group, groups[spec.group])
                return store.write(
                    spec.table,
                    self.run_id,
                    upsert(existing, incoming, spec.surrogate, spec.natural,
                           spec.attributes, last),
                )

        members = self._each(load_dimension, DIMENSIONS)
        counts = {spec.table: n for spec, n in members.items()}
        dims = {spec.table: store.dimension(spec.table, [self.run_id]) for spec in DIMENSIONS}

        # Date and time survive a rebuild.
        dated = [groups[g] for g, _ in FACTS.values()]
        if not self.full:
            # The facts of earlier runs are not among those of this one.
            dated.append(store.dimension("dim_date", visible).select("date_key"))
        calendars = {
            "dim_time": (calendar.time_dimension(spark), "time_key"),
            "dim_date": (
                calendar.date_dimension(
                    calendar.bounds_or_today(
                        calendar.calendar_bounds(*dated),
                        self.as_of,
                    )
                ),
                "date_key",
            ),
        }

        def load_calendar(table: str) -> int:
            built, key = calendars[table]
            with self.phase("LOAD", table) as tally:
                kept = store.dimension(table, visible)
                tally.written = store.write(
                    table, self.run_id, calendar.add_missing(kept, built, key)
                )
                return tally.written

        def load_fact(fact: str) -> int:
            group = FACTS[fact][0]
            with self.phase("LOAD", fact) as tally:
                tally.read = self._size(group, groups[group])
                existing, mode = store.fact(fact, base), "overwrite"
                # Whole months, which keep their bounded number of files.
                count = slices(store.work_bytes(self.run_id, group))
                month = F.floor(F.coalesce(F.col("date_key"), F.lit(0)) / 100)
                for n in range(count):
                    rows = groups[group]
                    if count > 1:
                        rows = rows.filter(F.pmod(month, F.lit(count)) == n)
                    tally.written += store.write(
                        fact, self.run_id, fact_rows(rows, existing, dims, fact), mode
                    )
                    mode = "append"
                return tally.written + (existing.count() if base else 0)

        counts |= self._each(
            lambda table: load_fact(table) if table in FACTS else load_calendar(table),
            [*calendars, *FACTS],
        )
        store.commit(self.run_id, rebuilt or not visible, _now())
        return counts


@dataclass(frozen=True)
class Summary:
    run_id: str
    extracted: dict[str, int]
    loaded: dict[str, int]
    rejected: int


def run_etl(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    as_of: dt.date,
    mode: str = "incremental",
    since: dt.datetime | None = None,
    hot_rows: int = HOT_ROWS,
    zone: str = "UTC",
    narrow: bool = True,
) -> Summary:
    """Run the three phases against a warehouse directory.

    ``zone`` is where the business is: zone-free source times are taken to be
    its wall clock, and dates and hours of the warehouse are those of its clock,
    whatever zone the session has.

    ``incremental`` appends what changed since the last run, ``full`` lands
    everything again, ``rebuild`` also empties facts and dimensions first. An
    incremental run judges, and quarantines, only facts that changed or meet a
    new member; without ``narrow`` it judges all landed history again. Facts
    and dimensions come out the same.
    """
    run = Run(Store(spark, root), mode, as_of, since, hot_rows, zone, narrow)
    extracted = run.extract(sources)
    groups = run.transform()
    loaded = run.load(groups)
    return Summary(run.run_id, extracted, loaded, run.rejected)

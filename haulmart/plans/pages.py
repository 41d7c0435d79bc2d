"""Deep pages: a listing written in order, and a directory of where its rows lie.

``offset`` lets one task walk over every row before the page. Here the rows of a
listing are sorted once, by a range shuffle on the order and the id, into files
of bounded length. The directory holds one row per file with the rank of its
first row, so a page names the two or three files that hold it and reads no
other, however deep it is.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmart.plans.listing import LISTINGS, matching, ordered

# Rows of a file, so a page reads at most two files more than it fills.
STEP = 100_000
# Position in the order; grows along it, with gaps.
_AT = "_at"


@dataclass(frozen=True)
class SortedListing:
    """A listing as it was when written; reads pages of any depth."""

    spark: SparkSession
    path: str
    table: str

    @classmethod
    def write(
        cls, sources: Mapping[str, DataFrame], table: str, path: str, term: str = "", step: int = STEP
    ) -> SortedListing:
        """Sort the matching rows into files of ``step`` and record where each file begins.

        Ties are ordered by id, also between files, so one order key with very
        many rows is spread like any others. No rows give no pages.
        """
        rows = matching(sources, table, term)
        spark = rows.sparkSession
        # A sorted frame numbers its partitions in order, and rows within them.
        rows.orderBy(ordered(LISTINGS[table].order), "id").withColumn(
            _AT, F.monotonically_increasing_id()
        ).write.mode("overwrite").option("maxRecordsPerFile", step).parquet(f"{path}/rows")
        files = (
            spark.read.parquet(f"{path}/rows")
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.min(_AT).alias("first"), F.count(F.lit(1)).alias("n"))
        )
        # One row per file: the window is over the directory, not over the rows.
        before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
        files.select(
            "file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/directory")
        return cls(spark, path, table)

    def _directory(self) -> DataFrame:
        return self.spark.read.schema("file string, n bigint, start bigint").parquet(f"{self.path}/directory")

    def count(self) -> int:
        """Rows of the listing, from the directory alone."""
        return self._directory().agg(F.sum("n")).first()[0] or 0

    def pages(self) -> int:
        """Number of pages; an empty listing has one, without rows."""
        return max(1, -(-self.count() // LISTINGS[self.table].page))

    def files_of(self, number: int) -> list[tuple[str, int]]:
        """(file, rank of its first row) of the files that hold a page, in order."""
        size = LISTINGS[self.table].page
        first = (number - 1) * size
        held = self._directory().filter((F.col("start") < first + size) & (F.col("start") + F.col("n") > first))
        return [(r["file"], r["start"]) for r in held.orderBy("start").collect()]

    def page(self, number: int) -> DataFrame:
        """One page as :func:`listing.page` gives it; none beyond the last."""
        if number < 1:
            raise ValueError(f"pages are numbered from 1, not {number}")
        rows = self.spark.read.parquet(f"{self.path}/rows")
        files = self.files_of(number)
        if not files:
            return rows.drop(_AT).limit(0)
        size = LISTINGS[self.table].page
        found = self.spark.read.schema(rows.schema).parquet(*[name for name, _ in files])
        return found.orderBy(_AT).offset((number - 1) * size - files[0][1]).limit(size).drop(_AT)

"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.sources.store import application_folder


def folder(spark: SparkSession) -> str:
    """Where this application keeps its tables, below ``spark.checkpoint.dir``."""
    return f"{application_folder(spark)}/corpus"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; no two calls give the same."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back.

    This cuts the lineage: a lost executor costs a reread, not a recomputation,
    and what was drawn or numbered once stays as it is.
    """
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results read from them end."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Remembered:
    """Values of distinct words that a worker has made, at most ``most`` between batches.

    When they are too many, the words that came up again stay and the others go.
    """

    def __init__(self, most: int) -> None:
        self.values: dict[str, bytes] = {}
        self._most, self._again = most, set()

    def unknown(self, rows: Iterable[list[str]]) -> set[str]:
        """The words of ``rows`` that have no value yet."""
        seen = set().union(*rows)
        new = seen.difference(self.values)
        self._again |= seen - new
        return new

    def trim(self) -> None:
        if len(self.values) <= self._most:
            return
        stay = self._again if len(self._again) <= self._most // 2 else ()
        self.values, self._again = {w: self.values[w] for w in stay}, set()


def whole_row(rows: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that names of helper columns cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias(name)


def unpack(rows: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    return rows.select(*[F.col(name).getField(c).alias(c) for c in columns])

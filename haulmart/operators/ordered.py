"""Ordered carry: the last known value before each row of a group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.operators.hotkeys import HOT_ROWS, hot_keys, key_table


@dataclass(frozen=True)
class Carry:
    """A running value that can be cut into buckets and put together again."""

    running: Callable[[str], Column]
    bucket_end: Callable[[str, Sequence[str]], Column]
    combine: Callable[[Column, Column], Column]


LAST = Carry(
    running=lambda value: F.last(value, ignorenulls=True),
    bucket_end=lambda value, order: F.max(
        F.when(F.col(value).isNotNull(), F.struct(*order, value))
    )[value],
    combine=lambda inside, earlier: F.coalesce(inside, earlier),
)
HIGHEST = Carry(
    running=lambda value: F.max(value),
    bucket_end=lambda value, order: F.max(value),
    combine=lambda inside, earlier: F.greatest(inside, earlier),
)


def _within(
    rows: DataFrame,
    group: list[str],
    buckets: Sequence[Sequence[str]],
    value: str,
    order: Sequence[str],
    out: str,
    carry: Carry,
) -> DataFrame:
    """Carry by nested buckets: inside the bucket and from the earlier ones."""
    before = Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    if not buckets:
        return rows.withColumn(out, carry.running(value).over(before.orderBy(*order)))
    level = list(buckets[0])
    inner = _within(rows, group + level, buckets[1:], value, order, out, carry)
    # One row per bucket; copies of a row shrink before the shuffle.
    ends = rows.groupBy(*group, *level).agg(carry.bucket_end(value, order).alias("_end"))
    carried = ends.withColumn(
        "_carried", carry.running("_end").over(before.orderBy(*level))
    ).drop("_end")
    # Order values may be null, and a bucket of null ones is a bucket like any other.
    names = [*group, *level]
    carried = carried.select(*[F.col(n).alias(f"_of_{n}") for n in names], "_carried")
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_of_{n}"))
    return (
        inner.join(carried, same)
        .withColumn(out, carry.combine(F.col(out), F.col("_carried")))
        .drop("_carried", *[f"_of_{n}" for n in names])
    )


def before_each(
    rows: DataFrame,
    group: str,
    value: str,
    order: Sequence[str],
    buckets: Sequence[dict[str, Column]],
    out: str,
    carry: Carry = LAST,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last (or highest) non-null ``value`` of the rows before each row of its group.

    ``order`` identifies the row; nulls in it come first. Groups of ordinary
    size use one window. A group over ``hot_rows`` is cut along ``buckets``,
    a list of nested levels each given as named expressions that follow
    ``order``: every bucket is worked on its own and the value before it comes
    from a summary with one row per bucket. Rows without a group get null and
    never enter a window.
    """
    keyed = rows.filter(F.col(group) != "")
    nameless = rows.filter(~F.coalesce(F.col(group) != "", F.lit(False))).withColumn(
        out, F.lit(None).cast(rows.schema[value].dataType)
    )
    columns = [*rows.columns, out]
    hot = hot_keys(keyed, F.col(group), hot_rows)
    if not hot:
        whole = _within(keyed, [group], [], value, order, out, carry)
        return whole.select(*columns).unionByName(nameless.select(*columns))

    crowded = key_table(rows, hot, group)
    ordinary = keyed.join(crowded, group, "left_anti")
    cold = _within(ordinary, [group], [], value, order, out, carry)
    cut = keyed.join(crowded, group, "left_semi")
    for level in buckets:
        cut = cut.withColumns(level)
    names = [list(level) for level in buckets]
    split = _within(cut, [group], names, value, order, out, carry)
    return (
        cold.select(*columns)
        .unionByName(split.select(*columns))
        .unionByName(nameless.select(*columns))
    )

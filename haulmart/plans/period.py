"""Optional inclusive date range that scopes every report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.functions.render import spell

# Days back from the last day with data.
PRESET_DAYS = {"mes": 30, "trimestre": 91, "anio": 365}


@dataclass(frozen=True)
class Period:
    start: dt.date | None = None
    end: dt.date | None = None

    @property
    def is_open(self) -> bool:
        return self.start is None and self.end is None

    def label(self) -> str:
        if self.start and self.end:
            return f"{spell(self.start)} — {spell(self.end)}"
        if self.start:
            return f"desde {spell(self.start)}"
        if self.end:
            return f"hasta {spell(self.end)}"
        return "todo el histórico"


ALL = Period()


def _key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def scope(fact: DataFrame, period: Period) -> DataFrame:
    """Restrict a fact to the period.

    Date keys order like dates, so the bounds become plain comparisons on the
    fact and reach the Parquet scan without a join to the calendar.
    """
    if period.start:
        fact = fact.filter(F.col("date_id") >= _key(period.start))
    if period.end:
        fact = fact.filter(F.col("date_id") <= _key(period.end))
    return fact


def from_request(
    preset: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    last_day: dt.date | None = None,
) -> Period:
    """The requested period; all of history where the request makes no sense.

    Presets count back from the last day with data, not from today: a
    warehouse that ends weeks ago would otherwise show nothing.
    """
    if preset not in (None, "", "todo", *PRESET_DAYS):
        return ALL
    if start and end and start > end:
        return ALL
    if preset in PRESET_DAYS and last_day:
        return Period(last_day - dt.timedelta(days=PRESET_DAYS[preset]), last_day)
    if preset == "todo":
        return ALL
    return Period(start, end)

"""Named cleaning rules as Column expressions.

Every function takes and returns a ``Column`` and stays inside the JVM, so a
rule can be used in a projection, a filter or a verdict without leaving
whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
UNKNOWN_TEXT = "DESCONOCIDA"
UNSPECIFIED_CAUSE = "NO_ESPECIFICADA"
UNZONED = "SIN_ZONA"
EFFICIENCY_LOW = "1.0"
EFFICIENCY_HIGH = "12.0"
DELAY_TOLERANCE_MINUTES = 15

# Unicode white space, which Java's \s alone does not cover.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
# Marks a word start inside a run of non-space characters.
_WORD_MARK = "\u0001 "


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Drop white space of any kind from both ends."""
    return F.btrim(value, F.lit(_SPACES))


def normalize_text(value: Column) -> Column:
    """Collapse white space and capitalise every run of letters."""
    spaced = F.trim(F.regexp_replace(_text(value), f"{_SPACE}+", " "))
    marked = F.regexp_replace(
        spaced, f"(?<=[^{_CASED}\\s])(?=[{_CASED}])", _WORD_MARK
    )
    return F.regexp_replace(F.initcap(marked), _WORD_MARK, "")


def normalize_code(value: Column) -> Column:
    """Upper-case identifier without surrounding white space."""
    return F.upper(strip(_text(value)))


def normalize_plate(value: Column) -> Column:
    """Upper-case plate with everything but ASCII letters and digits removed."""
    return F.upper(F.regexp_replace(_text(value), "[^A-Za-z0-9]", ""))


def default_if_blank(value: Column, fallback: str = UNKNOWN_TEXT) -> Column:
    return F.when(strip(_text(value)) == "", F.lit(fallback)).otherwise(value)


def code_or(value: Column, fallback: str) -> Column:
    """Normalised code, or ``fallback`` where it comes out empty."""
    return F.coalesce(F.nullif(normalize_code(value), F.lit("")), F.lit(fallback))


def is_positive(value: Column) -> Column:
    return F.coalesce(value > 0, F.lit(False))


def is_non_negative(value: Column) -> Column:
    return F.coalesce(value >= 0, F.lit(False))


def dates_are_coherent(departure: Column, arrival: Column) -> Column:
    """An arrival may be missing but may never precede the departure."""
    return (
        F.when(departure.isNull(), False)
        .when(arrival.isNull(), True)
        .otherwise(arrival >= departure)
    )


def is_efficiency_outlier(value: Column) -> Column:
    low = F.lit(EFFICIENCY_LOW).cast("decimal(3,1)")
    high = F.lit(EFFICIENCY_HIGH).cast("decimal(3,1)")
    return F.coalesce(~value.between(low, high), F.lit(False))


def age_range(year: Column, reference_year: int) -> Column:
    age = F.greatest(F.lit(reference_year) - year, F.lit(0))
    return F.when(age <= 3, "0-3").when(age <= 8, "4-8").when(age > 8, "9+")


def distance_range(km: Column) -> Column:
    return F.when(km < 80, "CORTA").when(km < 350, "MEDIA").when(km >= 350, "LARGA")


def capacity_range(kg: Column) -> Column:
    return (
        F.when(kg < 2000, "LIGERA").when(kg < 15000, "MEDIANA").when(kg >= 15000, "PESADA")
    )


def full_years(since: Column, as_of: dt.date) -> Column:
    """Completed years, comparing (month, day); never negative."""
    today = F.lit(as_of.month * 100 + as_of.day)
    anniversary = F.month(since) * 100 + F.dayofmonth(since)
    years = F.lit(as_of.year) - F.year(since) - (today < anniversary).cast("int")
    return F.when(since.isNotNull(), F.greatest(years, F.lit(0)))


def seniority_range(hire_date: Column, as_of: dt.date) -> Column:
    years = full_years(hire_date, as_of)
    return F.when(years <= 2, "0-2").when(years <= 5, "3-5").when(years > 5, "6+")

"""Derived measures of deliveries, fuel loads, vehicles, routes and operators."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmart.functions.cleaning import DELAY_TOLERANCE_MINUTES

# Fixed values
SERVICE_WARNING_KM = 1000
SERVICE_MAX_DAYS = 180
SERVICE_INTERVAL_KM = 10000
CLOSED_STATUSES = ("DELIVERED", "DELAYED", "CANCELLED")
# First hour of each band of the day, in order.
TIME_BAND_STARTS = (
    (0, "MADRUGADA"),
    (6, "MANANA"),
    (7, "PICO_AM"),
    (10, "MEDIODIA"),
    (17, "PICO_PM"),
    (20, "NOCHE"),
)


def instant(at: dt.datetime, like: T.DataType, zone: str | None = None) -> Column:
    """A driver-side instant in the timestamp type of the column it meets.

    Against a zone-free column it is the wall clock in ``zone``; without one,
    ``at`` is taken to be that wall clock already.
    """
    if isinstance(like, T.TimestampNTZType):
        if zone is not None:
            at = at.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
        return F.lit(at.isoformat(sep=" ")).cast(like)
    return F.lit(at)


def moment_in(wall: Column, zone: str, session_zone: str | None = None) -> Column:
    """The instant at which a clock in ``zone`` shows a zone-free timestamp.

    The session's own zone takes no part in it, but where it is given and the
    same, a cast does the same for less.
    """
    if session_zone == zone:
        return wall.cast("timestamp")
    return F.make_timestamp_ltz(
        F.year(wall), F.month(wall), F.dayofmonth(wall), F.hour(wall), F.minute(wall),
        F.date_part(F.lit("SECOND"), wall), F.lit(zone),
    )


def wall_clock(
    moment: Column, kind: T.DataType, zone: str, session_zone: str | None = None
) -> Column:
    """What a clock in ``zone`` shows; zone-free timestamps and dates are that already."""
    if not isinstance(kind, T.TimestampType):
        return moment
    if session_zone == zone:
        return moment.cast("timestamp_ntz")
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    universal = epoch + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), universal)


def session_zone(rows: DataFrame) -> str:
    """The zone in which the session of ``rows`` casts timestamps."""
    return rows.sparkSession.conf.get("spark.sql.session.timeZone")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds; interval arithmetic, so no time zone is involved."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes, rounded half-even."""
    return F.bround(seconds_between(start, end) / 60, 0).cast("int")


def date_key(moment: Column) -> Column:
    """Calendar key yyyyMMdd of a date or timestamp."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def time_key(moment: Column) -> Column:
    return F.hour(moment)


def time_band(hour: Column) -> Column:
    band = F.when(hour < 0, None)
    for start, name in reversed(TIME_BAND_STARTS):
        band = band.when(hour >= start, name)
    return band


def delay_minutes(scheduled_arrival: Column, actual_arrival: Column) -> Column:
    """Minutes past schedule; zero when early or still open."""
    late = F.greatest(minutes(scheduled_arrival, actual_arrival), F.lit(0))
    return F.when(actual_arrival.isNull(), 0).otherwise(late)


def is_delayed(delay: Column) -> Column:
    return (delay > DELAY_TOLERANCE_MINUTES).cast("int")


def is_open(status: Column) -> Column:
    return ~status.isin(*CLOSED_STATUSES)


def cost_per_km(freight: Column, distance: Column) -> Column:
    """Freight per kilometre, four decimals half-even, zero where undefined."""
    ratio = F.bround(F.try_divide(freight, distance), 4)
    return F.coalesce(ratio, F.lit(0)).cast("decimal(14,4)")


def efficiency(km: Column, liters: Column) -> Column:
    """Kilometres per litre, two decimals half-even; null without a distance."""
    ratio = F.bround(km / F.nullif(liters, F.lit(0)), 2).cast("decimal(18,2)")
    return F.when((km > 0) & (liters > 0), ratio)


def fuel_total(liters: Column, price: Column) -> Column:
    return F.bround(liters * price, 2).cast("decimal(14,2)")


def maintenance_total(labor: Column, parts: Column) -> Column:
    return (labor + parts).cast("decimal(14,2)")


def full_name(first: Column, last: Column) -> Column:
    """First and last name as captured, without title-casing."""
    return F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))


def km_to_next_service(next_service_km: Column, odometer_km: Column) -> Column:
    return next_service_km - odometer_km


def days_since_service(last_service: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), last_service)


def needs_maintenance(remaining_km: Column, elapsed_days: Column) -> Column:
    return (
        (remaining_km <= SERVICE_WARNING_KM)
        | elapsed_days.isNull()
        | (elapsed_days > SERVICE_MAX_DAYS)
    )


def average_speed(distance_km: Column, duration_min: Column) -> Column:
    """Kilometres per hour implied by the planned duration, two decimals."""
    hours = duration_min.cast("decimal(12,0)") / 60
    speed = F.bround(F.try_divide(distance_km * 60, duration_min.cast("decimal(12,0)")), 2)
    return F.when(F.coalesce(hours, F.lit(0)) == 0, F.lit(0)).otherwise(speed).cast("decimal(14,2)")


def license_is_valid(expiry: Column, as_of: dt.date) -> Column:
    return expiry >= F.lit(as_of)

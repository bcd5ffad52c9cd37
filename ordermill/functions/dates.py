"""Calendar and duration expressions."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime) -> Column:
    """Literal without zone. A plain datetime literal would be shifted by the session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def calendar_day(ts: Column) -> Column:
    return F.to_date(ts)


def day_of_week_from_sunday(day: Column) -> Column:
    """0 for Sunday up to 6 for Saturday; Spark itself counts from 1."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def padded_name(day: Column, pattern: str) -> Column:
    """English month or day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour periods from start to end, cut toward zero."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def utc_wall_time(text: Column) -> Column:
    """Zone-marked ISO text as a UTC timestamp without zone, whatever the session zone.

    Counted from the epoch, so hours that a local clock repeats are no trouble.
    """
    seconds = F.unix_micros(text.cast("timestamp")).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    return moment(datetime(1970, 1, 1)) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


# Fixed value: how an ISO time ends that says its zone.
_ZONE = r":\d{2}(\.\d+)?\s*([Zz]|[+-]\d{2}(:?\d{2})?)$"


def event_moment(text: Column) -> Column:
    """Time of an event as a UTC timestamp without zone; NULL if the text is no time.

    Text with a zone is brought to UTC, text without one is taken as it stands.
    """
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    zoned = moment(datetime(1970, 1, 1)) + F.make_dt_interval(secs=micros.cast("decimal(18,6)"))
    return F.when(F.rlike(text, F.lit(_ZONE)), zoned).otherwise(text.try_cast("timestamp_ntz"))

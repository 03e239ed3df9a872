"""Lenient casts and time formatting. Bad input becomes null instead of failing the job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts for mixed text, in order of preference: month first wins where both readings fit.
DATE_LAYOUTS = ("yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "yyyyMMdd")
STAMP = "yyyy-MM-dd HH:mm:ss"
MINUTE = "yyyy-MM-dd HH:mm"
DAY_FIRST = "dd-MM-yyyy"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: dt.datetime | dt.date | str | Column) -> Column:
    """``as_of`` as a zone-free timestamp column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: dt.datetime | dt.date | str | Column) -> Column:
    """``as_of`` as a date column."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc)
    return F.lit(dt.date.fromisoformat(str(value)[:10]))


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' HOUR")


def try_date(c: Column | str) -> Column:
    return as_col(c).try_cast("date")


def try_day_first(c: Column | str) -> Column:
    """Text written day-month-year; anything else is null."""
    return F.try_to_date(as_col(c), DAY_FIRST)


def mixed_date(c: Column | str, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """The first layout that fits, else an ISO timestamp cut to its date, else null."""
    text = as_col(c).cast("string")
    return F.coalesce(*[F.try_to_date(text, layout) for layout in layouts],
                      text.try_cast("timestamp_ntz").cast("date"))


def try_bigint(c: Column | str) -> Column:
    return as_col(c).try_cast("bigint")


def cents(c: Column | str) -> Column:
    """Lenient number, then cents to units."""
    return as_col(c).try_cast("double") / F.lit(100)


def try_stamp(c: Column | str) -> Column:
    """ISO text with ``T`` or a blank between date and time; null if it does not parse."""
    return F.replace(as_col(c).cast("string"), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def minute_text(c: Column | str) -> Column:
    return F.date_format(try_stamp(c), MINUTE)


def stamp_text(c: Column | str, default: str | None = None) -> Column:
    text = F.date_format(as_col(c), STAMP)
    return text if default is None else F.coalesce(text, F.lit(default))


def day_text(c: Column | str) -> Column:
    return F.date_format(as_col(c), DAY_FIRST)


def shift_hours(c: Column | str, n: int) -> Column:
    """Fixed zone shift: ``n`` may be negative."""
    return as_col(c) + hours(n)


def drop_zone(c: Column | str) -> Column:
    """Aware timestamp to the zone-free wall time of the session zone (UTC)."""
    return as_col(c).cast("timestamp_ntz")


def attach_utc(c: Column | str) -> Column:
    """Zone-free timestamp read as UTC; the session zone is UTC."""
    return as_col(c).cast("timestamp")


def int_text(c: Column | str) -> Column:
    return as_col(c).cast("string")

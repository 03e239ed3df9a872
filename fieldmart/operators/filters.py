"""Row predicates and column-set helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_col, day, hours, moment


def days_back(c: Column | str, as_of, oldest: int, newest: int) -> Column:
    """Date within the closed band ``[as_of - oldest, as_of - newest]``."""
    c = as_col(c)
    return (c >= F.date_sub(day(as_of), oldest)) & (c <= F.date_sub(day(as_of), newest))


def not_listed(c: Column | str, values: Iterable[str]) -> Column:
    """SQL ``NOT IN``: a null value is not kept."""
    return ~as_col(c).isin(*values)


def since_hours(c: Column | str, as_of, n: int) -> Column:
    return as_col(c).cast("timestamp_ntz") >= moment(as_of) - hours(n)


def until_hours(c: Column | str, as_of, n: int) -> Column:
    return as_col(c).cast("timestamp_ntz") <= moment(as_of) - hours(n)


def within_days(c: Column | str, first, end) -> Column:
    """Half-open timestamp range ``[first, end)`` of whole days."""
    c = as_col(c).cast("timestamp_ntz")
    return (c >= moment(first)) & (c < moment(end))


def not_ignored(c: Column | str, ignored: Iterable[str]) -> Column:
    names = [n.lower() for n in ignored]
    return ~F.lower(as_col(c)).isin(*names) if names else F.lit(True)


def filled(*cols: Column | str) -> Column:
    """Every column is present and not empty."""
    keep = F.lit(True)
    for c in cols:
        keep = keep & (F.coalesce(as_col(c).cast("string"), F.lit("")) != "")
    return keep


def at_least(df: DataFrame, c: str, limit: float) -> tuple[DataFrame, DataFrame]:
    """Rows at or above the limit, and rows below it. Rows without a value are in neither."""
    return df.filter(F.col(c) >= limit), df.filter(F.col(c) < limit)


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(f"`{n}`") for n in names if n in have])


def drop_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    gone = set(names)
    return df.select(*[F.col(f"`{n}`") for n in df.columns if n not in gone])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name; a missing column is null."""
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)

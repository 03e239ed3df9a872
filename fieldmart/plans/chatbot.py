"""Chatbot events: customer fields opened, internals dropped, minute resolution, no repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import day, minute_text, try_stamp
from ..operators.aggregates import top_counts
from ..operators.nested import expand_struct

# Columns that do not belong in the table.
INTERNAL = ("trackingBlipEafId", "identity", "updateDate", "sessionID", "errors", "tracking",
            "id", "uuid", "ibgeCode", "familyCode", "cpf")


def recent_events(records: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Events of the last ``days`` days up to the run date; unreadable dates are kept."""
    d = try_stamp("date").cast("date")
    return records.filter(d.isNull() | ((d >= F.date_sub(day(as_of), days)) & (d <= day(as_of))))


def chatbot_events(records: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """The event table. Repeats are removed once, after the time is cut to the minute: that also
    removes everything an earlier pass on the full time would."""
    if as_of is not None:
        records = recent_events(records, as_of, days)
    flat = expand_struct(records, "crm", INTERNAL)
    return flat.withColumn("date", minute_text("date")).distinct()


def top_categories(events: DataFrame, n: int = 10) -> DataFrame:
    return top_counts(events, "category", n)

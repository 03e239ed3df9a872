"""Login and logout times per user."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import shift_hours
from ..functions.text import or_text
from ..operators.filters import not_ignored, within_days
from ..operators.sequence import pair_sessions

ZONE_SHIFT = -3


def report_rows(pairs: DataFrame) -> DataFrame:
    """Report columns of session pairs, in local time."""
    start, stop = shift_hours("started", ZONE_SHIFT), shift_hours("stopped", ZONE_SHIFT)
    return pairs.select(
        F.col("user").alias("usuario"), F.date_format(start, "yyyy-MM-dd").alias("data"),
        F.date_format(start, "HH:mm:ss").alias("horario entrada"),
        F.coalesce(F.date_format(stop, "HH:mm:ss"), F.lit("N/A")).alias("horario saida"),
    )


def login_report(events: DataFrame, first: dt.date, end: dt.date | None = None,
                 ignored: Iterable[str] = (), tie: str = "id") -> DataFrame:
    """Session rows of the days ``[first, end)``, one day when no end is given. ``ignored`` lists
    service accounts. Days are cut on the stored time, the output is shifted, so its date can be
    the day before."""
    end = end or first + dt.timedelta(days=1)
    user = or_text("username", "NULL")
    kept = events.filter(within_days("loginTime", first, end)).withColumn("username", user)
    kept = kept.filter(not_ignored("username", ignored))
    return report_rows(pair_sessions(kept, "username", "loginTime", "event", tie))

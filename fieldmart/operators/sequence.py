"""Operators over ordered events and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import as_col, day


def pair_sessions(events: DataFrame, user: str, ts: str, event: str, tie: str,
                  start: str = "LOGIN", stop: str = "LOGOUT", slice_minutes: int = 60) -> DataFrame:
    """Start/stop pairs per user: ``user, started, stopped``.

    In time order, a start takes the next stop and uses up everything between them. A start that
    no stop follows gives its own row with a null stop. Stops without a start, and other events,
    give nothing.

    Events without a user or a time are left out.

    With only starts and stops left, a start is kept when no stop follows at all, or when the event
    right before it is not a start. Both facts cross time slices through a one-row summary per user
    and slice, so the window that sees single events is bounded by a slice, not by a user: a user
    with a third of all events is spread over as many groups as there are slices. The events are
    shuffled once; both the window and the summary read that shuffle.
    """
    u, t = F.col(user), F.col(ts).cast("timestamp_ntz")
    seconds = F.unix_seconds(t.cast("timestamp"))
    # The slice number is never null, so the join below adds no filter to one branch only, which
    # would keep the two branches from sharing the shuffle.
    slice_number = F.coalesce(F.floor(seconds / (60 * slice_minutes)), F.lit(0))
    sliced = (events.filter(F.col(event).isin(start, stop) & u.isNotNull() & F.col(ts).isNotNull())
              .select(u.alias("user"), t.alias("ts"), F.col(tie).alias("tie"),
                      F.coalesce(F.col(event) == stop, F.lit(False)).alias("is_stop"),
                      slice_number.alias("part"))
              .repartition("user", "part"))

    # Newest first: "any later row" is then a growing frame, which is updated row by row; a frame
    # that reaches forward would be computed again for every row.
    within = Window.partitionBy("user", "part").orderBy(F.desc("ts"), F.desc("tie"))
    local = sliced.select(
        "user", "part", "ts", "is_stop",
        F.lead("is_stop").over(within).alias("prev_stop"),
        F.min(F.when(F.col("is_stop"), F.col("ts"))).over(
            within.rowsBetween(Window.unboundedPreceding, -1)).alias("next_stop"),
    ).filter(~F.col("is_stop"))

    across = Window.partitionBy("user").orderBy(F.desc("part"))
    summary = (sliced.groupBy("user", "part")
               .agg(F.max(F.struct("ts", "tie", "is_stop")).alias("last"),
                    F.min(F.when(F.col("is_stop"), F.col("ts"))).alias("first_stop"))
               .select("user", "part", F.lead("last.is_stop").over(across).alias("before_stop"),
                       F.min("first_stop").over(
                           across.rowsBetween(Window.unboundedPreceding, -1)).alias("later_stop")))

    both = local.join(summary, ["user", "part"])
    stopped = F.coalesce("next_stop", "later_stop")
    prev_stop = F.coalesce("prev_stop", "before_stop", F.lit(True))
    return (both.filter(stopped.isNull() | prev_stop)
            .select("user", F.col("ts").alias("started"), stopped.alias("stopped")))


def missing_dates(calendar: DataFrame, date_col: str, as_of, seed: str = "2025-01-01",
                  out: str = "Data") -> DataFrame:
    """Dates after the newest one in the calendar up to ``as_of``; none when it is not older.

    An empty calendar counts as ending on the seed date.
    """
    newest = F.coalesce(F.max(as_col(date_col).cast("date")), F.lit(seed).cast("date"))
    first = calendar.agg(F.date_add(newest, 1).alias("first"))
    return (first.filter(F.col("first") <= day(as_of))
            .select(F.explode(F.sequence(F.col("first"), day(as_of))).alias(out)))

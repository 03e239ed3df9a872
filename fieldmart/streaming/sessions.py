"""Session pairing on a stream of login events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import pair_sessions
from ..session import exists


def report_days(spark: SparkSession, inbox: str, report: str, user: str, ts: str, event: str, tie: str,
                before: dt.date | None, number: int, start: str = "LOGIN", stop: str = "LOGOUT") -> None:
    """Pairs the waiting days that no earlier batch has closed and that end before ``before`` (all when None).

    The report's folder ``closed`` has, for each batch, the limit up to which it closed the days; only
    the inbox partitions between the last limit of an earlier batch and ``before`` are read. With
    None, the last flush, the days after that stay open for good.
    """
    waiting = spark.read.parquet(inbox).filter(F.col("batch_no") <= number)
    if before is not None:
        waiting = waiting.filter(F.col("day") < F.lit(str(before)).cast("date"))
    limits = f"{report}/_closed"
    if exists(spark, limits):
        done = spark.read.schema("until date, batch_no long").parquet(limits).filter(F.col("batch_no") < number).agg(F.max("until")).first()[0]
        if done is not None:
            waiting = waiting.filter(F.col("day") >= F.lit(str(done)).cast("date"))
    keyed = waiting.withColumn("_key", F.struct(F.col(user).alias("user"), "day"))
    pairs = pair_sessions(keyed, "_key", ts, event, tie, start, stop)
    out = pairs.select(F.col("user.user").alias("user"), F.col("user.day").alias("day"), "started", "stopped")
    out.write.mode("overwrite").parquet(f"{report}/batch_no={number}")
    if before is not None:
        spark.range(1).select(F.lit(str(before)).cast("date").alias("until")).coalesce(1).write.mode("overwrite").parquet(f"{limits}/batch_no={number}")


def session_sink(inbox: str, report: str, user: str, ts: str, event: str, tie: str,
                 delay_hours: int = 1, start: str = "LOGIN", stop: str = "LOGOUT"
                 ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: events wait in a day-partitioned table; a day is paired, with the same
    operator as the batch report, once events ``delay_hours`` after its end arrive.

    The waiting table is the state: it survives lost executors, holds a busy user as many rows
    instead of one state value, and a repeated batch overwrites what its first try wrote. Events
    that come after their day was reported are not counted, as with any watermark.
    """
    def write(batch: DataFrame, number: int) -> None:
        moment = F.col(ts).cast("timestamp_ntz")
        (batch.filter(F.col(event).isin(start, stop)).withColumn("day", moment.cast("date"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("day").parquet(f"{inbox}/batch_no={number}"))
        written = batch.sparkSession.read.parquet(f"{inbox}/batch_no={number}")
        newest = written.agg(F.max(moment)).first()[0]
        if newest is not None:
            closed = (newest - dt.timedelta(hours=delay_hours)).date()
            report_days(batch.sparkSession, inbox, report, user, ts, event, tie, closed, number, start, stop)

    return write

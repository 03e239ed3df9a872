"""Created-per-day counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import Batches


def created_sink(path: str, keys: Sequence[str], every: int = 16) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer for output mode ``update``: each batch adds the counts it changed, in a folder of its
    own that a repeated batch overwrites. After ``every`` batches, the newest counts alone are kept of all before."""
    stored = Batches(path, every)

    def write(batch: DataFrame, number: int) -> None:
        count = batch.columns[-1]
        rows = batch.select("dia", *keys, count).withColumn("batch_no", F.lit(number).cast("long"))

        def newest(old: DataFrame) -> DataFrame:
            last = F.max_by(count, "batch_no").alias(count), F.max("batch_no").alias("batch_no")
            return old.groupBy("dia", *keys).agg(*last)

        stored.merge(batch.sparkSession, rows.schema, number, newest)
        stored.write(rows, number)

    return write


def written_counts(spark: SparkSession, path: str) -> DataFrame:
    """All that a :func:`created_sink` wrote and has not merged away."""
    return spark.read.parquet(*Batches(path).live(spark))


def latest_counts(written: DataFrame, keys: Sequence[str], count: str = "quantidade") -> DataFrame:
    """The newest count of each day and key that a :func:`created_sink` wrote."""
    return written.groupBy("dia", *keys).agg(F.max_by(count, "batch_no").alias(count))


def created_per_day(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 day",
                    count: str = "quantidade") -> DataFrame:
    """Rows per key and calendar day; a day is final, and leaves the state, once the watermark has passed it."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    counted = timed.groupBy(F.window("_ts", "1 day"), *keys).agg(F.count(F.lit(1)).alias(count))
    return counted.select(F.col("window.start").cast("date").alias("dia"), *keys, count)

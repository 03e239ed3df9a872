"""Exact distinct counts that are kept from day to day.

Ids of any kind get whole numbers once, in a stored numbering that only grows. A day's ids of a class are then a bitmap:
32768 numbers a row, 4 KB. Bitmaps of any days and classes are united bit by bit, so the distinct count over a range
of days needs the stored rows of these days alone, and adding a day touches no other. Counting over days, classes or both
gives what a count of distinct ids over all rows gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import finished_folders, remove


def read_numbering(spark: SparkSession, path: str) -> DataFrame:
    """``id, number`` of all ids that have a number."""
    folders = [f"{path.rstrip('/')}/{n}" for n in finished_folders(spark, path) if n.startswith("run=")]
    schema = "id string, number long"
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def number_ids(spark: SparkSession, path: str, ids: DataFrame, c: str, run: str) -> DataFrame:
    """Gives numbers to the ids that have none yet and returns the whole numbering.

    New ids are numbered from the greatest number on, without gaps, whatever partition they are in: each partition
    counts its own, and the counts of the partitions before it (one row each) are added. A run owns its folder and
    overwrites it when it is repeated; the numbers of other runs never change. Null is no id.
    """
    others = [n for n in finished_folders(spark, path) if n.startswith("run=") and n != f"run={run}"]
    schema = "id string, number long"
    known = spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{n}" for n in others]) if others else spark.createDataFrame([], schema)
    wanted = ids.select(F.col(c).cast("string").alias("id")).filter("id IS NOT NULL").distinct()
    # Partition and place in it, fixed by writing them.
    place = F.monotonically_increasing_id()
    work = f"{path.rstrip('/')}/_new-{run}"
    wanted.join(known.select("id"), "id", "left_anti").select("id", place.alias("place")).write.mode("overwrite").parquet(work)
    fresh = spark.read.schema("id string, place long").parquet(work).withColumn("part", F.shiftright("place", 33))
    sizes = fresh.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select(F.col("part").alias("of"), (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    start = known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("start")).scalar()
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = fresh.join(before, fresh.part == before.of).select("id", (start + F.col("before") + inside).alias("number"))
    numbered.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")
    remove(spark, work)
    return read_numbering(spark, path)


def day_bitmaps(rows: DataFrame, keys: Sequence[str], item: str, numbering: DataFrame) -> DataFrame:
    """``keys, bucket, bits``: the ids of each key combination (a day and a class, say) as bitmaps. Null items are left out."""
    distinct = rows.select(*keys, F.col(item).cast("string").alias("id")).filter("id IS NOT NULL").distinct()
    found = distinct.join(numbering, "id")
    return found.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def united_counts(bitmaps: DataFrame, keys: Sequence[str], count: str = "quantidade") -> DataFrame:
    """Distinct ids of each key combination over all the bitmaps given: those of a range of days, of several classes."""
    united = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(count))

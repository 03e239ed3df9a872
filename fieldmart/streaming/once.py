"""Alert each key once, across micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import KEYS_PUSHED, anti_join, only_keys
from .batches import Batches

HASH = "key_hash"
IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"
PAGE_ROWS = "2000"


def once_sink(ledger_path: str, keys: Sequence[str], every: int = 16) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: rows with a new key are added to the ledger.

    The ledger is a merged part, sorted by a hash of the key over all its files, and at most ``every`` batches
    since (see ``batches``). A batch of up to ``KEYS_PUSHED`` keys reads only the files, row groups and pages that
    can hold one of their hashes; a larger one reads the ledger. A repeated batch overwrites what its first try
    wrote and compares itself only with the batches before, so each key is stored exactly once.
    """
    stored = Batches(ledger_path, every)

    def merged(rows: DataFrame) -> DataFrame:
        return rows.repartitionByRange(HASH).sortWithinPartitions(HASH)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn(HASH, F.xxhash64(*keys))
        spark.conf.set("parquet.page.row.count.limit", PAGE_ROWS)
        stored.merge(spark, rows.schema, number, merged)
        before = spark.conf.get(IN_LIST)
        spark.conf.set(IN_LIST, str(KEYS_PUSHED))  # so that the list of hashes reaches the files' statistics
        try:
            known = only_keys(stored.read(spark, rows.schema, number), HASH, rows)
            fresh = anti_join(rows, known, [HASH, *keys], dedupe_batch=True, known_unique=True)
            stored.write(fresh.repartitionByRange(HASH).sortWithinPartitions(HASH), number)
        finally:
            spark.conf.set(IN_LIST, before)

    return write


def read_ledger(spark: SparkSession, ledger_path: str, schema: T.StructType) -> DataFrame:
    """The rows of a ledger that a ``once_sink`` wrote; ``schema`` is that of its batches."""
    return Batches(ledger_path).read(spark, schema)


def once_within(stream: DataFrame, keys: Sequence[str], ts: str, horizon: str) -> DataFrame:
    """Bounded form: a key can alert again once the horizon has passed."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(list(keys))

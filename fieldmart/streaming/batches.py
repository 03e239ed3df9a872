"""What micro-batches have written so far, in a bounded number of files.

Each batch owns a folder ``batch_no=n`` that a repeated batch overwrites. When ``every`` of them have come together,
the next batch first merges all that is there into one folder ``upto=n`` and removes the merged ones. A folder counts
once its writer has finished (``_SUCCESS``); folders that a newer merge holds are ignored, so a stop at any place
loses nothing and doubles nothing. A batch starts only after the one before is committed, so nothing is merged that
may still be written again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import finished_folders, remove


class Batches:
    def __init__(self, path: str, every: int = 16):
        self.path, self.every = path.rstrip("/"), every

    def _numbers(self, spark: SparkSession) -> tuple[list[int], list[int]]:
        """The finished merges and batches, ascending."""
        names = [n.split("=") for n in finished_folders(spark, self.path) if "=" in n]
        return tuple(sorted(int(v) for k, v in names if k == kind) for kind in ("upto", "batch_no"))

    def live(self, spark: SparkSession, before: int | None = None) -> list[str]:
        """Folders that together hold what the batches with lower numbers (all when None) have written, oldest first."""
        merges, batches = self._numbers(spark)
        base = [m for m in merges if before is None or m < before][-1:]
        later = [b for b in batches if (not base or b > base[0]) and (before is None or b < before)]
        return [f"{self.path}/upto={m}" for m in base] + [f"{self.path}/batch_no={b}" for b in later]

    def read(self, spark: SparkSession, schema: T.StructType, before: int | None = None) -> DataFrame:
        folders = self.live(spark, before)
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def write(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_no={number}")

    def merge(self, spark: SparkSession, schema: T.StructType, number: int, how: Callable[[DataFrame], DataFrame]) -> None:
        """At the start of batch ``number``: merges the batches before it if there are enough of them."""
        folders = self.live(spark, number)
        if len(folders) <= self.every:
            return
        target = f"{self.path}/upto={number - 1}"
        how(spark.read.schema(schema).parquet(*folders)).write.mode("overwrite").parquet(target)
        for old in folders:
            if old != target:
                remove(spark, old)

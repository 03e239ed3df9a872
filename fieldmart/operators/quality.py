"""Checks on loaded data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IncompleteData(Exception):
    """Raised instead of loading a partial or empty table."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The frame itself, or an error when it has no rows."""
    if df.isEmpty():
        raise IncompleteData(f"{name} has no rows; nothing is loaded")
    return df


PAGES_PER_BLOCK = 10_000


def missing_pages(pages: DataFrame, page: str = "page", total: str = "total_pages") -> DataFrame:
    """Page numbers between 1 and the declared page count that were not read.

    The expected numbers are made in blocks that are spread over the cluster first.
    """
    n, size = F.col("n"), F.lit(PAGES_PER_BLOCK).cast("bigint")
    blocks = (pages.agg(F.max(F.col(total).cast("bigint")).alias("n")).filter(n >= 1)
              .select("n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / size))).alias("block"))
              .repartition("block"))
    expected = blocks.select(F.explode(F.sequence(
        F.col("block") * size + 1, F.least(n, (F.col("block") + 1) * size))).alias(page))
    read = pages.select(F.col(page).cast("bigint").alias(page)).distinct()
    return expected.join(read, page, "left_anti")


def row_total(pages: DataFrame, records: str = "data", total: str = "total") -> DataFrame:
    """Declared and read record counts on one row."""
    return pages.agg(F.max(F.col(total).cast("bigint")).alias("declared"),
                     F.coalesce(F.sum(F.greatest(F.size(records), F.lit(0))), F.lit(0))
                     .cast("bigint").alias("read"))


def require_complete(pages: DataFrame, name: str, page: str = "page", total: str = "total_pages",
                     strict_total: bool = False) -> DataFrame:
    """The pages, or an error that says how many are missing, and the first of them."""
    missing = missing_pages(pages, page, total)
    gaps = [r[0] for r in missing.orderBy(page).limit(20).collect()]
    if gaps:
        raise IncompleteData(f"{name}: {missing.count()} missing pages, first {gaps}")
    if strict_total:
        counted = row_total(pages).first()
        if counted["declared"] is not None and counted["declared"] != counted["read"]:
            raise IncompleteData(f"{name}: {counted['read']} of {counted['declared']} records")
    return pages

"""Text reports: one folder of part files each, so a report never passes through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nested import to_plain_cells

BOM = "﻿"


def csv_report(df: DataFrame, path: str, sep: str = ";", bom: bool = True, mode: str = "overwrite") -> None:
    """CSV whose part files, one after the other, are one report: the header, after a byte-order mark, stands once, in
    the first part. A report without rows has its header."""
    form = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": ""}
    names = df.sparkSession.range(1, numPartitions=1).select(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    head = F.to_csv(F.struct(*names.columns), form)
    cells = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    lines = names.select((F.concat(F.lit(BOM), head) if bom else head).alias("value")).union(df.select(F.to_csv(cells, form).alias("value")))
    lines.write.mode(mode).text(path)


def read_csv_report(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """The rows of such a report as texts; the header, wherever its part is read, is left out."""
    first, *others = columns
    kind = ", ".join(f"`{c}` STRING" for c in columns)
    rows = spark.read.schema(kind).option("sep", sep).option("escape", '"').csv(path)
    is_head = F.translate(f"`{first}`", BOM, "").eqNullSafe(F.lit(first))
    for c in others:
        is_head = is_head & F.col(f"`{c}`").eqNullSafe(F.lit(c))
    return rows.filter(~is_head)


def text_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One text column as lines."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.mode(mode).text(path)


def titled_list(df: DataFrame, c: str, title: str, path: str, mode: str = "overwrite") -> None:
    """Values as lines under one title line: the title is the first part file, the values follow."""
    head = df.sparkSession.range(1, numPartitions=1).select(F.lit(title).alias("value"))
    head.union(df.select(F.col(c).cast("string").alias("value"))).write.mode(mode).text(path)


def parquet_cells(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet hand-over: nested cells as JSON text."""
    to_plain_cells(df).write.mode(mode).parquet(path)

"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fieldmart

# Functions that run in tasks travel with their helpers, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[fieldmart.__name__])

# The bytes that separate words.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """Makes sure that ``checkpoint()`` has a folder: the one that the session names in
    ``spark.checkpoint.dir``, or for a local master without one a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
            folder = tempfile.mkdtemp(prefix="fieldmart-")
        context.setCheckpointDir(folder)
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder."""
    return f"{with_checkpoints(spark).sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The frame as a written table in the shared folder: computed once, safe from lost executors, and
    the shuffle files that made it are freed."""
    spark, path = df.sparkSession, work_path(df.sparkSession, "cut")
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct named ``row``: names that an operator needs beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def space_words(text: Column | str) -> Column:
    """The words of a text, ``[^\\x20\\x09-\\x0D]+``; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "[ \\t\\n\\x0b\\f\\r]+"),
                    lambda w: w != "")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def map_texts(df: DataFrame, schema: str, work: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """``mapInArrow`` with a set-up step: ``work()`` runs once in each task and returns the function
    that turns a batch into columns."""
    import pyspark.sql.pandas.types as kinds
    from pyspark.sql.types import _parse_datatype_string

    arrow = kinds.to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            columns = step(batch)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                              for f in arrow for c in (columns[f.name],)], schema=arrow)

    return df.mapInArrow(run, schema)

"""Folders for what a registered query writes and reads back."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="fieldmart-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder the session names in ``spark.checkpoint.dir``.

    Only when that setting is absent, and only with a local master as in tests, it is a local temporary
    folder: executors elsewhere could not read it. The operators and sinks take folders as arguments.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

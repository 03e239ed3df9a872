"""Database and file tables as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import digits_only

# The JDBC driver class of each database.
DRIVERS = {
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgresql": "org.postgresql.Driver",
}


def jdbc_options(url: str, credentials: Mapping[str, str], table: str | None = None,
                 query: str | None = None, split: Mapping[str, object] | None = None,
                 fetch_rows: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read: a whole table or a query, never both.

    ``split`` (column, lower, upper, partitions) reads a big table in parallel. Filters, columns
    and plain aggregates that follow are pushed into the database by Spark.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    kind = url.split(":")[1]
    options = {"url": url, "driver": DRIVERS[kind], "fetchsize": str(fetch_rows),
               "pushDownAggregate": "true", **credentials}
    if split:
        # A partitioned read needs a relation, so a query becomes a derived table.
        options["dbtable"] = table or f"({query}) AS q"
        options["partitionColumn"] = str(split["column"])
        options["lowerBound"] = str(split["lower"])
        options["upperBound"] = str(split["upper"])
        options["numPartitions"] = str(split["partitions"])
    else:
        options["dbtable" if table else "query"] = table or query
    return options


def read_jdbc(spark: SparkSession, url: str, credentials: Mapping[str, str], **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, credentials, **kwargs)).load()


def read_documents(spark: SparkSession, uri: str, database: str, collection: str,
                   schema: T.StructType) -> DataFrame:
    """Document-store collection through its Spark connector (an extra package on the cluster).

    With an explicit schema, filters and nested columns that follow are pushed to the store.
    """
    options = {"connection.uri": uri, "database": database, "collection": collection}
    return spark.read.format("mongodb").options(**options).schema(schema).load()


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parameter_list(spark: SparkSession, items: Iterable[str] | str, name: str = "number") -> DataFrame:
    """A list parameter as a relation of cleaned ids. Text is taken as a JSON list, also with
    single quotes around the items."""
    if isinstance(items, str):
        try:
            items = json.loads(items.replace("'", '"'))
        except json.JSONDecodeError as error:
            raise ValueError(f"the id list is not a JSON list: {error}") from error
    rows = [(str(i),) for i in items]
    if not rows:
        raise ValueError("the id list is empty")
    return spark.createDataFrame(rows, f"{name} string").select(digits_only(name).alias(name))


def parameter_rows(df: DataFrame, text: str, name: str = "number") -> DataFrame:
    """The same for list texts that are already in a table: one row per listed id."""
    fixed = F.replace(F.col(text), F.lit("'"), F.lit('"'))
    return df.select(F.explode(F.from_json(fixed, "array<string>")).alias(name)).select(
        digits_only(name).alias(name))

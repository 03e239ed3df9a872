"""Table writers. A table that is read by its own refresh is written to a new folder first and then
switched over, so a lost executor or a failed job never leaves it half replaced.

Of a partitioned table only the partitions that change are read and written: an upsert overwrites those of
its keys, a trailing replacement points the days of its window to new folders. All others keep their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import day
from ..operators.joins import anti_join, insert_if_absent, replace_window, upsert
from ..session import remove
from ..sources.tables import DRIVERS

# Column lengths of the two typed database tables.
CAMPAIGN_TYPES = {"phone": "NVARCHAR(15)", "date": "NVARCHAR(10)", "campaignName": "NVARCHAR(100)",
                  "city": "NVARCHAR(50)", "status": "NVARCHAR(20)", "origin": "NVARCHAR(20)",
                  "id": "NVARCHAR(50)", "ibge": "NVARCHAR(7)"}
CHATBOT_TYPES = {"phone": "NVARCHAR(15)", "date": "NVARCHAR(100)", "channel": "NVARCHAR(10)",
                 "category": "NVARCHAR(80)", "action": "NVARCHAR(40)", "status": "NVARCHAR(30)",
                 "protocol": "NVARCHAR(20)"}


def jdbc_write_options(url: str, credentials: Mapping[str, str], table: str, batch: int = 10_000,
                       types: Mapping[str, str] | None = None) -> dict[str, str]:
    options = {"url": url, "driver": DRIVERS[url.split(":")[1]], "dbtable": table,
               "batchsize": str(batch), "truncate": "true", **credentials}
    if types:
        options["createTableColumnTypes"] = ", ".join(f"`{c}` {t}" for c, t in types.items())
    return options


def write_jdbc(df: DataFrame, url: str, credentials: Mapping[str, str], table: str,
               mode: str = "append", batch: int = 10_000, types: Mapping[str, str] | None = None) -> None:
    """Append to or replace a database table; a replaced table keeps its definition."""
    kept = {c: t for c, t in (types or {}).items() if c in df.columns}
    df.write.format("jdbc").options(**jdbc_write_options(url, credentials, table, batch, kept)).mode(mode).save()


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Full replacement; the frame must not read from the same folder."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_days(df: DataFrame, path: str, date_col: str) -> None:
    """Replaces exactly the date partitions the frame has rows for."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))


def switch_table(spark: SparkSession, table: str, df: DataFrame, base: str) -> str:
    """Writes the frame to a new folder below ``base`` and points the catalog table there.

    The frame may read the table's present content. Earlier folders stay for readers that still
    use them.
    """
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
    return path


def create_partitioned(spark: SparkSession, table: str, df: DataFrame, column: str, path: str) -> None:
    """A catalog table in the folder, partitioned by the column, with the rows of the frame."""
    columns = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{path}'")
    overwrite_partitions(spark, table, df)


def overwrite_partitions(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Replaces exactly the partitions the frame has rows for. The frame must not read from the table."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*[F.col(f"`{c}`") for c in spark.table(table).columns]).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)


def partition_column(spark: SparkSession, table: str) -> str | None:
    """The column by which a table is partitioned, if it is exactly one."""
    names = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return names[0] if len(names) == 1 else None


def partition_values(spark: SparkSession, table: str) -> list[str]:
    """The partitions of a table by its one partition column, from the catalog; no data is read."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(unquote(r["partition"].split("=", 1)[1]) for r in listed)


def replace_trailing(spark: SparkSession, table: str, fresh: DataFrame, date_col: str, start, base: str) -> str:
    """Everything from ``start`` on is replaced, including days without new rows; returns the new folder below ``base``.

    Where the table is partitioned by ``date_col`` only the new days are written. Then the old days of the window
    leave the catalog and the new ones enter it; days before ``start`` are not touched. Replaced folders stay for
    readers that still use them. Other tables are written anew as a whole. ``fresh`` may read the table.
    """
    if partition_column(spark, table) != date_col:
        return switch_table(spark, table, replace_window(spark.table(table), fresh, date_col, start), base)
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    whole = replace_window(spark.table(table).limit(0), fresh, date_col, start)
    whole.write.mode("errorifexists").partitionBy(date_col).parquet(path)
    first = spark.range(1).select(day(start).cast("string").alias("first")).first()["first"]
    old = [v for v in partition_values(spark, table) if v >= first]
    written = spark.read.schema(whole.schema).parquet(path).select(F.col(date_col).cast("string").alias("day")).distinct()
    new = sorted(r["day"] for r in written.collect())  # a row per day of the window
    for value in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{date_col}` = '{value}')")
    if new:
        folders = " ".join(f"PARTITION (`{date_col}` = '{value}') LOCATION '{path}/{date_col}={value}'" for value in new)
        spark.sql(f"ALTER TABLE {table} ADD {folders}")
    spark.catalog.refreshTable(table)
    return path


def upsert_table(spark: SparkSession, table: str, rows: DataFrame, key: str, base: str) -> str | None:
    """Update-or-insert by key (see ``joins.upsert``); returns the folder of a table that was written as a whole.

    Of a table that is partitioned by one column, only the partitions that ``rows`` name are read, merged in a
    work folder below ``base``, and overwritten; none is touched without rows. The key must decide the partition:
    a key's old row is looked for in the partition of its new one. ``rows`` may read the table.
    """
    column = partition_column(spark, table)
    if column is None:
        return switch_table(spark, table, upsert(spark.table(table), rows, key), base)
    work = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    changed = staged(rows, f"{work}/rows")
    values = [r[0] for r in changed.select(column).distinct().collect()]  # at most the partitions of the table and new ones
    named = F.col(f"`{column}`").isin([v for v in values if v is not None])
    if None in values:
        named = named | F.col(f"`{column}`").isNull()
    if values:
        merged = staged(upsert(spark.table(table).filter(named), changed, key), f"{work}/merged")
        overwrite_partitions(spark, table, merged)
        spark.catalog.refreshTable(table)
    remove(spark, work)
    return None


def append_absent(spark: SparkSession, table: str, rows: DataFrame, key: str) -> None:
    fresh = insert_if_absent(spark.table(table), rows, key)
    for name in spark.table(table).columns:
        if name not in fresh.columns:
            fresh = fresh.withColumn(name, F.lit(None).cast(spark.table(table).schema[name].dataType))
    fresh.select(*spark.table(table).columns).write.insertInto(table)


def staged(df: DataFrame, path: str) -> DataFrame:
    """The frame as a table written to ``path``: computed once, read by several writers."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def commit_alerts(spark: SparkSession, new_rows: DataFrame, ledger: str, keys: list[str], batch_path: str,
                  runs_path: str, to_batch, to_ledger, to_run, run_id: str, work: str) -> None:
    """Writes the alert batch, the run record, and last the ledger, from one computation.

    ``work`` is a folder that all executors reach, for the rows until they are committed; it is removed
    at the end. When a run fails before the ledger is written, it is tried again under its ``run_id``: the
    run's own partition of the records is overwritten, so the run is recorded once. After that, the
    ledger keeps its rows out.
    """
    rows = staged(new_rows, f"{work.rstrip('/')}/run={run_id}")
    replace(to_batch(rows), batch_path)
    replace(to_run(rows), f"{runs_path.rstrip('/')}/run={run_id}")
    entries = anti_join(to_ledger(rows), spark.table(ledger), keys)
    entries.select(*spark.table(ledger).columns).write.insertInto(ledger)
    remove(spark, f"{work.rstrip('/')}/run={run_id}")

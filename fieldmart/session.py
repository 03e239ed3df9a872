"""Session settings the library relies on, and the files that Spark sees."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC because all time shifts are explicit; AQE for join re-planning and skew splitting.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call-site capture on every Column call costs more than planning a wide report.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "fieldmart", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings for a session somebody else made. A skewed join is also split where that
    costs another shuffle after it."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(key, SETTINGS[key])
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at the path, in whatever store it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below the path whose writer has finished."""
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(path)
    store = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(parent):
        return []
    names = [s.getPath().getName() for s in store.listStatus(parent) if s.isDirectory()]
    return sorted(n for n in names if store.exists(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}/_SUCCESS")))


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that the caller has written itself."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

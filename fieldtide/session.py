"""Session set-up and the shared scratch folder.

Nothing here is needed on a managed cluster whose session already carries its own
settings: every operator takes the session from its input DataFrame.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []
_TABLES: list[str] = []


def spark_session(app: str = "fieldtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as the session zone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, with its scheme as it is.

    Where that is unset the folder is below the warehouse, which executors share too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints, set on the context where it is not yet."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, removed when this program ends."""
    if not _WRITTEN:
        atexit.register(_remove, spark)
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the scratch folder and read it back.

    The rows are computed once, later reads can skip columns, and a lost executor loses nothing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Write ``df`` once in buckets of ``key``, below the scratch folder, and read it back as a table.

    Joins and groups by ``key`` then move none of its rows, whichever of its columns they take.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet")
    writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    _TABLES.append(table)
    return spark.table(table)


def _remove(spark: SparkSession) -> None:
    """Remove what was written, through Spark's own file systems; nothing to do once the session has ended."""
    try:
        for table in _TABLES:
            spark.sql(f"drop table if exists {table}")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _WRITTEN:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
    except Exception:  # noqa: BLE001 - the gateway is gone
        pass

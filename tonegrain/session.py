"""Session settings the engine relies on, and access to the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tonegrain") -> SparkSession:
    """A session for tests and the benchmark.  On a cluster, bring your own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def pin_file_splits(spark: SparkSession) -> None:
    """Fix how files are cut into splits for the life of the session.

    Unless it is set, the cut depends on the cores registered when a stage starts, so
    two scans of the same file in one plan could disagree while executors come and go.
    Line numbering reads a file twice and needs both scans to be cut alike.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is named, a local session gets a scratch folder; a cluster must name one,
    since a folder of one machine is lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tonegrain-"))
    return context.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table in the shared folder from now on.

    Spark then knows the size of a small side before it plans a join, and a lost executor costs a
    read, not the work behind it.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_limit(df: DataFrame) -> int:
    """Bytes below which Spark itself broadcasts a table."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())

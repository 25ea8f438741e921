"""Lines out of the rows of any table, and the stored chunk table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.functions.text import join_cells, join_non_blank
from tonegrain.operators.records import LIST_COLUMNS, RECORD_COLUMNS, RECORD_SCHEMA


def rows_to_lines(df: DataFrame, cells: list[str | Column], keep: list[str], *, keep_empty_cells: bool = True) -> DataFrame:
    """One line per row out of its cells; rows that give an empty line are dropped.

    ``keep_empty_cells`` is the rule for sheets (only NULL cells are left out); without it
    cells are stripped and blank ones dropped, the rule for delimited files.
    """
    join = join_cells if keep_empty_cells else join_non_blank
    return df.select(*keep, join(cells).alias("line")).filter(F.col("line") != "")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when a table comes in fewer splits than there are cores.

    Scoring is heavy per byte, so moving a small input pays off.  A large table has more
    splits than the cluster has cores and is returned as it is, without a shuffle.  The
    planned split count is an upper bound when row groups are large, hence the factor.
    Rows and values are the same either way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def read_records(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    """The chunk table, or one batch of it (only that batch's folder is read).

    Columns have the types of the table, whatever a batch is called; a table that nothing has
    been written to has no rows.
    """
    if not has_files(spark, path):
        table = spark.createDataFrame([], RECORD_SCHEMA)
    else:
        table = spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", False).parquet(path)
    table = table.select(*RECORD_COLUMNS)
    return table.filter(F.col("batch_id") == batch_id) if batch_id else table


def folder_of(spark: SparkSession, path: str):
    """File system and path object of a folder in any store Spark can reach."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and is not empty."""
    system, place = folder_of(spark, path)
    return bool(system.exists(place)) and len(system.listStatus(place)) > 0


def decode_lists(df: DataFrame) -> DataFrame:
    """List columns stored as JSON text, as arrays; NULL or malformed text gives []."""
    empty = F.array().cast("array<string>")
    return df.withColumns({
        c: F.coalesce(F.from_json(F.col(c), "array<string>"), empty) for c in LIST_COLUMNS if c in df.columns
    })

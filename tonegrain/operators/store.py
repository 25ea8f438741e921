"""Write the chunk table, exports and the archive."""

from __future__ import annotations

import re
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.operators.maintain import archive_split
from tonegrain.operators.records import ORDER_KEY, RECORD_COLUMNS, with_defaults
from tonegrain.sources.tables import folder_of, has_files, read_records


#: Batches that a filter names one by one; with more, all are read.
MOST_TOUCHED = 1000


def write_chunks(records: DataFrame, path: str) -> None:
    """Store records by batch.  A batch that has rows here is replaced, so a retry is safe.

    To replace a batch that may have no rows any more, use :func:`replace_batch`.

    The rebalance hint gives few, evenly sized files per batch: small batches share a
    task, a batch with a third of all rows is cut into many.
    """
    (
        records.hint("rebalance", "batch_id")
        .sortWithinPartitions("batch_id", "file_path", "chunk_index")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(path)
    )


def replace_batch(records: DataFrame, path: str, batch_id: str) -> None:
    """Store the records of one batch in place of what it had, also when there are none."""
    escape = records.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    rows = records.select(*[c for c in RECORD_COLUMNS if c != "batch_id"])
    rows.hint("rebalance").sortWithinPartitions("file_path", "chunk_index").write.mode("overwrite").parquet(
        f"{path}/batch_id={escape(batch_id)}")


def append_new(rows: DataFrame, path: str, by: list[str]) -> None:
    """Append the rows whose key the table does not hold yet, so a repeated job adds nothing twice."""
    spark = rows.sparkSession
    if has_files(spark, path):
        key = [*ORDER_KEY, "file_name"]
        there = spark.read.schema(rows.schema).parquet(path)
        # Only batches that the new rows belong to are read; their names are a partition column.
        touched = [r[0] for r in rows.select("batch_id").distinct().limit(MOST_TOUCHED + 1).collect()]
        if len(touched) <= MOST_TOUCHED:
            named = [b for b in touched if b is not None]
            there = there.where(F.col("batch_id").isin(named) | (F.col("batch_id").isNull() if None in touched else F.lit(False)))
        there = there.select(*[F.col(c).alias(f"_{c}") for c in key])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
        rows = rows.join(there, reduce(lambda a, b: a & b, same), "left_anti")
    rows.hint("rebalance", *by).sortWithinPartitions(*by, "file_path", "chunk_index").write.mode("append").partitionBy(*by).parquet(path)


def commit_rows(rows: DataFrame, path: str, query: str, number: int) -> None:
    """Add the rows of one micro-batch; the same micro-batch again takes the place of what it left before.

    The rows are written beside the table first.  Their files are then named after query and
    micro-batch and moved into the folders of their batches, and what an earlier attempt left there
    under that name goes.  Stored rows are not read, however many there are.
    """
    spark = rows.sparkSession
    fs, place = folder_of(spark, path)
    prefix = f"commit-{re.sub('[^A-Za-z0-9-]', '_', query)}-{number}-"
    staging = f"{path}/_staging-{prefix}"
    rows.hint("rebalance", "batch_id").sortWithinPartitions("batch_id", "file_path", "chunk_index").write.mode("overwrite").partitionBy("batch_id").parquet(staging)
    for batch in fs.listStatus(folder_of(spark, staging)[1]):
        if not batch.isDirectory():
            continue
        target = place.suffix("/" + batch.getPath().getName())
        fs.mkdirs(target)
        for old in fs.listStatus(target):
            if old.getPath().getName().startswith(prefix):
                fs.delete(old.getPath(), False)
        for new in fs.listStatus(batch.getPath()):
            name = new.getPath().getName()
            if not name.startswith((".", "_")) and not fs.rename(new.getPath(), target.suffix(f"/{prefix}{name}")):
                raise OSError(f"{name} could not be moved to {target}")
    fs.delete(folder_of(spark, staging)[1], True)


def append_chunks(rows: DataFrame, path: str) -> None:
    """Add single records to the table; missing columns take their defaults."""
    with_defaults(rows).write.mode("append").partitionBy("batch_id").parquet(path)


def write_csv(rows: DataFrame, path: str, *, single_file: bool = False) -> None:
    """Export as CSV with a header: part files in row order, or one file on request."""
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def archive(
    spark: SparkSession, live_path: str, archive_path: str, new_live_path: str,
    as_of: Column | datetime | str, days: int = 30,
) -> None:
    """Move rows older than the cutoff to the archive.

    The archive is written first, then the rest to a new live path; switch readers over
    to it afterwards.  A failure in between loses nothing.  The archive only grows: rows whose
    key it holds already are left out, so the same job can run again.
    """
    moved, kept = archive_split(read_records(spark, live_path), as_of, days)
    append_new(moved, archive_path, ["batch_id"])
    write_chunks(kept, new_live_path)


def read_archive(spark: SparkSession, archive_path: str) -> DataFrame:
    return read_records(spark, archive_path)

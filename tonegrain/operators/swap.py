"""Jobs that change stored batches in place, and can fail and run again.

The new content of the batches that change is written beside the table first.  One small file then
says that it is complete: until it is there, the table is the old one, and from then on whoever runs
next finishes the change.  Batches are swapped by renaming folders; no other batch is touched.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.operators.maintain import archive_split, dedup
from tonegrain.operators.records import ORDER_KEY
from tonegrain.sources.tables import folder_of, has_files, read_records

_MARK = "_swap-"


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, place = folder_of(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(place) if f.isDirectory()] if fs.exists(place) else []


def _escaped(spark: SparkSession, batch_id: str | None) -> str:
    util = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "batch_id=" + (util.DEFAULT_PARTITION_NAME() if batch_id is None else util.escapePathName(batch_id))


def publish(spark: SparkSession, contents: dict[str, DataFrame], job: str, touched: dict[str, list[str | None]]) -> None:
    """Replace the ``touched`` batches of each table (by its path) with its rows in ``contents``.

    The rows must belong to touched batches; a touched batch without rows goes.
    """
    staged = {}
    for path, rows in contents.items():
        folder = f"{path}/_staging-{job}"
        rows.hint("rebalance", "batch_id").sortWithinPartitions("batch_id", "file_path", "chunk_index").write.mode("overwrite").partitionBy("batch_id").parquet(folder)
        new = [f for f in _folders(spark, folder) if f.startswith("batch_id=")]
        staged[path] = {"new": new, "gone": [f for f in (_escaped(spark, b) for b in touched[path]) if f not in new]}
    first = next(iter(contents))
    _commit(spark, first, job, staged)
    finish(spark, first)


def _commit(spark: SparkSession, path: str, job: str, staged: dict[str, dict[str, list[str]]]) -> None:
    """The point of no return: a file that names all folders to swap appears in one step."""
    fs, written = folder_of(spark, f"{path}/_writing-{job}")
    out = fs.create(written, True)
    out.write(bytearray(json.dumps({"job": job, "tables": staged}), "utf-8"))
    out.close()
    fs.rename(written, folder_of(spark, f"{path}/{_MARK}{job}")[1])


def finish(spark: SparkSession, path: str) -> None:
    """Complete the changes that were published; nothing to do if none is open."""
    fs, place = folder_of(spark, path)
    if not fs.exists(place):
        return
    for status in fs.listStatus(place):
        if status.getPath().getName().startswith(_MARK):
            stream = fs.open(status.getPath())
            plan = json.loads(bytes(stream.readAllBytes()).decode())
            stream.close()
            for table, folders in plan["tables"].items():
                _swap(spark, table, plan["job"], folders["new"], folders["gone"])
            fs.delete(status.getPath(), False)


def _swap(spark: SparkSession, path: str, job: str, new: list[str], gone: list[str]) -> None:
    """Every step may have been done already."""
    fs, _ = folder_of(spark, path)
    at = lambda name: folder_of(spark, f"{path}/{name}")[1]
    fs.mkdirs(at(f"_old-{job}"))
    for folder in gone + new:
        target, old, fresh = at(folder), at(f"_old-{job}/{folder}"), at(f"_staging-{job}/{folder}")
        if folder in new and not fs.exists(fresh):
            continue
        if fs.exists(target):
            fs.rename(target, old)
        if folder in new:
            fs.rename(fresh, target)
    fs.delete(at(f"_staging-{job}"), True)
    fs.delete(at(f"_old-{job}"), True)


def _changed(before: DataFrame, after: DataFrame) -> list[str | None]:
    """Batches that have fewer rows after; their names only."""
    left = after.groupBy("batch_id").agg(F.count(F.lit(1)).alias("left")).withColumnRenamed("batch_id", "of")
    counts = before.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).join(left, F.col("batch_id").eqNullSafe(F.col("of")), "left")
    return [r[0] for r in counts.where("n > coalesce(left, 0)").select("batch_id").collect()]


def _of(rows: DataFrame, batches: list[str | None]) -> DataFrame:
    named = F.col("batch_id").isin([b for b in batches if b is not None])
    return rows.where(named | F.col("batch_id").isNull() if None in batches else named)


def dedup_stored(spark: SparkSession, path: str, job: str = "dedup") -> list[str | None]:
    """Drop repeated rows of the stored table (see :func:`dedup`); returns the batches that changed."""
    finish(spark, path)
    records = read_records(spark, path)
    kept = dedup(records)
    touched = _changed(records, kept)
    if touched:
        publish(spark, {path: _of(kept, touched)}, job, {path: touched})
    return touched


def archive_stored(
    spark: SparkSession, path: str, archive_path: str, as_of: Column | datetime | str, days: int = 30, job: str = "archive",
) -> list[str | None]:
    """Move rows older than the cutoff from the table to the archive, in place; returns the batches that changed.

    Either both tables change or, until the new content is complete, neither does.  Rows whose key the
    archive holds already are not added again.
    """
    finish(spark, path)
    moved, kept = archive_split(read_records(spark, path), as_of, days)
    touched = [r[0] for r in moved.select("batch_id").distinct().collect()]  # names of batches
    if not touched:
        return []
    moved = _of(moved, touched)
    archived = moved
    if has_files(spark, archive_path):
        there = _of(read_records(spark, archive_path), touched)
        key = [*ORDER_KEY, "file_name"]
        known = there.select(*[F.col(c).alias(f"_{c}") for c in key])
        same = F.lit(True)
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        archived = there.unionByName(moved.join(known, same, "left_anti"))
    publish(spark, {path: _of(kept, touched), archive_path: archived}, job, {path: touched, archive_path: touched})
    return touched

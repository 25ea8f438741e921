"""Deduplication and archiving of the chunk table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.operators.records import ORDER_KEY
from tonegrain.session import shared_table


def dedup(records: DataFrame, key: list[str] | None = None,
          group: tuple[str, str] = ("file_path", "chunk_text")) -> DataFrame:
    """Keep the earliest row per ``(file_path, chunk_text)``, across batches.

    Groups of several rows are found on narrow rows, with a 256-bit digest in the place of the
    text, and written with their smallest key; a group with a third of all rows sends one row per
    task.  Whole rows only meet this list: where it measures below Spark's threshold it is broadcast
    and no text is shuffled.  Rows equal in key and group are told apart by nothing, and one of
    them stays.
    """
    order = key or ORDER_KEY
    file_col, text_col = group
    digest = F.unhex(F.sha2(F.col(text_col), 256))
    rows = records.select(F.col(file_col).alias("_file"), digest.alias("_of"), F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)]).alias("_key"))
    counted = rows.groupBy("_file", "_of", "_key").agg(F.count(F.lit(1)).alias("_n"))
    groups = counted.groupBy("_file", "_of").agg(F.min_by(F.struct("_key", "_n"), "_key").alias("_first"), F.sum("_n").alias("_rows")).where("_rows > 1")
    repeated = shared_table(groups.select("_file", "_of", "_first._key", F.col("_first._n").alias("_ties")), "repeated-rows")
    ties = repeated.agg(F.max("_ties")).first()[0]
    if ties is None:
        return records
    keyed = records.withColumn("_digest", digest)
    own = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    met = keyed.join(repeated, F.col("_digest").eqNullSafe(F.col("_of")) & F.col(file_col).eqNullSafe(F.col("_file")), "left")
    stays = F.col("_ties").isNull() | own.eqNullSafe(F.col("_key"))
    if ties == 1:
        return met.where(stays).select(*records.columns)
    tied = met.where(own.eqNullSafe(F.col("_key")) & (F.col("_ties") > 1)).dropDuplicates(["_file", "_digest"])
    return met.where(stays & F.coalesce(F.col("_ties") == 1, F.lit(True))).unionByName(tied).select(*records.columns)


def cutoff(as_of: Column | datetime | str, days: int = 30) -> Column:
    """Midnight (session time zone, UTC) of ``as_of`` minus ``days``."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return F.date_trunc("day", moment) - F.make_dt_interval(F.lit(days))


def archive_split(records: DataFrame, as_of: Column | datetime | str, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """``(moved, kept)``: rows processed before the cutoff, and all others."""
    old = F.col("processed_at") < cutoff(as_of, days)
    return records.filter(old), records.filter(~F.coalesce(old, F.lit(False)))


def with_archive(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Live and archived rows together."""
    return live.unionByName(archive)

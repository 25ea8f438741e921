"""Job data, derived from the chunk table instead of being kept by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonegrain.operators.chunking import chunk_count
from tonegrain.operators.stats import statistics


def batch_summary(records: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row per batch and file: chunks, time span, status.

    ``files`` (batch_id, file_name, file_size, and file_path if names repeat) lists what was
    read; a file without chunks then shows up with 0 chunks and status "error".
    """
    key = ["batch_id", "file_path", "file_name"]
    done = records.groupBy(*key).agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.min("processed_at").alias("started_at"),
        F.max("processed_at").alias("completed_at"),
    )
    if files is not None:
        if "file_path" not in files.columns:
            files = files.withColumn("file_path", F.col("file_name"))
        first = files.groupBy(*key).agg(F.min("file_size").alias("file_size"))
        done = first.join(done, key, "left").withColumn(
            "total_chunks", F.coalesce("total_chunks", F.lit(0))
        )
    empty = F.col("total_chunks") == 0
    return done.withColumns({
        "status": F.when(empty, F.lit("error")).otherwise(F.lit("completed")),
        "error_message": F.when(empty, F.lit("File produced 0 chunks")),
    })


def batch_progress(records: DataFrame, line_counts: DataFrame) -> DataFrame:
    """Scored chunks against the chunks expected from the line counts, per batch.

    ``line_counts`` holds (batch_id, file_name, total_lines).
    """
    expected = line_counts.groupBy("batch_id").agg(
        F.sum(chunk_count("total_lines")).alias("expected_chunks")
    )
    done = records.groupBy("batch_id").agg(F.count(F.lit(1)).alias("completed_chunks"))
    completed = F.coalesce("completed_chunks", F.lit(0))
    return expected.join(done, "batch_id", "left").select(
        "batch_id", "expected_chunks", completed.alias("completed_chunks"),
        F.when(F.col("expected_chunks") == 0, F.lit(0))
        .otherwise(F.floor(completed / F.col("expected_chunks") * 100)).cast("long").alias("percent"),
        F.when(F.col("expected_chunks") == 0, F.lit("error"))
        .when(completed >= F.col("expected_chunks"), F.lit("completed"))
        .otherwise(F.lit("processing")).alias("status"),
    )


def batch_report(records: DataFrame, batch_id: str | None = None) -> DataFrame:
    """A short report text: totals, average score, label counts."""
    stats = statistics(records, batch_id=batch_id)
    body = F.format_string(
        "Batch ID: %s\nTotal Chunks: %d\nAverage Sentiment Score: %.4f\n"
        "Positive: %d\nNegative: %d\nNeutral: %d",
        F.lit(batch_id or "N/A"), "total_chunks", F.coalesce(F.round("avg_score", 4), F.lit(0.0)),
        *[F.coalesce(c, F.lit(0)) for c in ("positive_count", "negative_count", "neutral_count")],
    )
    return stats.select(F.lit(batch_id or "N/A").alias("batch_id"), body.alias("report"))

"""The usual jobs in one call each: load, chunk, score and store files; statistics of a batch."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators import dashboard, stats
from tonegrain.operators.jobs import batch_summary
from tonegrain.operators.records import chunk_records
from tonegrain.operators.search import search
from tonegrain.operators.store import replace_batch
from tonegrain.sources.lines import WHOLE_FILE_LIMIT, file_list, read_chunks
from tonegrain.sources.tables import read_records


def score_files(
    spark: SparkSession, paths: str | Sequence[str], batch_id: str, fmt: str | None = None, *,
    processed_at: datetime | None = None, encoding: str = "UTF-8", whole_file_limit: int = WHOLE_FILE_LIMIT,
    lexicon: Lexicon = DEFAULT_LEXICON, **options,
) -> DataFrame:
    """Scored chunk records of files.  All rows of a batch carry one processing time (UTC)."""
    moment = processed_at or datetime.now(timezone.utc)
    chunks = read_chunks(spark, paths, fmt, encoding=encoding, whole_file_limit=whole_file_limit)
    return chunk_records(
        chunks.withColumns({"batch_id": F.lit(batch_id), "processed_at": F.lit(moment)}), lexicon, **options
    )


def process_files(
    spark: SparkSession, paths: str | Sequence[str], table_path: str, batch_id: str | None = None,
    fmt: str | None = None, **options,
) -> DataFrame:
    """Load, chunk, score and store files as one batch; returns the summary of the batch.

    Repeating the call with the same ``batch_id`` replaces the batch, also when it has no chunks now.
    """
    batch = batch_id or str(uuid.uuid4())
    replace_batch(score_files(spark, paths, batch, fmt, **options), table_path, batch)
    files = file_list(spark, paths).select(F.lit(batch).alias("batch_id"), "file_path", "file_name", "file_size")
    return batch_summary(read_records(spark, table_path, batch), files)


@dataclass(frozen=True)
class BatchStats:
    """All panels of a statistics page; each is a DataFrame that reads only its columns."""

    statistics: DataFrame
    patterns: DataFrame
    top_positive_words: DataFrame
    top_negative_words: DataFrame
    top_domains: DataFrame
    labels: DataFrame
    histogram: DataFrame
    trend: DataFrame
    domains: DataFrame


def batch_stats(records: DataFrame, batch_id: str | None = None) -> BatchStats:
    rows = search(records, batch_id=batch_id)
    return BatchStats(
        statistics=stats.statistics(rows),
        patterns=stats.pattern_frequency(rows),
        top_positive_words=stats.top_words(rows, "positive"),
        top_negative_words=stats.top_words(rows, "negative"),
        top_domains=stats.top_domains(rows),
        labels=dashboard.label_distribution(rows),
        histogram=dashboard.score_histogram(rows),
        trend=dashboard.score_trend(rows),
        domains=dashboard.domain_frequency(rows),
    )

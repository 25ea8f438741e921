"""Score files as they arrive, with the same expressions as in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.chunking import explode_chunks
from tonegrain.operators.records import RECORD_COLUMNS, chunk_records
from tonegrain.operators.stats import mean_score
from tonegrain.operators.store import commit_rows
from tonegrain.session import checkpoint_dir
from tonegrain.sources.formats import FORMATS


def arriving_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream with one row per new file: file_path, file_name, file_size, content, arrived_at.

    A file is one row, so it must stay below 2 GB; score larger ones with ``score_files``.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.make_valid_utf8("value").alias("content"),
    )


def score_stream(
    files: DataFrame, batch_id: Column, fmt: str = "text", lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Chunk records of arriving files.  Chunking and scoring stay inside the file's row,
    so the stream keeps no state and gives exactly what a batch over the files gives."""
    batched = files.withColumns({"batch_id": batch_id, "processed_at": F.col("arrived_at")})
    chunks = explode_chunks(
        batched, FORMATS[fmt].whole(F.col("content")), ["batch_id", *[c for c in ("file_path", "file_name") if c in files.columns], "processed_at"]
    )
    return chunk_records(chunks, lexicon)


def with_progress(records: DataFrame, observation: str = "progress") -> DataFrame:
    """Report chunks and words of every micro-batch with the query's progress events."""
    return records.observe(
        observation, F.count(F.lit(1)).alias("chunks"), F.sum("word_count").alias("words")
    )


def start_append(records: DataFrame, path: str, name: str, **trigger) -> StreamingQuery:
    """Append scored records to the chunk table; progress is kept in the shared checkpoint folder.

    A micro-batch is committed under the name of the query and its own number: one that runs again
    after a failure replaces what it left, and no stored row is read.  The table can be filled by
    streams and by batch jobs alike.
    """
    spark = records.sparkSession
    return (
        records.writeStream.foreachBatch(lambda rows, number: commit_rows(rows.select(*RECORD_COLUMNS), path, name, number))
        .option("checkpointLocation", f"{checkpoint_dir(spark)}/{name}")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def score_by_window(records: DataFrame, width: str, late: str | None = None) -> DataFrame:
    """Average score per time window and file; ``late`` sets the watermark of a stream."""
    rows = records.withWatermark("processed_at", late) if late else records
    return (
        rows.groupBy(F.window("processed_at", width).alias("w"), "file_name")
        .agg(F.count(F.lit(1)).alias("n"), mean_score().alias("avg_score"))
        .select(F.col("w.start").alias("window_start"), "file_name", "n", "avg_score")
    )


def drop_repeats(records: DataFrame, late: str) -> DataFrame:
    """Drop repeated ``(file_name, chunk_text)`` rows of a stream within the watermark.

    The state keeps a 256-bit digest instead of the text.
    """
    return (
        records.withColumn("_digest", F.sha2("chunk_text", 256))
        .withWatermark("processed_at", late)
        .dropDuplicatesWithinWatermark(["file_name", "_digest"])
        .drop("_digest")
    )

"""Chunk tables derived from the given tables, as input of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tonegrain.functions.text import clean_lines, html_sentences
from tonegrain.operators.chunking import assemble_chunks, explode_chunks
from tonegrain.operators.numbering import number_lines
from tonegrain.operators.records import chunk_records, line_records
from tonegrain.operators.unnest import each
from tonegrain.sources.tables import spread

# Phrase parts of the feedback lines, picked by remainders of event_id.
SUBJECTS = ["the community service", "delivery from our bank", "my doctor", "student support", "climate report"]
VERBS = [None, "was not", "is", "never", "without", None, "isn't"]
FIRST_MODIFIERS = [None, "very", "slightly", "kind of", "extremely", None, "a bit", "barely"]
SECOND_MODIFIERS = [None, "really", None, "somewhat", None, "so"]
OPINIONS = ["good", "terrible", "excellent", "slow", "fraud", "happy", "broken", "fine", "reliable", "worst", "love", "late"]
ENDINGS = [".", "! call 555-123-4567", "? see https://x.example.org/a", "at 12/05/2024 for $1,200.50",
           "mail ops@example.com #refund", "@team 45% off", "URGENT"]
PHRASE_PARTS = [(SUBJECTS, 1), (VERBS, 1), (FIRST_MODIFIERS, 3), (SECOND_MODIFIERS, 5), (OPINIONS, 2), (ENDINGS, 1)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of feedback per event: file per event type, batch per user group."""
    event = F.col("event_id")

    def pick(words: list[str | None], divisor: int):
        n = F.floor(event / divisor) % len(words)
        return F.get(F.array(*[F.lit(w) for w in words]), n.cast("int"))

    return spread(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts")).select(
        "event_id", "event_type",
        F.concat(F.lit("feed_"), "event_type", F.lit(".log")).alias("file_name"),
        F.concat(F.lit("b"), (F.col("user_id") % 4).cast("string")).alias("batch_id"),
        F.concat_ws(" ", *[pick(words, divisor) for words, divisor in PHRASE_PARTS]).alias("line"),
        "ts",
    )


def feedback_lines_scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Line granularity: one record per event, no shuffle."""
    lines = feedback(spark, sf_dir).select(
        "batch_id", "file_name", F.col("event_id").alias("chunk_index"), "line", F.col("ts").alias("processed_at")
    )
    return line_records(lines, **options)


def feedback_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_lines(feedback(spark, sf_dir), ["batch_id", "file_name"], "event_id")


def feedback_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk granularity: a file per batch and event type, processed at its chunk's last event."""
    return assemble_chunks(
        feedback_numbered(spark, sf_dir), ["batch_id", "file_name"], {"processed_at": F.max("ts")}
    )


def feedback_chunks_scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return chunk_records(feedback_chunks(spark, sf_dir), **options)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a file of its own; its source is the batch."""
    doc = F.col("doc_id")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        F.col("source").alias("batch_id"),
        F.format_string("doc_%010d.txt", doc).alias("file_name"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((doc % 60).cast("int"))).alias("processed_at"),
        "doc_id", "text",
    )


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of a document come out of its own row: no shuffle."""
    return explode_chunks(
        documents(spark, sf_dir), clean_lines("text"), ["batch_id", "file_name", "processed_at", "doc_id"]
    )


def document_chunks_scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return chunk_records(document_chunks(spark, sf_dir), **options)


def conversation_lines_scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """One record per turn; a conversation is a batch, a role a file."""
    turns = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return line_records(turns.select(
        F.col("conv_id").cast("string").alias("batch_id"), F.col("role").alias("file_name"), F.col("turn").alias("chunk_index"),
        F.coalesce("text", F.lit("")).alias("line"), F.lit("2024-01-01").cast("timestamp").alias("processed_at")), **options)


def page_sentences_scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """One record per sentence of a page; a page is a file."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    sentences = each(pages, ["page_id"], html_sentences("html"), "line", "chunk_index")
    return line_records(sentences.select(
        F.lit("pages").alias("batch_id"), F.format_string("page_%010d.html", "page_id").alias("file_name"),
        F.col("chunk_index").cast("long").alias("chunk_index"), "line", F.lit("2024-01-01").cast("timestamp").alias("processed_at")), **options)

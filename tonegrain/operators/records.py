"""The chunk table: one scored record per chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.functions.scoring import score_text
from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.unnest import each_struct

RECORD_COLUMNS = [
    "batch_id", "file_path", "file_name", "chunk_index", "chunk_text", "sentiment_score", "sentiment_label",
    "positive_words", "negative_words", "tags", "pattern_matches", "word_count", "char_count",
    "processed_at",
]
LIST_COLUMNS = ["positive_words", "negative_words", "tags", "pattern_matches"]

# How the table is stored.  It is always read with these types: a batch "007" is no number.
RECORD_SCHEMA = (
    "file_path string, file_name string, chunk_index long, chunk_text string, sentiment_score double, "
    "sentiment_label string, positive_words array<string>, negative_words array<string>, tags array<string>, "
    "pattern_matches array<string>, word_count int, char_count int, processed_at timestamp, batch_id string"
)

# Insertion order of the table: every ordered query uses the whole key.  Files are told apart
# by their path; files of one name in many folders are the normal case.
ORDER_KEY = ["processed_at", "batch_id", "file_path", "chunk_index"]

ERROR_TEXT = "[processing error]"


def chunk_records(
    chunks: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, *, corrupt: Column | None = None,
    with_details: bool = False, **options,
) -> DataFrame:
    """Score ``chunk_text``; the record keeps the whole text.

    Needs batch_id, file_name, chunk_index, chunk_text and processed_at; without a file_path
    the name stands for it.  Rows for which
    ``corrupt`` holds become error records: neutral, tagged "error", counts 0.
    ``with_details`` also keeps raw_score and negated_words.
    """
    if "file_path" not in chunks.columns:
        chunks = chunks.withColumn("file_path", F.col("file_name"))
    source = chunks if corrupt is None else chunks.withColumn("_corrupt", F.coalesce(corrupt, F.lit(False)))
    scored = score_text(source, "chunk_text", lexicon, **options)
    columns = RECORD_COLUMNS + (["raw_score", "negated_words"] if with_details else [])
    if corrupt is None:
        return scored.select(*columns)
    none = F.array().cast("array<string>")
    blank = {
        "chunk_text": F.lit(ERROR_TEXT), "sentiment_score": F.lit(0.0), "sentiment_label": F.lit("neutral"),
        "positive_words": none, "negative_words": none, "tags": F.array(F.lit("error")),
        "pattern_matches": none, "word_count": F.lit(0), "char_count": F.lit(0),
        "raw_score": F.lit(0.0), "negated_words": none,
    }
    return scored.select(*[
        F.when(F.col("_corrupt"), blank[c]).otherwise(F.col(c)).alias(c) if c in blank else F.col(c)
        for c in columns
    ])


def filterable(records: DataFrame) -> DataFrame:
    """The same rows, with scores that are finished before any filter looks at them.

    A filter on a score that is still an expression would be planned as a second run of the
    scorer, below everything else.  For freshly scored rows; a stored table needs no such step.
    """
    return each_struct(records, [], F.array(F.struct(*[F.col(c) for c in records.columns])), "chunk_index")


def line_records(
    lines: DataFrame, line_col: str = "line", lexicon: Lexicon = DEFAULT_LEXICON, **options,
) -> DataFrame:
    """Line granularity: every line is its own chunk, so nothing is grouped or shuffled."""
    return chunk_records(lines.withColumnRenamed(line_col, "chunk_text"), lexicon, **options)


def with_defaults(rows: DataFrame) -> DataFrame:
    """Fill the columns a partial record may lack, as the chunk table defines them."""
    defaults = {
        "sentiment_score": F.lit(0.0), "sentiment_label": F.lit("neutral"),
        "word_count": F.lit(0), "char_count": F.lit(0),
        **{c: F.array().cast("array<string>") for c in LIST_COLUMNS},
        "batch_id": F.lit(None).cast("string"), "processed_at": F.current_timestamp(),
    }
    out = rows if "file_path" in rows.columns else rows.withColumn("file_path", F.col("file_name"))
    for name, value in defaults.items():
        if name not in rows.columns:
            out = out.withColumn(name, value)
        elif name != "batch_id":
            out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out.select(*RECORD_COLUMNS)

"""Chart data over the chunk table: real counts, each out of one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.functions.text import as_column
from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.numbering import number_lines
from tonegrain.operators.stats import mean_score

LABELS = ("positive", "negative", "neutral")

# Fixed buckets: name, lower bound.  A bucket takes its lower bound, except the last,
# which starts above 0.6.
HISTOGRAM = (
    ("< -0.6", None), ("-0.6 to -0.3", -0.6), ("-0.3 to 0", -0.3),
    ("0 to 0.3", 0.0), ("0.3 to 0.6", 0.3), ("> 0.6", 0.6),
)


def _counts_as_rows(df: DataFrame, tests: dict[str, Column], name: str) -> DataFrame:
    """Count each test in one aggregate and turn the counts into rows; zeros are kept."""
    counted = df.agg(*[
        F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).alias(f"c{i}")
        for i, test in enumerate(tests.values())
    ])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(key).alias(name), F.col(f"c{i}").alias("n"))
        for i, key in enumerate(tests)
    ])
    return counted.select(F.inline(rows))


def label_distribution(records: DataFrame) -> DataFrame:
    tests = {label: F.col("sentiment_label") == label for label in LABELS}
    rows = _counts_as_rows(records, tests, "sentiment_label")
    # Three rows; the total is theirs.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return rows.select("sentiment_label", "n", F.round(F.col("n") / total * 100, 1).alias("pct"))


def histogram_bucket(score: Column | str) -> Column:
    s = as_column(score)
    out = F.when(s > HISTOGRAM[-1][1], F.lit(len(HISTOGRAM) - 1))
    for position in range(len(HISTOGRAM) - 2, 0, -1):
        out = out.when(s >= HISTOGRAM[position][1], F.lit(position))
    return out.when(s.isNotNull(), F.lit(0))


def score_histogram(records: DataFrame) -> DataFrame:
    bucketed = records.select(histogram_bucket("sentiment_score").alias("b"))
    tests = {name: F.col("b") == i for i, (name, _) in enumerate(HISTOGRAM)}
    return _counts_as_rows(bucketed, tests, "bucket")


def domain_frequency(records: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    tests = {d: F.array_contains("tags", d) for d in lexicon.domains}
    return _counts_as_rows(records, tests, "domain").select("domain", "n")


def score_trend(records: DataFrame, points: int = 20) -> DataFrame:
    """Average score at ``points`` positions along the files of each batch.

    A chunk's position is its rank within its file, gaps in the index closed, so a file
    of n chunks gives ceil(n / points) chunks to each point.  Chunks are ranked in pieces:
    neither a large file nor a batch with a third of all rows meets in one task.
    """
    # Numbering takes no NULL: rows without a batch are a batch of their own.
    narrow = records.select(
        F.coalesce("batch_id", F.lit("")).alias("_batch"), F.col("batch_id").isNull().alias("_none"),
        F.coalesce("file_path", "file_name", F.lit("")).alias("file_path"), "chunk_index", "sentiment_score")
    width = F.ceil(F.col("total_lines") / points)
    return (
        number_lines(narrow, ["_none", "_batch", "file_path"], "chunk_index")
        .groupBy(F.when(~F.col("_none"), F.col("_batch")).alias("batch_id"), F.floor(F.col("line_no") / width).cast("int").alias("point"))
        .agg(
            F.min("line_no").alias("first_chunk"),
            F.count(F.lit(1)).alias("n"),
            mean_score().alias("avg_score"),
        )
    )


def fixed(value: Column, decimals: int) -> Column:
    """A number with a fixed count of decimals, rounded by its exact binary value, exact
    halves away from zero."""
    size = F.abs(value).cast("double")
    # Only multiples of a power of two can be exact halves; a nudge decides those.
    half = (size * 2 ** (decimals + 1)) % 1 == 0
    nudged = F.when(half, size + 10.0 ** -(decimals + 4)).otherwise(size)
    text = F.replace(F.format_number(nudged, decimals), F.lit(","), F.lit(""))
    return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)


def score_text_form(score: Column | str) -> Column:
    """Sign and three decimals."""
    s = as_column(score)
    return F.concat(F.when(s >= 0, F.lit("+")).otherwise(F.lit("")), fixed(s, 3))


def gauge_percent(score: Column | str) -> Column:
    """Position of a score on a 0-100 gauge, one decimal."""
    return fixed((as_column(score) + 1) / 2 * 100, 1).cast("double")


def bytes_text(n_bytes: Column | str) -> Column:
    n = as_column(n_bytes)
    return (
        F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
        .when(n < 1024 ** 2, F.concat(fixed(n / 1024, 1), F.lit(" KB")))
        .otherwise(F.concat(fixed(n / 1024 ** 2, 2), F.lit(" MB")))
    )


def duration_text(millis: Column | str) -> Column:
    ms = as_column(millis)
    return (
        F.when(ms < 1000, F.concat(fixed(ms, 0), F.lit(" ms")))
        .otherwise(F.concat(fixed(ms / 1000, 2), F.lit(" s")))
    )

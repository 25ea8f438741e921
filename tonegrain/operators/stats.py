"""Statistics and frequencies over the chunk table.  One scan each, partial aggregation first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.records import ORDER_KEY
from tonegrain.operators.topn import top_n
from tonegrain.operators.unnest import each, each_struct

# ASCII words of three or more letters; the border is ASCII too.
KEYWORD_PATTERN = r"(?<![A-Za-z0-9_])[a-z]{3,}+(?![A-Za-z0-9_])"


def mean_score(col: str = "sentiment_score") -> Column:
    """Average of scores kept to four decimals.

    They are added up as whole numbers, so the result does not depend on the order in
    which tasks finish; a sum of doubles would.  NULL for no rows.
    """
    return F.try_divide(F.sum(F.round(F.col(col) * 10_000).cast("long")), F.count(col)) / 10_000


def _count_label(label: str) -> Column:
    # sum, not count_if: no rows must give NULL.
    return F.sum(F.when(F.col("sentiment_label") == label, 1).otherwise(0))


def statistics(records: DataFrame, by: list[str] | None = None, batch_id: str | None = None) -> DataFrame:
    """Counts, score range, words and labels; for all rows, one batch, or per group."""
    rows = records if not batch_id else records.filter(F.col("batch_id") == batch_id)
    return rows.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_chunks"),
        mean_score().alias("avg_score"),
        F.max("sentiment_score").alias("max_score"),
        F.min("sentiment_score").alias("min_score"),
        F.coalesce(F.sum("word_count"), F.lit(0)).alias("total_words"),
        _count_label("positive").alias("positive_count"),
        _count_label("negative").alias("negative_count"),
        _count_label("neutral").alias("neutral_count"),
    ).withColumn("total_lines", F.col("total_chunks"))


def summary(records: DataFrame) -> DataFrame:
    """Rounded statistics with label percentages; no row for empty input."""
    stats = statistics(records)

    def percent(count: str) -> Column:
        return F.round(F.col(count) / F.col("total_chunks") * 100, 1)

    return stats.filter(F.col("total_chunks") > 0).select(
        "total_chunks",
        *[F.round(c, 4).alias(c) for c in ("avg_score", "max_score", "min_score")],
        "positive_count", "negative_count", "neutral_count",
        percent("positive_count").alias("positive_pct"),
        percent("negative_count").alias("negative_pct"),
        percent("neutral_count").alias("neutral_pct"),
    )


def frequency(records: DataFrame, list_col: str, name: str) -> DataFrame:
    """Chunks per element of a list column (lists are distinct within a chunk)."""
    return (
        each(records, [], list_col, name)
        .groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    )


def most_common(counts: DataFrame, name: str, k: int) -> DataFrame:
    """Top k by count; ties by name, so that the answer does not depend on row order."""
    return counts.orderBy(F.desc("n"), F.asc(name)).limit(k)


def pattern_frequency(records: DataFrame) -> DataFrame:
    return frequency(records, "pattern_matches", "pattern")


def top_words(records: DataFrame, polarity: str, k: int = 10) -> DataFrame:
    """Words found in most chunks; ``polarity`` is "positive" or "negative"."""
    return most_common(frequency(records, f"{polarity}_words", "word"), "word", k)


def top_domains(records: DataFrame, k: int = 5) -> DataFrame:
    return most_common(frequency(records, "tags", "domain"), "domain", k)


def pattern_bars(records: DataFrame, k: int = 8) -> DataFrame:
    """Top patterns with their bar width relative to the most common one."""
    top = most_common(pattern_frequency(records), "pattern", k)
    # At most k rows are left, gathered by the limit; the largest count is among them.
    rows = top.agg(F.collect_list(F.struct("pattern", "n")).alias("rows"), F.max("n").alias("most"))
    return rows.select(F.inline("rows"), F.col("most")).select(
        "pattern", "n", F.round(F.col("n") / F.col("most") * 100, 1).alias("width_pct")
    )


def word_panel(records: DataFrame, k: int = 8) -> DataFrame:
    """The top words of both polarities, out of one scan."""
    both = F.concat(
        F.transform("positive_words", lambda w: F.struct(F.lit("positive").alias("polarity"), w.alias("word"))),
        F.transform("negative_words", lambda w: F.struct(F.lit("negative").alias("polarity"), w.alias("word"))),
    )
    counts = each_struct(records, [], both, "word").groupBy("polarity", "word").agg(F.count(F.lit(1)).alias("n"))
    # One row per lexicon word is left here, so ranking inside a polarity is small.
    rank = F.row_number().over(Window.partitionBy("polarity").orderBy(F.desc("n"), F.asc("word")))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def ascii_words(text_col: str) -> Column:
    """Every word of three or more ASCII letters in lower case, as a list."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(KEYWORD_PATTERN), F.lit(0))


def keyword_counts(
    records: DataFrame, text_col: str = "chunk_text", lexicon: Lexicon = DEFAULT_LEXICON,
    newest_n: int | None = None,
) -> DataFrame:
    """Occurrences of every word of three or more ASCII letters that is no stopword.

    All rows count by default; ``newest_n`` restricts to the newest rows of the table.
    """
    rows = records if newest_n is None else top_n(records, [F.desc(c) for c in ORDER_KEY], newest_n)
    return (
        each(rows, [], ascii_words(text_col), "word")
        .filter(~F.col("word").isin(*sorted(lexicon.stopwords)))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


def keywords(records: DataFrame, k: int = 80, **options) -> DataFrame:
    return most_common(keyword_counts(records, **options), "word", k)

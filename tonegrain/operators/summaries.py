"""Statistics kept for each stored batch, so that questions about all batches read no chunk.

Two narrow tables lie beside the chunk table, with a folder for each batch: ``statistics`` has one row of
sums that add up, ``counts`` has how often each word, pattern, domain and keyword occurs, sorted by
kind and word.  Both are partial aggregates: those of several batches merge by adding.  A batch that
changes is summed up again, alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.search import suggest
from tonegrain.operators.stats import ascii_words, most_common
from tonegrain.operators.unnest import each
from tonegrain.session import shared_table
from tonegrain.sources.tables import folder_of, has_files

SUMS = "total_chunks long, scores long, scored long, max_score double, min_score double, total_words long, positive long, negative long, neutral long"
COUNTS = "kind string, word string, n long"
#: Kinds of counts, with the list of a record that they count; keywords are cut out of the text.
LISTS = {"positive": "positive_words", "negative": "negative_words", "pattern": "pattern_matches", "domain": "tags"}
#: The kind of the digests of records, while words are counted.
_RECORD = "record"


def _digest() -> Column:
    """What the sums need of a record, as a word."""
    return F.concat_ws("\0", F.lit(_RECORD), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("sentiment_score", "word_count", "sentiment_label")])


def _sums(digests: DataFrame) -> DataFrame:
    """SUMS of each batch out of (batch_id, word, n): each digest and how many records have it."""
    part = F.split("word", "\0")
    rows = digests.select("batch_id", "n", F.nullif(part[0], F.lit("")).cast("double").alias("score"), F.nullif(part[1], F.lit("")).cast("long").alias("words"), part[2].alias("label"))
    label = lambda name: F.sum(F.when(F.col("label") == name, F.col("n")).otherwise(0))
    return rows.groupBy("batch_id").agg(
        F.sum("n").alias("total_chunks"), F.sum(F.round(F.col("score") * 10_000).cast("long") * F.col("n")).alias("scores"),
        F.sum(F.when(F.col("score").isNotNull(), F.col("n")).otherwise(0)).alias("scored"), F.max("score").alias("max_score"), F.min("score").alias("min_score"),
        F.sum(F.col("words") * F.col("n")).alias("total_words"), label("positive").alias("positive"), label("negative").alias("negative"), label("neutral").alias("neutral"))


def summarise(records: DataFrame, path: str, lexicon: Lexicon = DEFAULT_LEXICON) -> None:
    """Write the summaries of all batches that ``records`` holds rows of, in place of those they had.

    ``records`` must be complete for each batch it touches.
    """
    empty = F.array().cast("array<string>")
    named = lambda kind, words: F.transform(words, lambda w: F.concat(F.lit(f"{kind}\0"), w))
    lists = [named(kind, F.coalesce(F.col(c), empty)) for kind, c in LISTS.items()]
    # One pass over the records for all kinds and the sums, which may have to be scored first.  What is counted is plain
    # words, the kind in front of all but keywords, and each count is added up before it is shuffled.
    words = each(records, ["batch_id"], F.concat(F.array(_digest()), *lists, ascii_words("chunk_text")), "word")
    words = words.where(~F.col("word").isin(*sorted(lexicon.stopwords)))
    place = F.instr("word", "\0")
    kind = F.when(place == 0, F.lit("keyword")).otherwise(F.left("word", place - 1))
    counted = shared_table(words.groupBy("batch_id", "word").agg(F.count(F.lit(1)).alias("n")).select(
        "batch_id", kind.alias("kind"), F.expr("substring(word, instr(word, '\\0') + 1)").alias("word"), "n"), "counted")
    sums, counts = _sums(counted.where(F.col("kind") == _RECORD)), counted.where(F.col("kind") != _RECORD)
    for name, rows, order in (("statistics", sums, []), ("counts", counts, ["kind", "word"])):
        rows.hint("rebalance", "batch_id").sortWithinPartitions("batch_id", *order).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/{name}")


def forget(spark: SparkSession, path: str, batches: list[str | None]) -> None:
    """Remove the summaries of batches that are no longer stored."""
    util = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for batch in batches:
        folder = "batch_id=" + (util.DEFAULT_PARTITION_NAME() if batch is None else util.escapePathName(batch))
        for name in ("statistics", "counts"):
            fs, place = folder_of(spark, f"{path}/{name}/{folder}")
            fs.delete(place, True)


def refresh(records: DataFrame, path: str, batches: list[str | None], lexicon: Lexicon = DEFAULT_LEXICON) -> None:
    """Sum up the given batches of the stored table again, after they were replaced, deduplicated or archived.

    Only these batches are read.  Their names are listed one by one, as the jobs that change batches return them.
    """
    named = F.col("batch_id").isin([b for b in batches if b is not None])
    rows = records.where(named | F.col("batch_id").isNull() if None in batches else named)
    forget(records.sparkSession, path, batches)
    summarise(rows, path, lexicon)


def _read(spark: SparkSession, path: str, name: str, schema: str, batch_id: str | None) -> DataFrame:
    if not has_files(spark, f"{path}/{name}"):
        return spark.createDataFrame([], f"{schema}, batch_id string")
    table = spark.read.schema(f"{schema}, batch_id string").parquet(f"{path}/{name}")
    return table.where(F.col("batch_id") == batch_id) if batch_id else table


def kept_statistics(spark: SparkSession, path: str, by: list[str] | None = None, batch_id: str | None = None) -> DataFrame:
    """What ``stats.statistics`` gives over the chunks, for all batches, each (``by=["batch_id"]``) or one."""
    add = lambda name: F.sum(name)
    return _read(spark, path, "statistics", SUMS, batch_id).groupBy(*(by or [])).agg(
        F.coalesce(add("total_chunks"), F.lit(0)).alias("total_chunks"), (F.try_divide(add("scores"), add("scored")) / 10_000).alias("avg_score"),
        F.max("max_score").alias("max_score"), F.min("min_score").alias("min_score"), F.coalesce(add("total_words"), F.lit(0)).alias("total_words"),
        add("positive").alias("positive_count"), add("negative").alias("negative_count"), add("neutral").alias("neutral_count"),
    ).withColumn("total_lines", F.col("total_chunks"))


def kept_counts(spark: SparkSession, path: str, kind: str, name: str = "word", batch_id: str | None = None, test: Column | None = None) -> DataFrame:
    """(``name``, n): how often each word of a kind occurs, in all batches or one; ``test`` looks at ``word``.

    The table is sorted by kind and word, so a test on either reads few row groups.
    """
    rows = _read(spark, path, "counts", COUNTS, batch_id).where(F.col("kind") == kind)
    return (rows if test is None else rows.where(test)).groupBy(F.col("word").alias(name)).agg(F.sum("n").alias("n"))


def kept_top(spark: SparkSession, path: str, kind: str, k: int, name: str = "word", batch_id: str | None = None) -> DataFrame:
    """The most frequent words of a kind; ties by word."""
    return most_common(kept_counts(spark, path, kind, name, batch_id), name, k)


def completions(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """What ``search.suggest`` offers for what was typed so far, out of the kept counts of that prefix alone."""
    start = prefix.strip().lower()
    return suggest(kept_counts(spark, path, "keyword", test=F.col("word").startswith(start)), prefix)

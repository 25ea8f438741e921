"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tonegrain.llm.common import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.language import identify

    return identify(_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tonegrain.llm.bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.ngram_join import near_duplicate_groups

    return near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.line_dedup import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), removed="n_removed")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.mixing import mix

    units = mix(_table(spark, sf_dir, "documents"))
    rows = units.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op6_vector_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.vector_join import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"), 0.9)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.decision_list import judge, learn

    docs = _table(spark, sf_dir, "documents")
    rules = learn(docs, _table(spark, sf_dir, "labels"))
    return judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tonegrain.llm.records import token_records

    return token_records(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.shards import shard, shard_of

    text = F.coalesce(F.col("record.text"), F.lit(""))
    fields = [F.col("record.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]
    rows = shard(_table(spark, sf_dir, "documents").select("doc_id", "text"), 16, fields)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        shard_of("doc_id", 17).alias("grown_shard"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.warc import archive_pages

    records = archive_pages(_table(spark, sf_dir, "pages"), with_payload=False).where("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.positions import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.collocations import collocations

    return collocations(_table(spark, sf_dir, "documents"))


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the repetitions that the query asks for in one text of ten."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("w").cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    again = F.transform("w", lambda w, i: F.when(i < a, w).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"))
    return chosen.select("doc_id", F.when(F.size("w") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tonegrain.llm.periodic import collapse_runs, longest_turns, run_lines

    found = collapse_runs(_planted(_table(spark, sf_dir, "documents")))
    best = longest_turns(F.col("runs"))
    rows = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(run_lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
    whole = F.expr("1000 * best.length div best.period")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", whole.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def _shipped(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(fn) for name, fn in globals().items() if name.startswith("op")}

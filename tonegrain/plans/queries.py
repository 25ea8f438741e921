"""The registered queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.functions import structured, text as tx
from tonegrain.functions.patterns import pattern_matches, tags
from tonegrain.functions.scoring import char_count, hits_sql, negation_sql, sentiment, with_preview, word_count
from tonegrain.functions.sql import is_in
from tonegrain.lexicon import DEFAULT_LEXICON as LEX
from tonegrain.operators import dashboard, gram_index, jobs, maintain, search, stats, store, summaries, swap
from tonegrain.operators.chunking import chunk_index, chunk_size
from tonegrain.operators.lookup import keyword_table, lexicon_counts, lexicon_table, sentiment_by_table, tags_by_table, word_scores
from tonegrain.operators.records import filterable
from tonegrain.operators.unnest import each, each_struct
from tonegrain.plans.tables import (
    conversation_lines_scored, document_chunks, document_chunks_scored, documents, feedback, feedback_chunks_scored,
    feedback_lines_scored, feedback_numbered, page_sentences_scored, table,
)
from tonegrain.session import shared_folder, shared_table
from tonegrain.sources.lines import lines_from_column, read_lines
from tonegrain.sources.tables import read_records, rows_to_lines, spread
from tonegrain.streaming.live import score_by_window

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def query(fn: Query) -> Query:
    # A trailing underscore only keeps a name apart from an import.
    _REGISTERED["q_" + fn.__name__.rstrip("_")] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTERED)


def _time(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(col)


def _record(records: DataFrame) -> DataFrame:
    """A record in comparable form: lists as text, time as text, text as its digest."""
    joined = [
        F.array_join(c, ",").alias(c)
        for c in ("positive_words", "negative_words", "negated_words", "tags", "pattern_matches")
    ]
    return records.select(
        "batch_id", "file_name", "chunk_index", F.md5("chunk_text").alias("text_md5"), "sentiment_score",
        "sentiment_label", F.round("raw_score", 4).alias("raw_score"), *joined,
        F.col("word_count").cast("long").alias("word_count"), F.col("char_count").cast("long").alias("char_count"),
        _time("processed_at"),
    )


def _hit(records: DataFrame, *more: str) -> DataFrame:
    return records.select(
        "batch_id", "file_name", "chunk_index", "sentiment_score", "sentiment_label", _time("processed_at"), *more
    )


def _export(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "processed_at": F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "word_count": F.col("word_count").cast("long"), "char_count": F.col("char_count").cast("long"),
    })


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("avg_score", F.round("avg_score", 4))


# ------------------------------------------------------------------------ lines
@query
def lines_documents(spark, sf):
    lines = lines_from_column(documents(spark, sf), "text", ["doc_id"])
    return lines.withColumn("line_no", F.col("line_no").cast("long"))


@query
def line_count(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.sum(tx.physical_lines("text")).alias("n_lines"))


@query
def row_to_line_csv(spark, sf):
    record = F.format_string('%d,"%s, ""retail""", ,%s,', "c_custkey", "c_name", "c_mktsegment")
    return table(spark, sf, "customer").select("c_custkey", structured.record_to_line(record).alias("line"))


@query
def row_to_line_sheet(spark, sf):
    cells = ["p_partkey", "p_name", "p_brand", "p_type", F.when(F.col("p_size") > 10, F.col("p_size"))]
    return rows_to_lines(table(spark, sf, "part"), cells, ["p_partkey"])


@query
def csv_files(spark, sf):
    """The conversations as delimited files, quoted line breaks included, read by splits."""
    folder = shared_folder(spark, "csv")
    keep = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").write.options(**keep).csv(folder)
    return read_lines(spark, folder, whole_file_limit=0).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _array_files(rows: DataFrame, folder: str) -> None:
    """Write each partition as a text file that is one JSON array."""
    def lines(batches):
        first = True
        for batch in batches:
            objects = batch.column(0).to_pylist()
            if objects:
                yield pa.RecordBatch.from_pydict({"value": [("[" if first and not i else ",") + o for i, o in enumerate(objects)]})
                first = False
        yield pa.RecordBatch.from_pydict({"value": ["[]" if first else "]"]})

    rows.select(F.to_json(F.struct("*"))).mapInArrow(lines, "value string").write.text(folder)


@query
def json_files(spark, sf):
    """The documents as files of one JSON array each, read by splits."""
    folder = shared_folder(spark, "json")
    _array_files(table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"), folder)
    return read_lines(spark, folder, "json", whole_file_limit=0).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query
def json_values_line(spark, sf):
    event = F.col("event_id")
    row = F.format_string(
        '{"type": "%s", "rest": %d, "even": %s, "gone": null, "zero": "0", "none": [], "id": %d}',
        "event_type", event % 3, F.when(event % 2 == 0, "true").otherwise("false"), event,
    )
    return spread(table(spark, sf, "events").select("event_id", "event_type", "props")).select(
        "event_id", structured.object_to_line("props").alias("props_line"),
        structured.object_to_line(row).alias("row_line"),
    )


@query
def html_sentences(spark, sf):
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    sentences = each(pages, ["page_id"], tx.html_sentences("html"), "sentence", "sentence_no")
    return sentences.withColumn("sentence_no", F.col("sentence_no").cast("long"))


# ----------------------------------------------------------------------- chunks
@query
def chunk_size_(spark, sf):
    docs = documents(spark, sf).select(
        "file_name", "batch_id", F.size(tx.clean_lines("text")).cast("long").alias("total_lines")
    ).filter(F.col("total_lines") > 0)
    feeds = feedback(spark, sf).groupBy("file_name", "batch_id").agg(F.count(F.lit(1)).alias("total_lines"))
    return docs.unionByName(feeds).withColumn("chunk_size", chunk_size("total_lines"))


@query
def chunk_index_(spark, sf):
    return feedback_numbered(spark, sf).select(
        "event_id", "batch_id", "file_name", "line_no", chunk_index("line_no", "total_lines").alias("chunk_index")
    )


@query
def chunk_text(spark, sf):
    return document_chunks(spark, sf).select("file_name", "chunk_index", "chunk_text")


# ---------------------------------------------------------------------- scoring
@query
def tokens(spark, sf):
    words = each(documents(spark, sf), [], tx.lower_tokens("text"), "token")
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query
def counts(spark, sf):
    return documents(spark, sf).select(
        "doc_id", word_count("text").alias("word_count"), char_count("text").alias("char_count")
    )


@query
def modifiers(spark, sf):
    words = feedback(spark, sf).select("event_id", F.expr(tx.words_sql("line")).alias("words"))
    hits = each(words, ["event_id"], F.expr(hits_sql("words", LEX)), "h")
    two = F.col("h.m2") > 0
    return hits.filter(two | (F.col("h.m1") > 0)).select(
        "event_id", F.col("h.i").alias("position"), F.col("h.t").alias("word"),
        F.when(two, F.col("h.m2")).otherwise(F.col("h.m1")).alias("factor"),
        F.when(two, 2).otherwise(1).alias("n_words"),
    )


@query
def negation(spark, sf):
    words = feedback(spark, sf).select("event_id", F.expr(tx.words_sql("line")).alias("words"))
    return each_struct(words, ["event_id"], F.expr(negation_sql("words", LEX)), "word").filter(F.expr(is_in("word", LEX.sentiment)))


@query
def lexicon_hits(spark, sf):
    kinds = {
        **{w: "negation" for w in LEX.negations}, **{w: "negative" for w in LEX.negative},
        **{w: "positive" for w in LEX.positive},
    }
    lexicon = spark.createDataFrame(sorted(kinds.items()), "word string, kind string")
    return lexicon_counts(document_chunks(spark, sf), lexicon)


@query
def lexicon_join(spark, sf):
    """A lexicon made of a table: every word of the benchmark texts, by its length."""
    words = each(table(spark, sf, "benchmark"), [], tx.lower_tokens("text"), "word").distinct()
    lexicon = words.withColumn("weight", F.when(F.length("word") > 6, 1.0).otherwise(-0.5))
    return word_scores(document_chunks(spark, sf), ["file_name", "chunk_index"], lexicon)


@query
def own_patterns(spark, sf):
    mine = LEX.with_(patterns={"ticket": r"#\w*refund", "caps": LEX.patterns["all_caps_word"], "clock": r"\b\d{1,2}:\d{2}\b", "ops": "OPS@"})
    return each(feedback(spark, sf), ["event_id"], pattern_matches("line", mine), "pattern")


@query
def chunk_preview(spark, sf):
    return with_preview(document_chunks(spark, sf)).select("file_name", "chunk_index", F.md5("preview").alias("preview_md5"))


@query
def conversation_stats(spark, sf):
    return _rounded(stats.statistics(conversation_lines_scored(spark, sf), by=["batch_id"]))


@query
def page_sentiment(spark, sf):
    return page_sentences_scored(spark, sf).select("file_name", "chunk_index", "sentiment_score", "sentiment_label", "word_count")


@query
def scored_labels(spark, sf):
    """Scores of whole documents against their quality labels."""
    docs = documents(spark, sf).select("doc_id", sentiment("text").alias("s"))
    scored = docs.select("doc_id", F.round("s.sentiment_score", 4).alias("sentiment_score"), "s.sentiment_label")
    return scored.join(table(spark, sf, "labels"), "doc_id").groupBy("quality", "toxic", "sentiment_label").agg(
        F.count(F.lit(1)).alias("n"), F.round(stats.mean_score(), 4).alias("avg_score"))


@query
def stored_batches(spark, sf):
    """Write the scored lines, replace one batch, and read the table back."""
    folder = shared_folder(spark, "stored")
    lines = feedback_lines_scored(spark, sf).withColumn("batch_id", F.concat(F.lit("00"), F.substring("batch_id", 2, 1)))
    store.write_chunks(lines, folder)
    store.replace_batch(lines.filter("batch_id = '002' and sentiment_label = 'negative'"), folder, "002")
    store.replace_batch(lines.filter("false"), folder, "003")
    rows = stats.statistics(read_records(spark, folder), by=["batch_id"])
    return _rounded(rows).select("batch_id", "total_chunks", "total_words", "avg_score")


def _stored(spark, records: DataFrame) -> str:
    """The path of a new chunk table that holds the records."""
    folder = shared_folder(spark, "stored")
    store.write_chunks(records, folder)
    return folder


def _summarised(spark, records: DataFrame) -> str:
    """The path of new summaries of the records' batches."""
    folder = shared_folder(spark, "summaries")
    summaries.summarise(records, folder)
    return folder


@query
def kept_statistics(spark, sf):
    return _rounded(summaries.kept_statistics(spark, _summarised(spark, feedback_lines_scored(spark, sf)), by=["batch_id"]))


@query
def kept_top_positive(spark, sf):
    return summaries.kept_top(spark, _summarised(spark, feedback_lines_scored(spark, sf)), "positive", 10)


@query
def kept_keyword_counts(spark, sf):
    return summaries.kept_counts(spark, _summarised(spark, document_chunks_scored(spark, sf)), "keyword")


@query
def completions(spark, sf):
    return summaries.completions(spark, _summarised(spark, document_chunks_scored(spark, sf)), "Th")


@query
def search_indexed(spark, sf):
    folder, index = _stored(spark, feedback_lines_scored(spark, sf)), shared_folder(spark, "grams")
    gram_index.update_index(spark, folder, index)
    return _hit(gram_index.search_indexed(spark, folder, index, "Not VERY"))


@query
def dedup_in_place(spark, sf):
    folder = _stored(spark, feedback_lines_scored(spark, sf))
    swap.dedup_stored(spark, folder)
    return _hit(read_records(spark, folder))


@query
def archive_in_place(spark, sf):
    folder, archive = _stored(spark, feedback_lines_scored(spark, sf)), shared_folder(spark, "archive")
    swap.archive_stored(spark, folder, archive, "2024-02-15 13:00:00", 30)
    return _hit(read_records(spark, archive))


@query
def sentiment_by_lexicon_table(spark, sf):
    """Every chunk record of the documents, scored with the lexicon as a table that is read from the shared folder."""
    lexicon = shared_table(lexicon_table(spark), "lexicon")
    scored = sentiment_by_table(document_chunks(spark, sf), ["file_name", "chunk_index"], lexicon)
    lists = [F.array_join(c, ",").alias(c) for c in ("positive_words", "negative_words", "negated_words")]
    return scored.select(
        "file_name", "chunk_index", F.round("raw_score", 4).alias("raw_score"), F.round("sentiment_score", 4).alias("sentiment_score"),
        "sentiment_label", *lists, F.col("word_count").cast("long").alias("word_count"))


@query
def raw_score(spark, sf):
    scored = feedback(spark, sf).select("event_id", sentiment("line").alias("s"))
    return scored.select("event_id", F.round("s.raw_score", 4).alias("raw_score"))


@query
def word_lists(spark, sf):
    scored = feedback(spark, sf).select("event_id", sentiment("line").alias("s"))
    lists = ("positive_words", "negative_words", "negated_words")
    return scored.select("event_id", *[F.array_join(f"s.{c}", ",").alias(c) for c in lists])


@query
def score_label(spark, sf):
    return feedback_lines_scored(spark, sf).select(
        F.col("chunk_index").alias("event_id"), "sentiment_score", "sentiment_label"
    )


@query
def score_label_documents(spark, sf):
    return document_chunks_scored(spark, sf).select("file_name", "chunk_index", "sentiment_score", "sentiment_label")


@query
def patterns(spark, sf):
    return each(feedback(spark, sf), ["event_id"], pattern_matches("line"), "pattern")


@query
def patterns_documents(spark, sf):
    chunks = document_chunks(spark, sf)
    return each(chunks, ["file_name", "chunk_index"], pattern_matches("chunk_text"), "pattern")


@query
def tags_(spark, sf):
    return feedback(spark, sf).select("event_id", F.array_join(tags("line"), ",").alias("tags"))


@query
def tags_documents(spark, sf):
    chunks = document_chunks(spark, sf)
    return chunks.select("file_name", "chunk_index", F.array_join(tags("chunk_text"), ",").alias("tags"))


@query
def tags_by_keyword_table(spark, sf):
    keywords = shared_table(keyword_table(spark), "keywords")
    return tags_by_table(document_chunks(spark, sf), ["file_name", "chunk_index"], keywords)


@query
def line_records(spark, sf):
    return _record(feedback_lines_scored(spark, sf, with_details=True))


@query
def chunk_records(spark, sf):
    return _record(document_chunks_scored(spark, sf, with_details=True))


@query
def feedback_chunk_records(spark, sf):
    return _record(feedback_chunks_scored(spark, sf, with_details=True))


# ------------------------------------------------------------------- statistics
@query
def stats_(spark, sf):
    return _rounded(stats.statistics(document_chunks_scored(spark, sf)))


@query
def stats_one_batch(spark, sf):
    return _rounded(stats.statistics(feedback_lines_scored(spark, sf), batch_id="b1"))


@query
def stats_by_batch(spark, sf):
    return _rounded(stats.statistics(feedback_lines_scored(spark, sf), by=["batch_id"]))


@query
def stats_by_file(spark, sf):
    return _rounded(stats.statistics(feedback_chunks_scored(spark, sf), by=["file_name"]))


@query
def summary(spark, sf):
    return stats.summary(feedback_lines_scored(spark, sf))


@query
def pattern_freq(spark, sf):
    return stats.pattern_frequency(feedback_lines_scored(spark, sf))


@query
def top_positive(spark, sf):
    return stats.top_words(feedback_lines_scored(spark, sf), "positive")


@query
def top_negative(spark, sf):
    return stats.top_words(document_chunks_scored(spark, sf), "negative")


@query
def top_domains(spark, sf):
    return stats.top_domains(feedback_lines_scored(spark, sf))


@query
def keyword_counts(spark, sf):
    return stats.keyword_counts(document_chunks_scored(spark, sf))


@query
def keywords(spark, sf):
    return stats.keywords(document_chunks_scored(spark, sf))


@query
def keyword_chips(spark, sf):
    return stats.keywords(feedback_lines_scored(spark, sf), 16)


@query
def pattern_bars(spark, sf):
    return stats.pattern_bars(feedback_lines_scored(spark, sf))


@query
def word_panel(spark, sf):
    return stats.word_panel(feedback_lines_scored(spark, sf))


# -------------------------------------------------------------------- dashboard
@query
def label_distribution(spark, sf):
    return dashboard.label_distribution(feedback_lines_scored(spark, sf))


@query
def score_histogram(spark, sf):
    return dashboard.score_histogram(feedback_lines_scored(spark, sf))


@query
def score_trend(spark, sf):
    return _rounded(dashboard.score_trend(feedback_lines_scored(spark, sf)))


@query
def domain_freq(spark, sf):
    return dashboard.domain_frequency(document_chunks_scored(spark, sf))


@query
def score_format(spark, sf):
    return feedback_lines_scored(spark, sf).select(
        F.col("chunk_index").alias("event_id"), dashboard.score_text_form("sentiment_score").alias("score_text"),
        dashboard.gauge_percent("sentiment_score").alias("gauge_pct"),
    )


# ----------------------------------------------------------------------- search
@query
def search_keyword(spark, sf):
    return _hit(search.search(feedback_lines_scored(spark, sf), keyword="Not VERY"))


@query
def search_wildcard(spark, sf):
    hits = search.search(document_chunks_scored(spark, sf), keyword="ou_n%er the")
    return hits.select("file_name", "chunk_index", "chunk_text")


@query
def search_score_range(spark, sf):
    return _hit(search.search(filterable(feedback_lines_scored(spark, sf)), min_score=0, max_score=0.3))


@query
def search_label(spark, sf):
    return _hit(search.search(filterable(document_chunks_scored(spark, sf)), label="negative"))


@query
def search_batch(spark, sf):
    return _hit(search.search(feedback_lines_scored(spark, sf), batch_id="b2"))


@query
def search_date(spark, sf):
    return _hit(search.search(feedback_lines_scored(spark, sf), date_from="2024-01-05", date_to="2024-01-09"))


@query
def search_combined(spark, sf):
    return _hit(search.search(
        filterable(feedback_lines_scored(spark, sf)), keyword="Doctor", min_score=-0.9, label="negative", batch_id="b3",
        date_from="2024-01-03",
    ))


@query
def search_total(spark, sf):
    return search.total(search.search(document_chunks_scored(spark, sf), keyword="tion"))


@query
def search_page(spark, sf):
    hits = search.search(feedback_lines_scored(spark, sf), keyword="bank")
    return _hit(search.page(hits, 2, 50), "result_no", "tags_preview")


@query
def page_after(spark, sf):
    key = {"processed_at": F.lit("2024-01-20").cast("timestamp"), "batch_id": "b2",
           "file_path": "feed_click.log", "chunk_index": 5}
    return _hit(search.page_after(feedback_lines_scored(spark, sf), key), "tags_preview")


@query
def suggest(spark, sf):
    return search.suggest(stats.keyword_counts(document_chunks_scored(spark, sf)), "Th")


@query
def highlight(spark, sf):
    return feedback(spark, sf).select("event_id", tx.highlight("line", "re").alias("html"))


@query
def page_count(spark, sf):
    totals = feedback_lines_scored(spark, sf).groupBy("batch_id").agg(F.count(F.lit(1)).alias("total"))
    return totals.withColumn("pages", search.page_count(F.col("total"), 50))


# --------------------------------------------------------------- export and jobs
@query
def all_chunks(spark, sf):
    rows = search.search(feedback_chunks_scored(spark, sf, with_details=True), batch_id="b0")
    return _record(rows.orderBy(*search.oldest_first()))


@query
def export_rows(spark, sf):
    return _export(search.export_rows(feedback_lines_scored(spark, sf)))


@query
def export_search(spark, sf):
    return _export(search.export_search(feedback_lines_scored(spark, sf), "excellent"))


@query
def batch_summary(spark, sf):
    chunks = feedback_chunks_scored(spark, sf)
    # The listing names one more file per batch, of which no line was left.
    read = feedback(spark, sf).select("batch_id", F.explode(F.array("file_name", F.lit("feed_blank.log"))).alias("file_name")).distinct()
    jobs_table = jobs.batch_summary(chunks, read.withColumn("file_size", F.lit(1).cast("long")))
    return jobs_table.select(
        "batch_id", "file_name", "total_chunks", _time("started_at"), _time("completed_at"), "status", "error_message"
    )


@query
def batch_progress(spark, sf):
    lines = documents(spark, sf).select(
        "batch_id", "file_name", F.size(tx.clean_lines("text")).cast("long").alias("total_lines")
    )
    # Every chunk counts.  The batches src1* expect another 700 lines of each file, and one batch has no line at all.
    more = F.when(F.col("batch_id").startswith("src1"), 700).otherwise(0)
    blank = spark.createDataFrame([("blank", "blank.txt", 0)], lines.schema)
    return jobs.batch_progress(document_chunks_scored(spark, sf), lines.withColumn("total_lines", F.col("total_lines") + more).union(blank))


@query
def batch_report(spark, sf):
    return jobs.batch_report(feedback_lines_scored(spark, sf), "b1")


# ------------------------------------------------------------------- maintenance
@query
def dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return maintain.dedup(docs, key=["doc_id"], group=("source", "text"))


@query
def dedup_chunks(spark, sf):
    return _hit(maintain.dedup(feedback_lines_scored(spark, sf)))


@query
def archive_moved(spark, sf):
    return _hit(maintain.archive_split(feedback_lines_scored(spark, sf), "2024-02-15 13:00:00", 30)[0])


@query
def archive_kept(spark, sf):
    return _hit(maintain.archive_split(feedback_lines_scored(spark, sf), "2024-02-15 13:00:00", 30)[1])


@query
def archive_union(spark, sf):
    moved, kept = maintain.archive_split(feedback_lines_scored(spark, sf), "2024-02-15 13:00:00", 30)
    return _hit(maintain.with_archive(kept, moved))


# -------------------------------------------------------------------------- time
@query
def sentiment_by_day(spark, sf):
    days = score_by_window(feedback_lines_scored(spark, sf), "1 day")
    return days.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "file_name", "n",
        F.round("avg_score", 4).alias("avg_score"),
    )

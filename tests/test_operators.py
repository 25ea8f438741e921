import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tonegrain.functions.patterns import tags
from tonegrain.functions.scoring import sentiment, with_preview
from tonegrain.functions.text import highlight
from tonegrain.operators import dashboard, jobs, lookup, maintain, search, stats, store, swap
from tonegrain.operators.records import ORDER_KEY, RECORD_COLUMNS, chunk_records, line_records
from tonegrain.operators.topn import top_n
from tonegrain.sources.tables import read_records

T0 = datetime(2024, 3, 1)
TEXTS = ["very good", "not good", "the table", "superb 100% deal", "Excellent! ÉTÉ", "a_b 50%c", "worst fraud", "so-so \\ x"]


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        (f"b{i % 3}", f"f{i % 2}.txt", i // 2, TEXTS[i % len(TEXTS)], T0 + timedelta(days=i % 5))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "batch_id string, file_name string, chunk_index long, chunk_text string, processed_at timestamp")
    return chunk_records(df).cache()


def key(row):
    return tuple(row[c] for c in ORDER_KEY)


def test_record_columns(records):
    assert records.columns == RECORD_COLUMNS and records.count() == 120


def test_records_keep_whole_texts(spark):
    text = "x" * 4_999 + " good bad bad"
    df = spark.createDataFrame([("b", "f", 0, text, T0)], "batch_id string, file_name string, chunk_index long, chunk_text string, processed_at timestamp")
    row = chunk_records(df).collect()[0]
    assert (row.chunk_text, row.char_count, row.word_count, row.negative_words) == (text, len(text), 4, ["bad"])
    records = chunk_records(df)
    assert search.search(records, keyword="good bad").count() == 1 and stats.keyword_counts(records).filter("word = 'bad'").count() == 1
    assert len(with_preview(records).first().preview) == 5_000


def test_error_records(spark):
    df = spark.createDataFrame([("b", "f", 0, "good", T0, True), ("b", "f", 1, "good", T0, None)],
                               "batch_id string, file_name string, chunk_index long, chunk_text string, processed_at timestamp, broken boolean")
    bad, fine = chunk_records(df, corrupt=F.col("broken")).orderBy("chunk_index").collect()
    assert (bad.chunk_text, bad.sentiment_score, bad.sentiment_label, bad.tags, bad.word_count) == ("[processing error]", 0, "neutral", ["error"], 0)
    assert fine.sentiment_label == "positive"


def test_statistics_of_no_rows(records):
    row = stats.statistics(records, batch_id="none").collect()[0]
    assert row.total_chunks == 0 and row.total_words == 0
    assert row.avg_score is None and row.max_score is None and row.positive_count is None
    assert stats.summary(records.filter("false")).collect() == []
    assert {r.n for r in dashboard.score_histogram(records.filter("false")).collect()} == {0}
    assert len(dashboard.domain_frequency(records.filter("false")).collect()) == 6


def test_histogram_edges(spark):
    scores = [-1, -0.6001, -0.6, -0.3, -0.0001, 0.0, 0.2999, 0.3, 0.6, 0.6001, 1]
    df = spark.createDataFrame([(float(s),) for s in scores], "s double")
    got = [r.b for r in df.select(dashboard.histogram_bucket("s").alias("b")).collect()]
    assert got == [0, 0, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_display_forms(spark):
    df = spark.createDataFrame([(0.5225, 512, 900.0), (-0.0625, 1536, 1000.0), (0.0, 5 * 1024 ** 2 + 1024 * 64, 61234.5)], "s double, b long, ms double")
    rows = df.select(dashboard.score_text_form("s").alias("s"), dashboard.bytes_text("b").alias("b"), dashboard.duration_text("ms").alias("m")).collect()
    assert [r.s for r in rows] == ["+0.522", "-0.063", "+0.000"]
    assert [r.b for r in rows] == ["512 B", "1.5 KB", "5.06 MB"]
    assert [r.m for r in rows] == ["900 ms", "1.00 s", "61.23 s"]


def test_keyword_semantics(records):
    def found(keyword, **options):
        return {r.chunk_text for r in search.search(records, keyword=keyword, **options).collect()}

    assert found("EXCELLENT") == {"Excellent! ÉTÉ"}
    assert found("été") == set() and found("ÉtÉ") == {"Excellent! ÉTÉ"}
    assert found("0%") == {"superb 100% deal", "a_b 50%c"}
    assert found("0%d") == {"superb 100% deal"}
    assert found("t_ble") == {"the table"}
    assert found("a_b", literal=True) == {"a_b 50%c"}
    assert found("0%c", literal=True) == {"a_b 50%c"}
    assert found("\\ X") == {"so-so \\ x"}
    assert len(found("")) == len(set(TEXTS))


def test_filters(records):
    assert search.search(records, min_score=0.0).filter("sentiment_score < 0").count() == 0
    assert search.search(records, max_score=0).filter("sentiment_score > 0").count() == 0
    days = {r.processed_at for r in search.search(records, date_from="2024-03-02", date_to="2024-03-03").collect()}
    assert days == {T0 + timedelta(days=1), T0 + timedelta(days=2)}
    assert search.search(records, label="", batch_id="", keyword="") is records


def test_pages(records):
    newest = sorted((key(r) for r in records.collect()), reverse=True)
    for number, want in ((1, newest[:50]), (3, newest[100:]), (4, []), (0, newest[:50]), (-3, newest[:50])):
        rows = sorted(search.page(records, number, 50).collect(), key=lambda r: r.result_no)
        if number > 0:
            assert [key(r) for r in rows] == want
            assert [r.result_no for r in rows] == list(range((number - 1) * 50 + 1, (number - 1) * 50 + 1 + len(want)))
    everything = search.page(records, 1, -1)
    assert everything.count() == 120 and everything.columns == search.page(records, 1, 50).columns
    total, first = search.search_page(records, 1, 10, keyword="good")
    assert total.collect()[0].total == 30 and first.count() == 10
    last = dict(zip(ORDER_KEY, newest[49]))
    last["processed_at"] = F.lit(last["processed_at"])
    assert sorted((key(r) for r in search.page_after(records, last).collect()), reverse=True) == newest[50:100]
    assert [search.page_count(n) for n in (0, 1, 50, 51)] == [1, 1, 1, 2]


def test_top_n_merges_in_steps(spark):
    df = spark.range(0, 5_000, 1, 16).select(((F.col("id") * 7_919) % 5_003).alias("k"))
    got = [r.k for r in top_n(df, [F.desc("k")], 37, steps=(8, 3)).collect()]
    assert got == sorted(((i * 7_919) % 5_003 for i in range(5_000)), reverse=True)[:37]
    assert plan_of(top_n(df, [F.desc("k")], 37)).count("WindowGroupLimit") == 2


def test_export_search_limit(records):
    newest = sorted((key(r) for r in search.search(records, keyword="good").collect()), reverse=True)
    rows = search.export_search(records, "good", limit=7).collect()
    assert [key(r) for r in rows] == newest[:7]
    assert search.export_search(records, "good").count() == 30
    assert search.export_search(records, "nowhere to be found").count() == 0
    assert rows[0].positive_words in ("good", "")


def test_suggest_and_highlight(spark, records):
    words = stats.keywords(records)
    assert [r.word for r in search.suggest(words, " EX ").collect()] == ["excellent"]
    assert search.suggest(words, "e").count() == 0
    df = spark.createDataFrame([('a<b> & "A"', ), (None,), ("$1 (x.y)",)], "t string")
    assert [r.h for r in df.select(highlight("t", "a").alias("h")).collect()] == [
        '<mark class="highlight">a</mark>&lt;b&gt; &<mark class="highlight">a</mark>mp; &quot;<mark class="highlight">A</mark>&quot;', "", "$1 (x.y)"]
    assert df.select(highlight("t", "$1 (X.").alias("h")).collect()[2].h == '<mark class="highlight">$1 (x.</mark>y)'
    assert df.select(highlight("t", "").alias("h")).collect()[0].h == "a&lt;b&gt; &amp; &quot;A&quot;"


def test_newest_n_keywords(records):
    newest = sorted(records.collect(), key=key, reverse=True)[:9]
    n = sum(r.chunk_text.lower().count("good") for r in newest)
    got = {r.word: r.n for r in stats.keyword_counts(records, newest_n=9).collect()}
    assert got.get("good", 0) == n


def test_keyword_borders(spark):
    df = spark.createDataFrame([("café abc_d abcd9 the ABC-def it's x1 über",)], "chunk_text string")
    assert {r.word for r in stats.keyword_counts(df).collect()} == {"caf", "abc", "def", "ber"}


def test_dedup_keeps_the_first(spark, records):
    first = {}
    for r in sorted(records.collect(), key=key):
        first.setdefault((r.file_name, r.chunk_text), key(r))
    once = maintain.dedup(records)
    assert once.columns == records.columns
    assert sorted(key(r) for r in once.collect()) == sorted(first.values())
    assert maintain.dedup(once).count() == once.count()


def test_dedup_of_a_hot_group_moves_no_text(spark):
    df = spark.range(0, 30_000, 1, 8).select(
        "id", F.lit("f").alias("source"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = maintain.dedup(df.union(df.limit(3)), key=["id"], group=("source", "text"))
    assert rows.count() == 20_001 and rows.filter("text = 'same'").collect()[0].id == 0
    plan = plan_of(maintain.dedup(df, key=["id"], group=("source", "text")))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_same_named_files_in_two_folders(spark):
    schema = "batch_id string, file_path string, file_name string, chunk_index long, chunk_text string, processed_at timestamp"
    df = chunk_records(spark.createDataFrame([(b, f"{d}/part.txt", "part.txt", i, "good", T0) for d in "12" for i in range(3) for b in ("b",)], schema))
    assert sorted(r.total_chunks for r in jobs.batch_summary(df).collect()) == [3, 3]
    first = search.page(df, 1, 1).collect()[0]
    after = {c: first[c] for c in ORDER_KEY} | {"processed_at": F.lit(first.processed_at)}
    assert search.page_after(df, after).count() == 5
    assert maintain.dedup(df).count() == 2 and [r.n for r in dashboard.score_trend(df).collect()] == [2, 2, 2]
    none = df.withColumn("batch_id", F.lit(None).cast("string"))
    assert sum(r.n for r in dashboard.score_trend(none).collect()) == 6 and {r.batch_id for r in dashboard.score_trend(none).collect()} == {None}


def test_batch_names_keep_their_form(spark, records, tmp_path):
    path = str(tmp_path / "t")
    assert read_records(spark, path).count() == 0
    one = records.filter("batch_id = 'b1'")
    names = ["007", "7", "2024-05-01", "a/b=c"]
    for n, name in enumerate(names):
        store.replace_batch(one.limit(n + 1), path, name)
    assert {r.batch_id: r["count"] for r in read_records(spark, path).groupBy("batch_id").count().collect()} == dict(zip(names, (1, 2, 3, 4)))
    assert read_records(spark, path, "007").count() == 1
    store.replace_batch(one.limit(0), path, "7")
    store.append_chunks(one.limit(1).drop("batch_id"), path)
    assert sorted((r.batch_id or "", r["count"]) for r in read_records(spark, path).groupBy("batch_id").count().collect()) == [
        ("", 1), ("007", 1), ("2024-05-01", 3), ("a/b=c", 4)]


def test_archive_keeps_what_it_has(spark, records, tmp_path):
    live, old = str(tmp_path / "live"), str(tmp_path / "old")
    store.write_chunks(records.filter("file_name = 'f0.txt'"), live)
    store.archive(spark, live, old, str(tmp_path / "n1"), "2024-04-02")
    n = store.read_archive(spark, old).count()
    store.write_chunks(records.filter("file_name = 'f1.txt'"), str(tmp_path / "live2"))
    store.archive(spark, str(tmp_path / "live2"), old, str(tmp_path / "n2"), "2024-04-02")
    store.archive(spark, live, old, str(tmp_path / "n3"), "2024-04-02")
    moved = maintain.archive_split(records, "2024-04-02", 30)[0]
    assert 0 < n < store.read_archive(spark, old).count() == moved.count()


def test_lexicon_as_a_table(spark):
    texts = spark.createDataFrame([(1, "a B b"), (2, "c"), (3, None)], "id long, chunk_text string")
    lexicon = spark.createDataFrame([("b", 2.0), ("a", -1.0), ("z", 9.0)], "word string, weight double")
    assert {r.word: r.n for r in lookup.lexicon_counts(texts, lexicon).collect()} == {"a": 1, "b": 2}
    assert {r.id: r.weight for r in lookup.word_scores(texts, ["id"], lexicon).collect()} == {1: 3.0, 2: 0.0, 3: 0.0}


def test_archive(spark, records, tmp_path):
    moved, kept = maintain.archive_split(records, "2024-04-02 15:00:00", 30)
    assert {r.processed_at for r in moved.collect()} == {T0, T0 + timedelta(days=1)}
    assert moved.count() + kept.count() == 120
    live, new, newer, old = (str(tmp_path / n) for n in ("live", "new", "newer", "archive"))
    store.write_chunks(records, live)
    store.write_chunks(records, live)                       # again: replaced, not doubled
    assert spark.read.parquet(live).count() == 120
    store.archive(spark, live, old, new, "2024-04-02 15:00:00")
    store.archive(spark, live, old, new, "2024-04-02 15:00:00")
    store.archive(spark, new, old, newer, "2024-04-03")
    archived = store.read_archive(spark, old)
    assert archived.count() == 72 and spark.read.parquet(newer).count() == 48
    both = maintain.with_archive(spark.read.parquet(newer), archived)
    assert sorted(key(r) for r in both.collect()) == sorted(key(r) for r in records.collect())
    one = read_records(spark, live, "b1")
    assert one.count() == 40 and "PartitionFilters: [isnotnull(batch_id" in plan_of(one)


def test_append_defaults_and_csv(spark, records, tmp_path):
    path = str(tmp_path / "t")
    row = spark.createDataFrame([("f.txt", 0, "hello", "b9")], "file_name string, chunk_index long, chunk_text string, batch_id string")
    store.append_chunks(row, path)
    store.append_chunks(row, path)
    got = spark.read.parquet(path).collect()
    assert len(got) == 2 and got[0].sentiment_label == "neutral" and got[0].tags == [] and got[0].processed_at is not None
    out = str(tmp_path / "csv")
    store.write_csv(search.export_rows(records, "b1"), out, single_file=True)
    back = spark.read.option("header", True).option("escape", '"').csv(out).collect()
    assert len(back) == 40 and back[0].batch_id == "b1" and [int(r.chunk_index) for r in back[:2]] == [
        r.chunk_index for r in search.export_rows(records, "b1").limit(2).collect()]


def test_jobs(spark, records):
    files = spark.createDataFrame([("b0", "f0.txt", 10), ("b0", "f0.txt", 12), ("b8", "empty.txt", 0)], "batch_id string, file_name string, file_size long")
    rows = {r.file_name: r for r in jobs.batch_summary(records, files).collect()}
    assert (rows["empty.txt"].status, rows["empty.txt"].total_chunks) == ("error", 0)
    assert (rows["f0.txt"].status, rows["f0.txt"].file_size) == ("completed", 10)
    counts = spark.createDataFrame([("b0", "f0.txt", 800), ("b9", "x", 5), ("b7", "y", 0)], "batch_id string, file_name string, total_lines long")
    progress = {r.batch_id: (r.completed_chunks, r.expected_chunks, r.percent, r.status) for r in jobs.batch_progress(records.limit(120).filter("batch_id <> 'b0' or chunk_index < 12"), counts).collect()}
    assert progress["b9"] == (0, 1, 0, "processing") and progress["b7"] == (0, 0, 0, "error")
    report = jobs.batch_report(records).collect()[0].report
    assert report.startswith("Batch ID: N/A\nTotal Chunks: 120\n")
    assert "Average Sentiment Score: 0.0000" in jobs.batch_report(records, "nope").collect()[0].report


def test_trend_covers_all_chunks(records):
    rows = dashboard.score_trend(records).collect()
    assert sum(r.n for r in rows) == 120
    assert all(0 <= r.point < 20 for r in rows)
    one = sorted((r.point, r.first_chunk, r.n) for r in rows if r.batch_id == "b0")
    assert one == [(p, p, 2) for p in range(20)]      # two files of 20 chunks each


def test_line_records_need_no_shuffle(spark):
    df = spark.range(10).select(F.lit("b").alias("batch_id"), F.lit("f").alias("file_name"), F.col("id").alias("chunk_index"),
                                F.concat(F.lit("good "), F.col("id").cast("string")).alias("line"), F.current_timestamp().alias("processed_at"))
    assert "Exchange" not in plan_of(line_records(df))


def test_random_rows_score_between_bounds(records):
    rnd = random.Random(1)
    row = rnd.choice(records.collect())
    assert -1 <= row.sentiment_score <= 1


def test_dedup_and_archive_in_place(spark, records, tmp_path, monkeypatch):
    """A failure before the commit leaves the old state, one after it is finished by whoever runs next."""
    path, old = str(tmp_path / "t"), str(tmp_path / "old")
    records = records.withColumn("chunk_text", F.concat_ws(" ", "chunk_text", "batch_id", "chunk_index"))
    twice = records.unionByName(records.where("batch_id = 'b1'").withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 1 HOUR")))
    store.write_chunks(twice, path)
    state = lambda p=path: sorted(map(repr, read_records(spark, p).collect()))
    before, want = state(), sorted(map(repr, maintain.dedup(read_records(spark, path)).collect()))
    files = lambda batch: sorted(f.name for f in (tmp_path / "t" / f"batch_id={batch}").iterdir())
    untouched = {b: files(b) for b in ("b0", "b1", "b2")}

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(swap, "_commit", fails)              # the new content is there, the commit is not
        with pytest.raises(OSError):
            swap.dedup_stored(spark, path)
    assert state() == before
    with monkeypatch.context() as m:
        m.setattr(swap, "_swap", fails)                # committed, not yet swapped
        with pytest.raises(OSError):
            swap.dedup_stored(spark, path)
    assert state() == before
    swap.finish(spark, path)
    assert state() == want and swap.dedup_stored(spark, path) == []
    changed = {r[0] for r in twice.exceptAll(maintain.dedup(twice)).select("batch_id").distinct().collect()}
    assert changed == {"b1"} and all((files(b) == untouched[b]) == (b not in changed) for b in untouched)
    assert not [f.name for f in (tmp_path / "t").iterdir() if f.name.startswith("_") and f.name != "_SUCCESS"]

    moved, kept = maintain.archive_split(read_records(spark, path), "2024-04-02", 30)
    parts = sorted(map(repr, moved.collect())), sorted(map(repr, kept.collect()))
    with monkeypatch.context() as m:
        m.setattr(swap, "_swap", fails)
        with pytest.raises(OSError):
            swap.archive_stored(spark, path, old, "2024-04-02")
    assert state() == want and read_records(spark, old).count() == 0
    assert swap.archive_stored(spark, path, old, "2024-04-02") == [] and (state(old), state()) == parts
    # Loaded again, the archive takes nothing twice.
    again = spark.createDataFrame(read_records(spark, old).where("batch_id = 'b1'").unionByName(read_records(spark, path, "b1")).collect(), records.schema)
    store.write_chunks(again, path)
    assert state() != parts[1] and swap.archive_stored(spark, path, old, "2024-04-02") == ["b1"]
    assert (state(old), state()) == parts


def test_a_micro_batch_again_adds_nothing(spark, records, tmp_path):
    path = str(tmp_path / "t")
    some, more = records.where("batch_id <> 'b2'"), records.where("batch_id = 'b1'").limit(5)
    store.commit_rows(some, path, "feed/1", 0)
    store.commit_rows(more, path, "feed/1", 1)
    store.commit_rows(more, path, "feed/1", 1)             # it failed after its files were there
    store.commit_rows(more, path, "feed/2", 1)             # another query
    assert read_records(spark, path).count() == 80 + 5 + 5
    store.write_chunks(records, path)                       # batch jobs replace what streams left
    assert read_records(spark, path).count() == 120


def test_sentiment_by_a_lexicon_table(spark):
    """Value by value what the expression gives, on texts heavy in modifiers, pairs and negations."""
    rnd = random.Random(8)
    words = ["good", "bad", "very", "not", "a", "bit", "kind", "of", "little", "so", "awful", "slightly", "never", "excellent", "x", "Kind", "is"]
    texts = [(i, None if i == 0 else " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 14)))) for i in range(600)] + [(600, " ,. ")]
    df = spark.createDataFrame(texts, "id long, chunk_text string").repartition(3)
    got = {r.id: tuple(r)[1:] for r in lookup.sentiment_by_table(df, ["id"], lookup.lexicon_table(spark)).collect()}
    want = {r.id: tuple(r.s) for r in df.select("id", sentiment("chunk_text").alias("s")).collect()}
    assert got == want and sum(bool(v[5]) for v in want.values()) > 50


def test_sentiment_by_a_lexicon_of_100_000_words(spark, monkeypatch):
    from tests import rules

    big = rules.LEX.with_(positive={f"up{i}": 1.0 + i % 3 for i in range(50_000)}, negative={f"down{i}": 1.0 + i % 3 for i in range(50_000)})
    known = SimpleNamespace(**{n: getattr(big, n) for n in ("two_word_diminishers", "modifiers", "sentiment", "negations")})
    monkeypatch.setattr(rules, "LEX", known)  # looked up once
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["very", "not", f"up{rnd.randrange(60_000)}", f"down{rnd.randrange(60_000)}", "a", "bit"]) for _ in range(12)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, chunk_text string")
    for r in lookup.sentiment_by_table(df, ["id"], lookup.lexicon_table(spark, big)).collect():
        assert (r.raw_score, r.positive_words, r.negative_words, r.negated_words, r.word_count) == rules.walk(texts[r.id])


def test_tags_by_a_keyword_table(spark, monkeypatch):
    rnd = random.Random(4)
    bits = ["ai", "said", "AI", "happy", "app", "machine learning", "machine  learning", "mental health", "x", "é", "Bank", "gdp", "human rights", "\n", ". "]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 30))) for _ in range(300)] + ["", None, "machine learning" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, chunk_text string")
    want = {(r.id, d) for r in df.select("id", tags("chunk_text").alias("t")).collect() for d in r.t}
    for block in (1 << 16, 7):   # long texts in blocks: a keyword may lie across two
        monkeypatch.setattr(lookup, "BLOCK_LETTERS", block)
        assert {tuple(r) for r in lookup.tags_by_table(df, ["id"], lookup.keyword_table(spark)).collect()} == want
    assert len(want) > 300
    # 50,000 keywords, one of them a single letter, some null or empty
    many = [(f"d{i % 7}", f"word{i:05d}") for i in range(50_000)] + [("one", "é"), ("none", ""), ("none", None)]
    texts = [" ".join(f"WORD{rnd.randrange(60_000):05d}" for _ in range(20)) + "é" * (k % 2) for k in range(100)]
    got = {tuple(r) for r in lookup.tags_by_table(
        spark.createDataFrame(list(enumerate(texts)), "id long, chunk_text string"), ["id"], spark.createDataFrame(many, "domain string, keyword string")).collect()}
    known = {k: d for d, k in many if k}
    assert got == {(i, known[w]) for i, t in enumerate(texts) for w in [x.lower().rstrip("é") for x in t.split()] + ["é"] * (i % 2) if w in known}
    assert lookup.tags_by_table(df, ["id"], spark.createDataFrame([], "domain string, keyword string")).count() == 0


def test_tags_by_odd_keywords(spark, monkeypatch):
    keywords = ["ab", "abc", "a.c", "(x", "x]", "it's", "^-^", "\\d", "İz", "é", "zz top", "b\nc", "#", "[a", "ss", "straße", "\U0001f600!", "tab\t"]
    table = spark.createDataFrame([(f"d{i}", k) for i, k in enumerate(keywords)], "domain string, keyword string")
    texts = ["xabcx", "AB", "a.c axc", "(x] (X]", "IT'S it\"s", "^-^ ^^", r"\d 5", "i̇z iz", "cafÉ", "zz\ttop zz top", "b\nc", "##", "[A", "STRASSE straße", "\U0001f600\U0001f600!", "tab\ttab", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, chunk_text string")
    lowered = dict(rows.selectExpr("i", "lower(chunk_text)").collect())
    low = dict(table.selectExpr("domain", "lower(keyword)").collect())
    expected = sorted((i, d) for i, t in lowered.items() for d, k in low.items() if t is not None and k in t)
    for most in (5000, 3):
        monkeypatch.setattr(lookup, "MOST_ANCHORS", most)
        assert sorted(map(tuple, lookup.tags_by_table(rows, ["i"], table).collect())) == expected


def test_only_anchored_places_of_a_text_meet_the_keywords(spark):
    table = spark.createDataFrame([("d", "bank"), ("d", "bar"), ("e", "ba")], "domain string, keyword string")
    plan = plan_of(lookup.tags_by_table(spark.createDataFrame([(1, "a bank")], "i int, chunk_text string"), ["i"], table))
    assert r"(?s)(?=(?:[b](?:[a])))(?=(.{1,4}))" in plan

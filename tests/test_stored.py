"""Summaries and the gram index beside the stored table, against answers from the chunks themselves."""

import random
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tonegrain.operators import gram_index, search, stats, store, summaries, swap
from tonegrain.operators.records import chunk_records
from tonegrain.sources.tables import read_records

WORDS = "good Bad awful the refund THERE then a 100% it_is café happy x visa".split()


@pytest.fixture(scope="module")
def records(spark):
    rnd = random.Random(6)
    rows = [(f"b{i % 4}", "f.txt", i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 9)))) for i in range(160)]
    df = spark.createDataFrame(rows, "batch_id string, file_name string, chunk_index long, chunk_text string")
    return chunk_records(df.withColumn("processed_at", F.lit("2024-05-01").cast("timestamp"))).cache()


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def same_answers(spark, records, kept):
    assert rows(summaries.kept_statistics(spark, kept)) == rows(stats.statistics(records))
    assert rows(summaries.kept_statistics(spark, kept, by=["batch_id"])) == rows(stats.statistics(records, by=["batch_id"]))
    assert rows(summaries.kept_statistics(spark, kept, batch_id="b1")) == rows(stats.statistics(records, batch_id="b1"))
    assert rows(summaries.kept_counts(spark, kept, "keyword")) == rows(stats.keyword_counts(records))
    assert summaries.kept_top(spark, kept, "negative", 3).collect() == stats.top_words(records, "negative", 3).collect()
    assert rows(summaries.kept_counts(spark, kept, "pattern", "pattern")) == rows(stats.pattern_frequency(records))
    assert summaries.kept_top(spark, kept, "domain", 5, "domain").collect() == stats.top_domains(records, 5).collect()


def test_kept_summaries_follow_the_table(spark, records, tmp_path):
    path, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    store.write_chunks(records, path)
    summaries.summarise(records, kept)
    same_answers(spark, records, kept)
    # Replaced, then archived: only the batches that change are summed up again.
    store.replace_batch(records.where("batch_id = 'b1' AND chunk_index < 50"), path, "b1")
    summaries.refresh(read_records(spark, path), kept, ["b1"])
    same_answers(spark, read_records(spark, path), kept)
    changed = swap.archive_stored(spark, path, str(tmp_path / "old"), "2024-05-01 00:00:01", 0) or []
    store.replace_batch(records.where("batch_id = 'b0'"), path, "b0")
    summaries.refresh(read_records(spark, path), kept, sorted({*changed, "b0"}))
    same_answers(spark, read_records(spark, path), kept)
    assert summaries.kept_statistics(spark, str(tmp_path / "none")).collect()[0].total_chunks == 0


def test_completions_of_all_prefixes(spark, records, tmp_path):
    kept = str(tmp_path / "kept")
    summaries.summarise(records, kept)
    vocabulary = stats.keyword_counts(records).cache()
    for prefix in sorted({w.lower()[:2] for w in WORDS}) + [" TH ", "t", "zz"]:
        assert summaries.completions(spark, kept, prefix).collect() == search.suggest(vocabulary, prefix).collect(), prefix
    assert "PushedFilters: [IsNotNull(kind), IsNotNull(word), EqualTo(kind,keyword), StringStartsWith(word,th)]" in plan_of(summaries.completions(spark, kept, "th"))


def test_indexed_search_equals_the_scan(spark, records, tmp_path):
    path, index = str(tmp_path / "t"), str(tmp_path / "grams")
    special = chunk_records(spark.createDataFrame([("z/1", "g.txt", 0, "a zebra, ÉTÉ 50%_x")], "batch_id string, file_name string, chunk_index long, chunk_text string")
                            .withColumn("processed_at", F.lit("2024-05-02").cast("timestamp")))
    store.write_chunks(records.unionByName(special), path)
    assert gram_index.update_index(spark, path, index) == 5 and gram_index.update_index(spark, path, index) == 0
    table = read_records(spark, path)
    for keyword in ("ZEBRA", "zebra, É", "ÉT", "50%", "refund", "it_is", "e%d", "x", "", "no such text", "good b", "happy%visa", "the refund"):
        for literal in (False, True):
            hits = gram_index.search_indexed(spark, path, index, keyword, literal=literal)
            assert rows(hits) == rows(search.search(table, keyword=keyword, literal=literal)), keyword
    # One file of five is opened for a word that only it has, none for one that nothing has.
    assert len(gram_index.search_indexed(spark, path, index, "Zebra").inputFiles()) == 1
    assert gram_index.candidate_files(spark, path, index, "no such text") == []
    assert len(gram_index.candidate_files(spark, path, index, "ze")) == 5
    # What was written since is searched too, and what is gone is not missed.
    store.replace_batch(special.withColumn("chunk_text", F.lit("another quagga")), path, "b0")
    assert rows(gram_index.search_indexed(spark, path, index, "quagga")) == rows(search.search(read_records(spark, path), keyword="quagga")) != []
    assert gram_index.search_indexed(spark, path, index, "good", batch_id="b1").count() == search.search(table, keyword="good", batch_id="b1").count()


def test_records_are_read_once_for_their_summaries(spark, records, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    def noted(batches):
        (seen / uuid.uuid4().hex).touch()
        yield from batches

    summaries.summarise(records.coalesce(1).mapInArrow(noted, records.schema), str(tmp_path / "kept"))
    assert len(list(seen.iterdir())) == 1


def test_summaries_of_odd_records(spark, tmp_path):
    columns = "batch_id string, chunk_text string, sentiment_score double, sentiment_label string, word_count int, positive_words array<string>, negative_words array<string>, pattern_matches array<string>, tags array<string>"
    odd = [
        (None, None, None, None, None, None, [], None, ["the", "a b"]), (None, "The cat, the CAT and that", 0.1234, "positive", 6, ["the"], ["cat"], ["x"], None),
        ("b", "", -0.0, "neutral", 0, [], [], [], []), ("b", "record", 1.0, "positive", 1, ["record"], [], [], []), ("c", None, None, "negative", 3, [], [], [], [])]
    rows_ = spark.createDataFrame([*odd, odd[1], odd[3]], columns)
    summaries.summarise(rows_, str(tmp_path / "kept"))
    same_answers(spark, rows_, str(tmp_path / "kept"))


@pytest.mark.parametrize("block", [7, 1 << 22])
def test_bitmaps_of_many_texts(monkeypatch, block):
    monkeypatch.setattr(gram_index, "_BLOCK", block)
    rnd = random.Random(8)
    texts = [None if rnd.random() < 0.1 else "".join(rnd.choice("aBcé ") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    files = [f"f{rnd.randrange(3)}" for _ in texts]
    batch = pa.RecordBatch.from_pydict({"file": files, "text": pa.array(texts, pa.string())})
    found = pa.Table.from_batches(gram_index._bitmaps(iter([batch.slice(0, 100), batch.slice(100)]))).to_pylist()
    for row in found:
        want = {int(p) for f, t in zip(files, texts) if f == row["file"] and t for p in gram_index._places(t.encode())}
        assert set(np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")).tolist()) == want
    assert len(found) == 3


def test_grams_of_many_texts_are_hashed_together(monkeypatch):
    calls = []
    monkeypatch.setattr(gram_index, "_hashed", lambda codes, hashed=gram_index._hashed: calls.append(1) or hashed(codes))
    list(gram_index._bitmaps(iter([pa.RecordBatch.from_pydict({"file": ["f"] * 1000, "text": ["some text"] * 1000})])))
    assert len(calls) == 1

import os
import time
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tonegrain.jobs import process_files
from tonegrain.operators.records import chunk_records
from tonegrain.sources.lines import read_chunks
from tonegrain.sources.tables import read_records
from tonegrain.streaming import live

COLUMNS = ["file_name", "chunk_index", "chunk_text", "sentiment_score", "sentiment_label", "tags", "word_count"]


def fingerprint(df):
    return sorted(repr(tuple(r)) for r in df.select(*COLUMNS).collect())


def test_stream_equals_batch(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    name = f"score-{uuid.uuid4()}"      # the checkpoint folder may outlive a test run
    for n in (3, 25, 700):
        (inbox / f"f{n}.txt").write_text("\n\n".join(f"line {i} is very good" if i % 3 else "not good at all" for i in range(n)))
    files = live.arriving_files(spark, str(inbox), max_files_per_trigger=1)
    records = live.with_progress(live.score_stream(files, F.lit("b1")))
    query = live.start_append(records, out, name)
    assert query.awaitTermination(120)
    seen = [p.observedMetrics["progress"].chunks for p in query.recentProgress if "progress" in (p.observedMetrics or {})]
    batch = read_chunks(spark, str(inbox)).withColumns({"batch_id": F.lit("b1"), "processed_at": F.current_timestamp()})
    expected = fingerprint(chunk_records(batch))
    assert fingerprint(read_records(spark, out)) == expected and sum(seen) == len(expected)

    # A second run picks up only the new file.
    (inbox / "late.txt").write_text("superb")
    query = live.start_append(live.score_stream(live.arriving_files(spark, str(inbox)), F.lit("b1")), out, name)
    assert query.awaitTermination(120)
    assert read_records(spark, out).count() == len(expected) + 1

    # Batch jobs and streams fill one table.
    other = tmp_path / "other.txt"
    other.write_text("a fine day")
    process_files(spark, str(other), out, "b2")
    assert read_records(spark, out).count() == len(expected) + 2 and read_records(spark, out, "b2").count() == 1


@pytest.fixture()
def feed(spark, tmp_path):
    """A stream over parquet files that are read one after the other."""
    schema = "file_name string, chunk_text string, sentiment_score double, processed_at timestamp"
    base = datetime(2024, 1, 1)
    batches = [
        [("f", "a", 0.5, base), ("f", "a", 0.5, base + timedelta(hours=1)), ("f", "b", 0.1, base + timedelta(hours=2))],
        [("f", "c", -0.5, base + timedelta(days=3))],
        [("g", "y", 0.0, base + timedelta(days=4))],
        [("f", "late", 1.0, base + timedelta(hours=3)), ("f", "c", -0.5, base + timedelta(days=3, hours=1))],
        [("g", "z", 0.0, base + timedelta(days=9))],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        time.sleep(1.1)     # files are taken by modification time
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))


def run(df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name).collect()


def test_windows_leave_late_rows_out(spark, feed):
    rows = {r.window_start.day: (r.n, r.avg_score) for r in run(live.score_by_window(feed, "1 day", "1 day"), "win")}
    # Day 1 was closed when its late row arrived; the last window is still open.  A row
    # counts as late by the watermark of the batch before.
    assert rows[1][0] == 3 and round(rows[1][1], 4) == 0.3667
    assert rows[4] == (2, -0.5) and 10 not in rows


def test_repeats_are_dropped(spark, feed):
    texts = sorted(r.chunk_text for r in run(live.drop_repeats(feed, "1 day"), "uniq"))
    assert texts == ["a", "b", "c", "y", "z"]

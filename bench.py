"""Time the headline queries on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query runs once to warm up and then three times into a sink that keeps nothing; the
median counts.  ``$BENCH_SF_DIR`` names the folder of the input tables.  ``core_scaling`` holds
the time of the scorer on 1, 2, 4 ... cores, each in a process of its own.
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tonegrain.functions.patterns import pattern_matches, tags  # noqa: E402
from tonegrain.functions.scoring import sentiment  # noqa: E402
from tonegrain.jobs import score_files  # noqa: E402
from tonegrain.operators import maintain, search, stats  # noqa: E402
from tonegrain.operators.store import write_chunks  # noqa: E402
from tonegrain.plans.queries import queries  # noqa: E402
from tonegrain.plans.tables import document_chunks_scored, feedback_lines_scored  # noqa: E402
from tonegrain.session import local_session  # noqa: E402
from tonegrain.sources.tables import read_records  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
REGISTERED = [
    "q_line_records", "q_chunk_records", "q_feedback_chunk_records", "q_stats", "q_stats_by_batch",
    "q_top_positive", "q_keywords", "q_score_histogram", "q_score_trend", "q_search_keyword",
    "q_search_page", "q_dedup", "q_html_sentences", "q_json_values_line",
    "q_search_label", "q_search_score_range", "q_search_combined", "q_lexicon_join", "q_conversation_stats",
    "q_page_sentiment", "q_scored_labels",
]


def median_time(run, repeats: int = 3) -> float:
    run()
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cached_documents(spark, cpus: int):
    """Document texts in memory, without the cost of the given single-row-group file."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").repartition(2 * cpus).cache()
    docs.count()
    return docs


def scorer_time(cpus: int) -> float:
    docs = cached_documents(local_session(cpus, shuffle_partitions=2 * cpus), cpus)
    return median_time(lambda: drain(docs.select(sentiment("text"))), 1)


def core_scaling() -> dict[str, float]:
    cores = [n for n in (1, 2, 4, 8, 16) if n <= CPUS]
    run = lambda n: subprocess.run([sys.executable, __file__, "--scorer", str(n)], capture_output=True, text=True)
    return {str(n): float(run(n).stdout.split()[-1]) for n in cores}


def main() -> None:
    scaling = core_scaling()
    spark = local_session(CPUS, shuffle_partitions=2 * CPUS)
    spark.sparkContext.setLogLevel("ERROR")

    registered = queries()
    timed = {name: median_time(lambda q=registered[name]: drain(q(spark, SF_DIR))) for name in REGISTERED}

    # What the parts of a record cost, each alone.
    docs = cached_documents(spark, CPUS)
    n_docs = docs.count()
    timed["scorer_documents_cached"] = median_time(lambda: drain(docs.select(sentiment("text"))))
    timed["patterns_documents_cached"] = median_time(lambda: drain(docs.select(pattern_matches("text"))))
    timed["tags_documents_cached"] = median_time(lambda: drain(docs.select(tags("text"))))

    # Load, chunk, score and write, then the read side over the stored table.
    scratch = tempfile.mkdtemp(prefix="bench-")
    stored = f"{scratch}/chunks"
    timed["score_and_store"] = median_time(lambda: write_chunks(document_chunks_scored(spark, SF_DIR), stored), 1)
    write_chunks(feedback_lines_scored(spark, SF_DIR), f"{scratch}/lines")
    chunks, lines = read_records(spark, stored), read_records(spark, f"{scratch}/lines")

    # The same text as files: chunked inside their rows, and by splits.
    files = f"{scratch}/files"
    spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").repartition(CPUS).write.text(files)
    n_bytes = sum(os.path.getsize(f"{files}/{f}") for f in os.listdir(files) if f.endswith(".txt"))
    timed["files_whole"] = median_time(lambda: drain(score_files(spark, files, "b", "text")), 2)
    timed["files_by_splits"] = median_time(lambda: drain(score_files(spark, files, "b", "text", whole_file_limit=0)), 2)

    timed["stored_stats"] = median_time(lambda: drain(stats.statistics(lines)))
    timed["stored_top_words"] = median_time(lambda: drain(stats.top_words(lines, "positive")))
    timed["stored_search_page"] = median_time(lambda: drain(search.page(search.search(lines, keyword="bank"), 2)))
    timed["stored_keywords"] = median_time(lambda: drain(stats.keywords(chunks)))
    timed["stored_dedup"] = median_time(lambda: drain(maintain.dedup(lines)))

    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": CPUS, "documents": n_docs,
        "core_scaling": scaling,
        "files_mb_per_sec": {k: round(n_bytes / 1e6 / timed[k], 1) for k in ("files_whole", "files_by_splits")},
    }))


if __name__ == "__main__":
    if sys.argv[1:2] == ["--scorer"]:
        print(scorer_time(int(sys.argv[2])))
    else:
        main()

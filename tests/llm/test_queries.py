"""The registered queries against their SQL, and the pipeline against its stages' rules."""

import base64
import glob
import hashlib
import os
import re
import zlib
from array import array
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
import tokenizers

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.brute import similar
from tonegrain.llm import oracle, queries as registered


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_all_are_registered():
    names = set(registered.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert names | {"pipeline"} <= set(entry_points.queries()) and set(oracle.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, small, duck, name):
    df = registered.queries()[name](spark, small)
    result = duck.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert got == sorted(result.fetchall(), key=repr)


#: Result columns of the queries that have no SQL, or whose test of their own does not state them.
TYPES = {
    "op2_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op3_ngram_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op5_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op6_vector_range_join": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                         "base_failed boolean, kept boolean",
    "op8_token_records": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op11_benchmark_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op12_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
}


@pytest.mark.parametrize("name", sorted(TYPES))
def test_columns_and_types(spark, small, name):
    got = dict(registered.queries()[name](spark, small).dtypes)
    assert {c: got.get(c) for c in (t.split()[0] for t in TYPES[name].split(", "))} == dict(t.split() for t in TYPES[name].split(", "))


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def test_byte_bpe_query(spark, small, texts):
    """Against the library that defines the ranks."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken")) as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in registered.queries()["op2_byte_bpe"](spark, small).collect():
        text = texts[r["doc_id"]]["text"] or ""
        ids = encoding.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_mixing_query(spark, small, texts):
    rows = registered.queries()["op5_mixing"](spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        source, size = texts[r["doc_id"]]["source"], len(_words(texts[r["doc_id"]]["text"]))
        assert r["size"] == size and r["taken"] in (0, size, 2 * size)
        sizes[source] += size
        taken[source] += r["taken"]
        target[source] = r["target"], r["source_size"]
    assert all(target[s] == (target[s][0], sizes[s]) and target[s][0] <= 2 * sizes[s] + 1e-6 for s in sizes)
    assert abs(sum(t for t, _ in target.values()) - 1.5 * sum(sizes.values())) < 1e-3
    largest = Counter()
    for r in rows:
        largest[texts[r["doc_id"]]["source"]] = max(largest[texts[r["doc_id"]]["source"]], r["size"])
    assert all(abs(taken[s] - target[s][0]) <= largest[s] for s in sizes)


def test_quality_query(spark, small, texts):
    for r in registered.queries()["op7_quality_rules"](spark, small).collect():
        text = texts[r["doc_id"]]["text"] or ""
        words, lines = _words(text), [x for x in text.split("\n") if _words(x)]
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(again))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(again) > 50 * len(words)) and not (r["base_failed"] and r["kept"])


def test_token_records_query(spark, small, texts):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for r in sorted(registered.queries()["op8_token_records"](spark, small).collect(), key=lambda r: r["doc_id"]):
        ids = [*tokenizer.encode(texts[r["doc_id"]]["text"] or "", add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(array("I", ids).tobytes()))
        start += len(ids)


@pytest.mark.parametrize("rows", [[], [
    (None, None, None, None), (1, None, "en", "s"), (2, "", "en", "s"), (3, "the house is green and the dog runs", "en", "s"),
    (3, "the house is green and the dog runs", "en", "s"), (None, "the house is green and the dog runs", "en", None), (None, "the house and the garden", None, "t"),
    (4, "the cat " * 20_000, "en", "t"), *[(i, f"the house with the dog number {'i' * i} and the cat", "en", "t") for i in range(10, 20)]]])
def test_pipeline_on_odd_tables(spark, documents, rows, tmp_path):
    """Empty, null, repeated, very long and clashing input: every stage runs, and keeps the columns of documents."""
    docs = documents(*rows, more=True)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
        if name == "language_id":
            assert docs.count() == sum(bool(r[1]) for r in rows)
    assert (docs.count() > 0) == bool(rows)


def test_pipeline_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        kept[name] = docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = {name: [r["doc_id"] for r in df.select("doc_id").collect()] for name, df in kept.items()}
    assert sorted(ids["language_id"]) == sorted(ids["start"])  # every given text has letters
    assert sorted(ids["line_dedup"]) == sorted(ids["language_id"])
    texts = {r["doc_id"]: r["text"] for r in kept["line_dedup"].collect()}
    assert set(ids["ngram_jaccard_join"]) == {v[1] for v in similar(texts).values()}
    assert set(ids["mixing"]) <= set(ids["ngram_jaccard_join"]) and max(map(ids["mixing"].count, ids["mixing"])) <= 2
    assert sorted(ids["byte_bpe"]) == sorted(ids["mixing"])

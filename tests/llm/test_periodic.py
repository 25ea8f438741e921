"""Periodic runs against a brute-force reading of the rule, and the registered query as a whole."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tonegrain.llm import periodic, queries
from tonegrain.llm.common import hashed_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Every run by trying all lags at all places."""
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            run = words[start:i + q]
            if len(run) >= max(6, 4 * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                found.append((start, len(run), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def soup(rng):
    """Words of a small alphabet with repetitions of repetitions in them."""
    words = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 3)):
        part = [rng.choice("abcxyz") for _ in range(rng.randint(1, 5))]
        at = rng.randint(0, len(words))
        words[at:at] = (part * rng.randint(2, 9))[:rng.randint(1, 40)]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(13)
    texts = [soup(rng) for _ in range(3000)]
    found = periodic.runs_of(*hashed_words([" ".join(t).encode() for t in texts], lower=False))
    assert [list(r) for r in found] == [brute(t) for t in texts]
    assert sum(map(bool, found)) > 500 and sum(len(r) > 1 for r in found) > 100


@pytest.mark.parametrize("alphabet, size", [(2, 3000), (1, 5000), (3, 2000)])
def test_few_words_in_long_texts(alphabet, size):
    rng = np.random.default_rng(alphabet)
    words = rng.integers(0, alphabet, size).astype(np.uint64)
    words[700:1500] = words[700:850].tolist() * 5 + words[700:750].tolist()
    assert sorted(periodic.lag_scan(words), key=lambda r: (r[0], r[2])) == brute(words.tolist())


def test_segments_are_split_to_stability():
    # "x" splits, then "b" occurs too rarely on either side, then "a" does
    words = "a a b a x a b a a b y".split()
    assert periodic.segments(*hashed_words([" ".join(words).encode()], lower=False)) == []
    words, marks = hashed_words([b"q a a a a a a z", b"", b"b b b b b b"], lower=False)
    assert sorted(periodic.segments(words, marks)) == [(1, 7), (8, 14)]


def test_long_texts_take_no_square_time():
    rng = np.random.default_rng(0)
    words = np.concatenate([np.zeros(200_000, dtype=np.uint64), rng.integers(0, 60_000, 200_000).astype(np.uint64) + np.uint64(1)])
    found = periodic.runs_of(words, np.array([0, len(words)]))
    assert found == [[(0, 200_000, 1)]]


def test_edges_and_other_columns(spark, documents):
    long = "w1 w2 w3 " * 30_000 + "end"
    docs = documents((1, None), (2, ""), (3, " \t\n"), (4, "a b " * 4 + "c"), (4, "a b " * 4 + "c"), (None, "x  x x\tx x\nx"), (5, long), more=True)
    out = periodic.collapse_runs(docs)
    assert out.columns == [*docs.columns, "runs"]
    got = {(r["doc_id"], r["text"]): [tuple(x) for x in r["runs"]] for r in out.collect()}
    assert got == {
        (1, ""): [], (2, ""): [], (3, ""): [], (4, "a b c"): [(0, 8, 2)], (None, "x"): [(0, 6, 1)], (5, "w1 w2 w3 end"): [(0, 90_000, 3)]}
    same = [c for c in docs.columns if c != "text"]
    assert rows_of(out, *same) == rows_of(docs, *same)
    assert periodic.collapse_runs(documents()).collect() == []
    with pytest.raises(ValueError):
        periodic.collapse_runs(docs.withColumn("Runs", F.lit(1)))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    names = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words], dtype=np.uint64)
    runs = brute(words) if n <= 400 else sorted(periodic.lag_scan(names), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_registered_query(spark, small):
    df = queries.queries()["op13_periodic_runs"](spark, small)
    assert df.dtypes == [
        ("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
        ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = [expected(r["doc_id"], r["text"]) for r in docs]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 5

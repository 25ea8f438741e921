import random
from fractions import Fraction

import pytest

from tests.llm.brute import similar
from tests.llm.conftest import rows_of
from tonegrain.llm import ngram_join
from tonegrain.llm.components import connected_components
from tonegrain.llm.ngram_join import drop_near_duplicates, near_duplicate_groups

WORDS = [f"w{i}" for i in range(400)]


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def _corpus(seed):
    """Groups of copies with more and more edits, a passage that many share, and short texts."""
    rng = random.Random(seed)
    texts, passage = [], [rng.choice(WORDS) for _ in range(30)]
    for size in (6, 20, 60, 120):
        base = [rng.choice(WORDS) for _ in range(size)]
        texts += [" ".join(base)] * 3 + [" ".join(_edited(rng, base, k % 5)) for k in range(14)]
    texts += [" ".join(passage + [rng.choice(WORDS) for _ in range(rng.randrange(12))]) for _ in range(25)]
    texts += ["a b c", "A  b\tC", "a b c d", "a", "", "  \n ", "É b c d e f", "é b c d e f", "x y z u v", "X Y z u\nv"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed", range(2))
def test_groups_equal_brute_force(spark, documents, seed):
    docs = _corpus(seed)
    got = near_duplicate_groups(documents(*docs.items(), more=True).repartition(3))
    want = [(i, *v) for i, v in similar(docs).items()]
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)


def test_hot_grams_change_nothing(documents, monkeypatch):
    docs = _corpus(5)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 3)
    monkeypatch.setattr(ngram_join, "FLUSH_GRAMS", 500)
    got = near_duplicate_groups(documents(*docs.items()).repartition(2))
    assert rows_of(got, "doc_id", "component_id") == sorted(((i, v[1]) for i, v in similar(docs).items()), key=repr)


def test_other_threshold(documents):
    docs = _corpus(7)
    got = near_duplicate_groups(documents(*docs.items()), Fraction(1, 2))
    assert rows_of(got, "doc_id", "component_id") == sorted(((i, v[1]) for i, v in similar(docs, 50, 100).items()), key=repr)


def test_edges(documents):
    long = " ".join(f"word{i}" for i in range(60_000))
    docs = documents((5, long), (4, long + " more"), (3, None), (2, ""), (None, "one two three"), (9, "one two THREE"), (9, "one two three"))
    got = rows_of(near_duplicate_groups(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted([
        (5, 59_996, 4), (4, 59_997, 4), (3, 0, 3), (2, 0, 2), (None, 1, 9), (9, 1, 9), (9, 1, 9)], key=repr)
    assert near_duplicate_groups(documents()).collect() == []


def test_one_of_each_group_stays(documents):
    docs = documents((1, "a b c"), (2, "a b C"), (3, "x"), (4, None), more=True)
    kept = drop_near_duplicates(docs)
    assert rows_of(kept, "doc_id", "text", "key") == [(1, "a b c", "x"), (3, "x", "x"), (4, None, "x")]


def test_rows_of_null_and_repeated_ids(documents):
    near = " ".join(f"w{k}" for k in range(60))
    rows = [
        (None, near), (None, near), (None, near + " x"), (4, near), (4, near), (4, "clean text"), (6, near + " y"), (6, "other clean text"),
        (None, "only null"), (None, "only  NULL"), (None, None), (None, ""), (8, ""), (8, None), (9, "p q"), (9, "p q"), (9, "P  q"),
        (12, near), (12, near + " z"), (13, "alone"), (None, "alone"), (14, "fine")]
    docs = documents(*rows, more=True)
    kept = drop_near_duplicates(docs.repartition(4))
    assert kept.dtypes == docs.dtypes
    got = [(i, (t or "").lower().replace("  ", " "), k) for i, t, k in rows_of(kept, "doc_id", "text", "key")]
    assert sorted(got, key=repr) == sorted([(i, t, "x") for i, t in [
        (4, near), (4, "clean text"), (6, "other clean text"), (None, "only null"), (None, ""), (None, ""), (8, ""), (8, ""), (9, "p q"),
        (13, "alone"), (14, "fine")]], key=repr)
    assert rows_of(kept, "doc_id", "text") == rows_of(drop_near_duplicates(docs.coalesce(1)), "doc_id", "text")
    assert drop_near_duplicates(documents()).collect() == []


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1100)] + [(-5, -5), (7, 2000), (2000, 7)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    rows = {r["node"]: r["component"] for r in got.collect()}
    assert got.count() == len(rows)
    assert {k: v for k, v in rows.items() if v == 0}.keys() == {*range(301), 2000}
    assert {k for k, v in rows.items() if v == 1000} == set(range(1000, 1100))

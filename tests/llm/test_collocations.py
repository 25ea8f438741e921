"""Phrase mining against a plain reading of the rules; the registered query is compared with its SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.brute import lowered
from tonegrain.llm import bitset, collocations


def brute(docs, least, longest, first):
    """All rows of the result from (text, lang) pairs, counting phrases as tuples."""
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {key: n for key, n in f.items() if n >= least}
    rows = {}
    for (lang, p), a in often.items():
        inside = any(
            la == lang and n >= a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
            for (la, q), n in often.items())
        if len(p) >= 2 and not inside:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in rows.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:first]))


def soup(rng, n):
    phrases = ["a b c d e f", "x y", "É ß x", "the of", "the"]
    return "".join(rng.choice(phrases + list("abcxyzQ")) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", ""]) for _ in range(n))


@pytest.fixture(autouse=True)
def small_parts(monkeypatch):
    """Several parts and flushes, and prefixes that count as hot, on small tables too."""
    monkeypatch.setattr(collocations, "PART_ENTRIES", 64)
    monkeypatch.setattr(collocations, "HOT_ENTRIES", 24)


@pytest.mark.parametrize("least, longest, first", [(3, 5, 1000), (2, 3, 7), (1, 5, 40), (4, 2, 1000)])
def test_equals_brute_force(documents, least, longest, first):
    rng = random.Random(least)
    docs = [(i, soup(rng, rng.randint(0, 30)), rng.choice(["l1", "l1", "l2", None, "und", ""]), "s") for i in range(40)]
    docs += [(1, None, "l1", None), (2, "", None, None), (3, "a b " * 60, "l1", "s"), (3, "a b " * 60, "l1", "s")]
    out = collocations.collocations(documents(*docs, more=True), least, longest, first)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string", "bigint", "bigint", "bigint", "bigint", "bigint"]
    want = brute([(t, lang) for _, t, lang, _ in docs], least, longest, first)
    assert sorted(map(tuple, out.collect())) == want and len(want) >= 7


def test_long_text_and_flushes(documents, monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH_ENTRIES", 50)
    rng = random.Random(0)
    docs = [(i, soup(rng, 3000 if i == 3 else 200), "l", "s") for i in range(8)]
    got = collocations.collocations(documents(*docs).coalesce(1), 20).collect()
    assert sorted(map(tuple, got)) == brute([(t, "l") for _, t, _, _ in docs], 20, 5, 2000)


def test_products_beyond_64_bits(spark, documents):
    """The score of a phrase that is all of a huge corpus keeps every digit."""
    row = spark.sql("SELECT (1000 * (cast(30000000000001L AS decimal(19,0)) * cast(90000000000007L AS decimal(19,0)))) "
                    "div (cast(30000000000003L AS decimal(19,0)) * cast(123456789L AS decimal(19,0))) AS s").first()
    assert row["s"] == 1000 * 30000000000001 * 90000000000007 // (30000000000003 * 123456789)


def test_empty_table(documents):
    assert collocations.collocations(documents()).collect() == []
    assert collocations.collocations(documents((1, None), (2, " .,")), 1).collect() == []


def test_filter_never_denies_and_is_bounded(spark, monkeypatch):
    names = [int(x) for x in np.random.default_rng(3).integers(-2**63, 2**63 - 1, 5000)]
    df = spark.createDataFrame([(n,) for n in names], "id long")
    values = np.array(names, dtype=np.int64).view(np.uint64)
    other = np.random.default_rng(4).integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(2)
    bits = bitset.filter_of(df, 5000)
    assert bitset.has(bits, values).all() and bitset.has(bits, other).mean() < 0.05
    monkeypatch.setattr(bitset, "MOST_LOG", 13)
    small = bitset.filter_of(df, 5000)
    assert len(small) == 1024 and bitset.has(small, values).all()

"""The positional index against plain Python on small soups; the registered query is compared with its SQL."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.llm.brute import lowered
from tonegrain.llm import positions

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id string, text string, doc_id int, row int"


def words(text):
    return WORD.findall(lowered(text or ""))


def report(doc, items, width):
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        v = words(text)
        k = min(width, len(v))
        runs = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if runs else 0):
            if tuple(w[i:i + k]) in runs:
                hit |= set(range(i, i + k))
                found |= {item} - {None}
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def items_of(spark, *rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], ITEMS)


def soup(rng, letters, n):
    return " ".join(rng.choice(letters) for _ in range(n))


def test_report_equals_brute_force(spark, documents):
    rng = random.Random(11)
    items = [(f"i{k}", soup(rng, "abcdé", rng.randint(0, 9))) for k in range(12)] + [("i3", "A, a. A"), ("i3", "a a a"), (None, "e e e e"), ("x", None), ("one", "zz")]
    docs = [(k, soup(rng, ["a", "B", "c", "D", "é", "e"], rng.randint(0, 60))) for k in range(60)]
    docs += [(None, None), (99, ""), (7, "zz e e e e"), (7, "zz e e e e"), (8, "q " * 30_000 + "zz")]
    out = positions.contamination(documents(*docs, more=True), items_of(spark, *items), width=4)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = [(i, *report(t, items, 4)) for i, t in docs]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert 20 < sum(w[-1] for w in want) < len(want)
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)


def test_empty_tables(spark, documents):
    clean = (1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)
    assert [tuple(r) for r in positions.contamination(documents((1, "a b")), items_of(spark)).collect()] == [clean]
    assert positions.contamination(documents(), items_of(spark, ("i", "a b"))).collect() == []


def test_phrase_and_proximity_matches(spark, documents):
    rng = random.Random(5)
    texts = [soup(rng, "abcdefg", rng.randint(1, 50)) for _ in range(30)] + ["g" * 3]
    phrases = ["a b", "c c d", "e f a g", "ggg", "b a b"]
    index = positions.build_index(documents(*enumerate(texts)))
    asked = positions.phrases_of(items_of(spark, *((p, p) for p in phrases)), 4)
    lists = positions.ranked(index, asked)
    name = {r["phrase"]: r["item"] for r in asked.collect()}
    doc = {r["row"]: r["id"] for r in positions.indexed_rows(index).collect()}
    found = {(name[r["phrase"]], doc[r["row"]], r["start"]) for r in positions.phrase_matches(index, lists).collect()}
    rarest = {name[r["phrase"]]: r["lists"][0]["off"] for r in lists.collect()}
    want, near = set(), set()
    for p in phrases:
        v = p.split()
        for i, t in enumerate(texts):
            w = t.split()
            want |= {(p, i, s) for s in range(len(w) - len(v) + 1) if w[s:s + len(v)] == v}
            near |= {(p, i, s) for s in range(len(w)) if w[s] == v[rarest[p]] and set(v) <= set(w[max(0, s - 4):s + 5])}
    assert found == want and len(want) > 10
    got = {(name[r["phrase"]], doc[r["row"]], r["pos"]) for r in positions.proximity_matches(index, lists, 5).collect()}
    assert got == near and len(near) > len(want)


def test_the_index_posts_every_word_once(spark, documents):
    index = positions.build_index(documents((5, "a b a"), (None, None), (6, "x-y"))).collect()
    terms = {w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in "abxy"}
    assert sorted((r["term"], r["pos"]) for r in index if r["term"] is not None) == sorted(
        [(terms["a"], 0), (terms["b"], 1), (terms["a"], 2), (terms["x"], 0), (terms["y"], 1)])
    assert sorted(((r["id"], r["pos"]) for r in index if r["term"] is None), key=repr) == sorted([(5, 3), (None, 0), (6, 2)], key=repr)

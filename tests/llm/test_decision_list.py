import random
import re

import numpy as np

from tests.conftest import DATA
from tests.llm.brute import WORD
from tests.llm.conftest import rows_of
from tonegrain.llm import decision_list
from tonegrain.llm.decision_list import FEATURES, Condition, _covered, judge, kept_by, learn, learn_list, text_stats, with_features
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, hit = {}, set()
    for k in range(len(words) - 2):
        seen.setdefault(tuple(words[k:k + 3]), []).append(k)
    for at in seen.values():
        if len(at) > 1:
            hit |= {k + j for k in at for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(lines), len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)))


def test_stats_equal_plain_reading(documents):
    rng = random.Random(2)
    alphabet = ["a", "b", "Ab", "é", "日本", "#", "|x", "!", "?", " ", " ", " ", "\n", "\t", " ", "🙂", "word", "\x0b"]
    docs = {i: "".join(rng.choices(alphabet, k=rng.randrange(60))) for i in range(150)}
    docs |= {200: None, 201: "", 202: "a b c " * 40_000, 203: " \n", 204: "a b", 205: "x y z x y z"}
    got = text_stats(documents(*docs.items(), (None, "a a a a"), (205, "x y z x y z"), more=True).repartition(3))
    want = [(i, *plain(t)) for i, t in docs.items()] + [(None, *plain("a a a a")), (205, *plain("x y z x y z"))]
    assert rows_of(got, *got.columns) == sorted(want, key=repr)


def test_learned_list_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    rules = learn(docs, labels.where(~held))
    assert rules and all(c.feature in FEATURES for r in rules for c in r)
    found = judge(docs, rules).join(labels.where(held), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in found}
    assert n.get((0, False), 0) > 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))
    base = judge(docs, []).join(labels.where(held), "doc_id").where("quality = 1 and base_failed").count()
    assert n.get((1, False), 0) - base <= 0.01 * n[1, True]


def test_rules_are_pruned_and_precise():
    rng = np.random.default_rng(7)
    values = {"x": rng.random(2000), "noise": rng.random(2000)}
    bad = (values["x"] > 0.7) | (rng.random(2000) < 0.01)
    rules = learn_list(values, bad)
    covered = np.any([_covered(r, values) for r in rules], axis=0)
    assert (covered & (values["x"] > 0.7)).sum() > 0.9 * (values["x"] > 0.7).sum() and bad[covered].mean() > 0.97
    assert learn_list(values, np.zeros(2000, dtype=bool)) == [] and learn_list(values, rng.random(2000) < 0.5) == []
    assert learn_list({"x": np.array([]), "noise": np.array([])}, np.array([], dtype=bool)) == []


def test_list_becomes_one_conditional(spark):
    rules = [(Condition("a", True, 2.0), Condition("b", False, 1.0)), (Condition("a", False, 0.0),)]
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 2.0), (0.0, 5.0), (1.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(kept_by(rules)).collect()] == [False, True, False, True]
    assert [r[0] for r in df.select(kept_by([])).collect()] == [True] * 4


def test_labels_with_gaps(spark, documents):
    docs = documents(*[(i, ("good words here " if i % 2 else "BAD!! WORDS!! ") + " ".join(f"w{k}" for k in range(i, i + 60))) for i in range(80)], more=True)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(80)] + [(1, 0, "x"), (None, 1, "x"), (500, 1, "x"), (3, None, "x")], "doc_id long, quality int, kind string")
    rules = learn(docs, labels)
    assert {r["kept"] for r in judge(docs, rules).where("doc_id % 2 = 0").collect()} == {False}
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert learn(docs, empty) == [] and judge(documents(), []).collect() == []
    assert with_features(text_stats(documents((1, None)))).first()["chars_per_word"] == 0.0


def test_a_labelled_id_of_many_rows_teaches_once(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(decision_list, "learn_list", lambda values, bad, **_: seen.append(len(bad)) or [])
    words = [" ".join(f"w{k}" for k in range(i, i + 60)) for i in range(50)]
    docs = documents(*[(1, w + "!" * i) for i, w in enumerate(words)], *[(1, words[0])] * 50, *[(i, words[i]) for i in range(2, 20)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 20)], "doc_id long, quality int")
    learn(docs, labels)
    learn(docs.repartition(5), labels, most=7)
    assert seen == [19, 7]

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np

from tests.conftest import DATA
from tests.llm.conftest import rows_of
from tonegrain.llm import language, queries
from tonegrain.llm.language import Encoder, identify, learn, learn_letters, with_language, held_out
from pyspark.sql import functions as F

EN = "the house is green and the dog runs through the garden with them "
FR = "la maison est verte et le chien court dans le jardin avec eux "


def _training():
    return [(i, (EN if i % 2 else FR) * (1 + i % 3), "en" if i % 2 else "fr") for i in range(30)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.sum(F.when(F.col("lang_pred") == F.col("lang"), 1).otherwise(0)), F.count(F.lit(1))).first()
    assert n > 250 and right / n > 0.98


def test_edges(documents):
    rows = [*_training(), (100, None), (101, ""), (102, "123 !? 45"), (103, FR * 3000), (None, EN), (104, EN), (104, EN)]
    found = {}
    for r in identify(documents(*rows, more=True)).collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["held_out"], 0 <= r["score"] <= 1))
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert [found[i][0][0] for i in (100, 101, 102)] == ["und"] * 3
    assert found[103][0][0] == "fr" and found[None][0][0] == "en" and [x[0] for x in found[104]] == ["en", "en"]
    assert all(x[2] for xs in found.values() for x in xs)


def test_empty_and_nothing_to_learn_from(documents):
    assert identify(documents()).collect() == []
    assert rows_of(identify(documents((1, EN), (2, None))), "doc_id", "lang_pred", "score") == [(1, "und", 0.0), (2, "und", 0.0)]


def test_prediction_ignores_labels_and_ids(documents):
    rows = _training()
    moved = [(i, t, x if zlib.crc32(str(i).encode()) % 3 != 1 else "xx", "s") for i, t, x in rows]
    a, b = identify(documents(*rows)), identify(documents(*moved))
    assert rows_of(a, "doc_id", "lang_pred", "score") == rows_of(b, "doc_id", "lang_pred", "score")


def test_filter_keeps_columns(documents):
    kept = with_language(documents(*_training(), (100, "77 88"), more=True))
    assert kept.columns == documents(more=True).columns and kept.count() == 30


def test_bundles_add_up():
    encoder = Encoder(64)
    texts = ["ab ba", "Éa ß", "日本語 abc", "x"]
    single = np.stack([encoder.bundles([t])[0] for t in texts])
    assert (encoder.bundles(texts) == single).all()
    assert (encoder.bundles(texts, np.array([0, 1, 0, -1]), 2) == np.stack([single[0] + single[2], single[1]])).all()


def test_learning_adds_over_tasks(documents):
    docs = documents(*_training())
    one, many = learn(docs.coalesce(1), ~held_out()), learn(docs.repartition(7), ~held_out())
    assert one.keys() == many.keys() and all((one[k] == many[k]).all() for k in one)


def test_texts_of_unlearned_letters_go_and_short_ones_stay(documents):
    rng = np.random.default_rng(4)
    foreign = []
    for low, high in ((0x430, 0x44F), (0x3B1, 0x3C9), (0x4E00, 0x9FA5)):
        for _ in range(100):
            words = ["".join(map(chr, rng.integers(low, high, rng.integers(1, 9)))) for _ in range(rng.integers(1, 40))]
            foreign.append(" ".join(words))
    short = sorted({*EN.split(), *FR.split(), "A.", "Le", "Jet.", "xon", "thog wuns"})
    rows = [*_training(), *[(1000 + i, t, "en") for i, t in enumerate(short)]]
    # Held out, so that nothing is learned from them.
    free = (i for i in range(5000, 10 ** 6) if zlib.crc32(str(i).encode()) % 3 == 1)
    strange = [(next(free), t, "xx") for t in foreign]
    kept = rows_of(with_language(documents(*rows, *strange)), "doc_id")
    assert kept == sorted([(r[0],) for r in rows], key=repr)


def test_stray_letters_are_not_known(documents):
    rows = [(i, EN * 40 + ("Ж" if i == 0 else ""), "en") for i in range(30)]
    held = next(i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 3 == 1)
    bundles, letters = learn_letters(documents(*rows), F.lit(True))
    assert set(map(chr, letters.tolist())) == set(EN) - {" "}
    assert (bundles["en"] == learn(documents(*rows).repartition(5), F.lit(True))["en"]).all()
    assert rows_of(with_language(documents(*rows, (held, "ж" * 50, "xx"))), "doc_id") == sorted([(i,) for i in range(30)], key=repr)


def plain_bundle(encoder, text):
    """Bind, permute and bundle by loops."""
    total = [0] * encoder.dimensions
    letters = [ord(c.lower()[0]) if c.isalpha() else 0 for c in f" {text} "]
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b:
            x, y, z = (encoder._vector(v).tolist() for v in (a, b, c))
            for d in range(encoder.dimensions):
                total[d] += x[d - 2] * y[d - 1] * z[d]
    return total


def test_bundles_and_cosines_by_loops(monkeypatch):
    texts = ["Ab ba, ÀB!", "", "日本 日x", "77", "the dog the dog", "ǅ x" * 9]
    for letters, grams in ((1 << 20, 2048), (4, 3), (7, 1)):
        monkeypatch.setattr(language, "BLOCK_LETTERS", letters)
        monkeypatch.setattr(language, "BLOCK_GRAMS", grams)
        encoder = Encoder(48, seed=3)
        want = [plain_bundle(encoder, t) for t in texts]
        found, row, letter, n = encoder.tally(texts)
        assert found.tolist() == want
        counted = {}
        for i, c, k in zip(row.tolist(), letter.tolist(), n.tolist()):
            counted[i, chr(c)] = counted.get((i, chr(c)), 0) + k
        assert counted == {(i, c): k for i, t in enumerate(texts) for c, k in Counter(x.lower()[0] for x in t if x.isalpha()).items()}
    judge = language.Judge({"a": np.array(want[0]), "b": np.array(want[4])}, 48, 3)
    langs, scores = judge(encoder, texts)
    for text, lang, score in zip(want, langs, scores):
        dot = lambda x, y: sum(i * j for i, j in zip(x, y))
        cosines = {k: dot(text, v) / math.sqrt(dot(text, text) * dot(v, v)) if any(text) else 0 for k, v in (("a", want[0]), ("b", want[4]))}
        assert lang == (max(cosines, key=cosines.get) if any(text) else "und")
        assert abs(score - max(0, *cosines.values())) < 1e-5


def test_memory_of_a_long_text_in_a_large_script():
    """4 MB of random Han text: what is held at once does not follow the number of different trigrams."""
    text = "".join(map(chr, np.random.default_rng(1).integers(0x4E00, 0x9FA5, 1_400_000)))
    encoder = Encoder()
    tracemalloc.start()
    encoder.bundles([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250e6


def test_registered_query_types(spark, small):
    df = queries.queries()["op1_language_id"](spark, small)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    assert df.count() == spark.read.parquet(f"{small}/documents.parquet").count()

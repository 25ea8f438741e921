import numpy as np

from tests.llm.brute import WORD
from tests.llm.conftest import rows_of
from tonegrain.llm.mixing import flight, landing, mix, mixed_documents


def filled(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by sharing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if unit * w[s] >= cap * sizes[s]}
        if not full:
            return target | {s: unit * w[s] for s in open_}
        target |= {s: cap * sizes[s] for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def _rows():
    rng = np.random.default_rng(1)
    sources = ["b", "a", None, "ü", "Z", "hot"]
    picks = rng.choice(6, 900, p=[.1, .2, .1, .05, .05, .5])
    return [(i, "w " * int(rng.lognormal(3, 1)), "en", sources[p]) for i, p in enumerate(picks)]


def test_targets_and_totals(documents):
    rows = _rows()
    got = mix(documents(*rows, more=True)).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    want = filled(sizes)
    assert sorted(r["doc_id"] for r in got) == list(range(len(rows)))
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert abs(own[0]["target"] - want[s]) < 1e-6 and own[0]["source_size"] == sizes[s]
        assert abs(sum(r["size"] * r["times"] for r in own) - want[s]) <= 3
        assert all(r["times"] in (0, 1, 2) for r in own)
    assert abs(sum({r["source"]: r["target"] for r in got}.values()) - 1.5 * sum(sizes.values())) < 1e-6


def test_document_totals_are_balanced_too(documents):
    got = [r for r in mix(documents(*_rows())).collect() if r["source"] == "hot"]
    times = got[0]["target"] / got[0]["source_size"]
    assert abs(sum(r["times"] for r in got) / len(got) - times) < 0.02


def test_small_blocks_and_reruns(documents):
    docs = documents(*_rows())
    a = rows_of(mix(docs, block_units=40), "doc_id", "times")
    assert a == rows_of(mix(docs.repartition(7), block_units=40), "doc_id", "times")
    by_source = {}
    for r in mix(docs, block_units=40).collect():
        x = by_source.setdefault(r["source"], [0, r["target"]])
        x[0] += r["size"] * r["times"]
    assert all(abs(taken - target) <= 30 for taken, target in by_source.values())


def test_flight_keeps_the_constraints():
    rng = np.random.default_rng(0)
    words, ones, p = rng.integers(0, 50, 200).astype(float), np.ones(200), rng.random(200)
    flown = flight(p, ones, words, np.random.default_rng(1))
    assert ((flown > 0) & (flown < 1)).sum() <= 2
    assert abs((flown - p).sum()) < 1e-6 and abs(((flown - p) * words).sum()) < 1e-5
    assert set(landing(flown, ones, words)) <= {0.0, 1.0}
    drawn = np.mean([landing(flight(p[:30], ones[:30], words[:30], np.random.default_rng(k)), ones[:30], words[:30]) for k in range(600)], axis=0)
    assert np.abs(drawn - p[:30]).mean() < 0.08  # inclusion probabilities hold


def test_edges(documents):
    rows = [(1, None, None, "s"), (2, "", None, "s"), (3, "a " * 50_000, None, None), (None, "a b", None, "s"), (4, "x", None, "t"), (4, "x", None, "t")]
    got = {(r["doc_id"], r["source"]): r for r in mix(documents(*rows)).collect()}
    assert len(got) == 5 and got[4, "t"]["rows"] == 2 and got[1, "s"]["size"] == 0
    assert mix(documents()).collect() == [] and mix(documents((1, None), (2, " "))).count() == 2
    out = mixed_documents(documents(*rows, more=True))
    assert out.columns == documents(more=True).columns
    times = {k: r["times"] for k, r in got.items()}
    assert out.count() == sum(times[i, s] for i, _, _, s in rows)

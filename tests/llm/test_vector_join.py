import numpy as np
import pytest

from tests.llm.brute import components
from tests.llm.conftest import rows_of
from tonegrain.llm import vector_join
from tonegrain.llm.vector_join import near_vectors


def brute(rows, threshold=0.9):
    usable = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and any(v):
            usable[i] = np.array(v, dtype=np.float32).astype(float)
    links = [
        (a, b) for a in usable for b in usable if a < b and len(usable[a]) == len(usable[b])
        and usable[a] @ usable[b] / (np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])) >= threshold]
    part = components([i for i, _ in rows], links)
    n = {i: sum(i in x for x in links) for i, _ in rows}
    return sorted(((i, n[i], part[i], part[i] == i) for i, _ in rows), key=repr)


def _rows(n=400, dim=8):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, dim))
    vectors = [(centres[i % 12] + rng.normal(scale=.25, size=dim) if i % 3 else rng.normal(size=dim)).astype(np.float32).tolist() for i in range(n)]
    vectors[50:90] = [vectors[50]] * 40
    odd = [None, [0.0] * dim, [float("nan")] * dim, [None] * dim, [float("inf")] + [1.0] * (dim - 1), [], vectors[3][:4], [2 * x for x in vectors[3][:4]]]
    return list(enumerate(vectors + odd))


@pytest.mark.parametrize("cell", [10_000, 20])
def test_equal_to_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(vector_join, "CELL_VECTORS", cell)
    monkeypatch.setattr(vector_join, "BLOCK_VECTORS", max(10, cell // 2))
    monkeypatch.setattr(vector_join, "TASK_BLOCKS", 5)
    monkeypatch.setattr(vector_join, "SEEN_CLASSES", 30)
    rows = _rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, class int, dim string")
    assert rows_of(near_vectors(df.repartition(3)), "vec_id", "n_links", "component_id", "kept") == brute(rows)


def test_copies_reach_only_near_cells():
    rng = np.random.default_rng(0)
    units = vector_join._units(rng.normal(size=(3, 4)).repeat(50, axis=0) + rng.normal(scale=.02, size=(150, 4)))
    cells = vector_join.Cells(4, units[[0, 50, 100]], 0.1)
    distances, own = cells.nearest(units)
    cells.reach = np.array([distances[own == c, c].max() for c in range(3)])
    far = [(a, b) for a in range(3) for b in range(3) if a != b]
    assert not any(cells.may_meet(a, b) for a, b in far) and all(cells.may_meet(c, c) for c in range(3))
    assert sum(cells.copies(units[own == a], a, b).sum() for a, b in far) == 0  # far apart: nothing is compared


def test_pivots_are_far_apart():
    units = vector_join._units(np.array([[1, 0], [1, .01], [1, .02], [0, 1], [-1, 0], [0, -1.0]]))
    assert sorted(map(tuple, np.round(vector_join.far_apart(units, 4)).tolist())) == [(-1.0, 0.0), (0.0, -1.0), (0.0, 1.0), (1.0, 0.0)]
    assert len(vector_join.far_apart(units, 99)) == 6


def test_edges(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [9.0, 19 ** .5], 0), (3, [0.9, -(0.19 ** .5) * 1.01], 0), (4, [-1e300, 1e300], 0), (5, [-1e-300, 1e-300], 0)]
    got = rows_of(near_vectors(spark.createDataFrame(rows, schema)), "vec_id", "n_links", "component_id", "kept")
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (None, 3, 1, False), (2, 3, 1, False), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False)], key=repr)
    only_bad = spark.createDataFrame([(7, None, 0), (8, [0.0], 0)], schema)
    assert rows_of(near_vectors(only_bad), "vec_id", "n_links", "component_id", "kept") == [(7, 0, 7, True), (8, 0, 8, True)]

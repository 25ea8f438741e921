"""Exact metric range join of embeddings: all pairs of a cosine of at least the threshold.

Equal vectors form one class.  On unit vectors the cosine bound is a distance bound r.  Pivots, chosen
far apart, cut the space into cells (nearest pivot), and cells into blocks of bounded size.  Each
vector is shipped once, into the packed file of its block in the shared folder.  Cells join
independently: a task takes a block of one cell and some of the blocks that can hold partners.  By the
triangle inequality these lie in cells that reach within r of its own, and of such a block only those
vectors are compared whose distance to the pivot is at most the radius of the cell plus r, and
whose distance to the hyperplane between both pivots is at most r: the replicas at the boundary
are read, not written.  Each link is counted once for each end, in the cell of that end; of
the links themselves a task returns a spanning forest only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tonegrain.llm.common import cut_lineage, mix64, open_folder, shared_folder, temp_name, write_file, written
from tonegrain.llm.components import connected_components

#: Vectors that a cell should hold, pivots at most, and the sample that they are chosen from for each of them.
CELL_VECTORS, MOST_PIVOTS, SAMPLED = 8_192, 256, 4
#: Vectors of a block, blocks that one task compares with its own, and classes that a task remembers to have sent.
BLOCK_VECTORS, TASK_BLOCKS, SEEN_CLASSES = 8_192, 16, 1 << 20
#: Rows of (block, share of the others) at most, and partitions that they are dealt to; with more blocks a share is larger.
MOST_TASKS, MOST_PARTITIONS = 1_000_000, 20_000
_CHUNK_CELLS = 1 << 22
_SLACK = 1e-9


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def vector_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, class, dim, vector): class and vector are null where the vector cannot link.

    The class is a 64-bit hash of the numbers, the vector their 64-bit (or for 32-bit input
    32-bit) little-endian bytes.
    """
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            flat, marks = lists.flatten(), np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))))
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            numbers = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(kind) + 0  # -0.0 is 0.0
            bad = np.concatenate(([0], np.cumsum(~known | ~np.isfinite(numbers))))
            some = np.concatenate(([0], np.cumsum(numbers != 0)))
            usable = (np.diff(bad[marks]) == 0) & (np.diff(some[marks]) > 0)
            raw = [numbers[a:b].tobytes() if u else None for a, b, u in zip(marks[:-1].tolist(), marks[1:].tolist(), usable.tolist())]
            signs = [None if x is None else int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True) for x in raw]
            dims = pa.array(np.diff(marks).astype(np.int32), mask=~usable)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(pa.int64()), pa.array(signs, pa.int64()), dims, pa.array(raw, pa.binary())], ["vec_id", "class", "dim", "vector"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, class long, dim int, vector binary")


class Cells:
    """Pivots of the most frequent dimension; vectors of another one share a cell without pivot."""

    def __init__(self, dim: int, pivots: np.ndarray, radius: float):
        self.dim, self.pivots, self.radius = dim, pivots, radius
        self.apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
        self.reach: np.ndarray | None = None

    def nearest(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to all pivots, and the nearest one."""
        distances = np.sqrt(np.maximum(2 - 2 * units @ self.pivots.T, 0))
        return distances, distances.argmin(axis=1)

    def may_meet(self, cell: int, other: int) -> bool:
        """Whether a vector of one cell can be near one of the other cell."""
        return self.apart[cell, other] <= self.reach[cell] + self.reach[other] + self.radius + _SLACK

    def copies(self, units: np.ndarray, own: int, cell: int) -> np.ndarray:
        """Which vectors of the cell ``own`` may have a partner in another ``cell``."""
        distance = np.sqrt(np.maximum(2 - 2 * units @ self.pivots[cell], 0))
        near = np.sqrt(np.maximum(2 - 2 * units @ self.pivots[own], 0))
        plane = (distance ** 2 - near ** 2) <= 2 * self.apart[own, cell] * self.radius + _SLACK
        return plane & (distance <= self.reach[cell] + self.radius + _SLACK)


def _by_dim(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, row numbers, vectors) of a batch."""
    dims = batch.column("dim").to_numpy()
    raw = batch.column("vector").to_pylist()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, np.frombuffer(b"".join([raw[i] for i in at]), dtype=kind).reshape(len(at), dim).astype(float)


def _label(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after every a and b have been joined: the smallest number of each component."""
    while True:
        least = np.minimum(labels[a], labels[b])
        new = labels.copy()
        for ends in (a, b, labels[a], labels[b]):
            np.minimum.at(new, ends, least)
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if (new == labels).all():
            return labels
        labels = new


def _links(own: np.ndarray, other: np.ndarray, units: np.ndarray, other_units: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with a cosine of at least the threshold; close calls by the plain formula."""
    cosines = units @ other_units.T
    i, j = np.nonzero(cosines >= threshold - 1e-12)
    keep = np.ones(len(i), dtype=bool)
    for k in np.flatnonzero(cosines[i, j] < threshold + 1e-12):
        a, b = own[i[k]], other[j[k]]
        keep[k] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold
    return i[keep], j[keep]


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, ...).

    Vectors that are null, empty or zero, or hold null or non-finite numbers, link with
    nothing, and vectors of different length not with each other.  n_links counts the other
    rows linked directly, equal ones included.  The component is the smallest vec_id that links
    reach, kept says that it is the row's own; a row of null vec_id never names one.  Repeated
    rows link with each other; an empty table gives an empty result.
    """
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    rows = vector_rows(vectors)
    named = cut_lineage(rows.select("vec_id", "class", "dim"))
    firsts = named.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    sizes = named.where("class is not null").groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if sizes:
        usable = rows.where("class is not null").select("class", "dim", "vector")
        counted = _joined(usable, sizes[0]["dim"], sizes[0]["count"], threshold, kind)
    else:
        counted = firsts.select(F.col("class").alias("a"), F.lit(0).cast("long").alias("n"), F.col("class").alias("b"))
    counted = cut_lineage(counted)
    links = counted.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    parts = connected_components(counted.where("b is not null").select("a", "b"))
    parts = cut_lineage(parts.select(F.col("node").alias("class"), "component").join(firsts, "class").select("class", "component", "first"))
    least = parts.groupBy("component").agg(F.min("first").alias("least"))
    of_class = firsts.join(links, "class", "left").join(parts.join(least, "component").select("class", "least"), "class", "left")
    of_class = cut_lineage(of_class.select(
        "class", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "first").alias("component")))
    found = named.select("vec_id", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.coalesce("component", "vec_id"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def far_apart(units: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the vectors, each as far as can be from those chosen before."""
    chosen, most = [0], units @ units[0]
    while len(chosen) < min(n, len(units)):
        chosen.append(int(most.argmin()))
        most = np.maximum(most, units @ units[chosen[-1]])
    return units[chosen]


def _joined(rows: DataFrame, dim: int, count: int, threshold: float, kind: str) -> DataFrame:
    """(a, n, null): other rows linked with class a, of some blocks; (a, null, b): links that connect classes."""
    spark = rows.sparkSession
    context = spark.sparkContext
    n_pivots = min(MOST_PIVOTS, max(1, -(-count // CELL_VECTORS)))
    sample = rows.where(F.col("dim") == dim).dropDuplicates(["class"]).orderBy("class").limit(SAMPLED * n_pivots).collect()  # 4 * MOST_PIVOTS rows at most
    units = _units(np.stack([np.frombuffer(bytes(r["vector"]), dtype=kind) for r in sample]).astype(float))
    cells = Cells(dim, far_apart(units, n_pivots), float(np.sqrt(max(0.0, 2 - 2 * threshold))))
    first_cells = context.broadcast(cells)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = first_cells.value
        n, reach = np.zeros(len(cells.pivots), dtype=np.int64), np.zeros(len(cells.pivots))
        others: dict[int, int] = {}
        for batch in batches:
            for d, at, values in _by_dim(batch, kind):
                if d != cells.dim:
                    others[d] = others.get(d, 0) + len(at)
                    continue
                distances, own = cells.nearest(_units(values))
                n += np.bincount(own, minlength=len(n))
                np.maximum.at(reach, own, distances[np.arange(len(own)), own])
        yield pa.RecordBatch.from_arrays(
            [pa.array([cells.dim] * len(n) + list(others), pa.int32()), pa.array([*range(len(n)), *[0] * len(others)], pa.int32()),
             pa.array([*n.tolist(), *others.values()], pa.int64()), pa.array([*reach.tolist(), *[0.0] * len(others)])],
            ["dim", "cell", "n", "reach"])

    measured = rows.select("dim", "vector").mapInArrow(measure, "dim int, cell int, n long, reach double")
    totals = measured.groupBy("dim", "cell").agg(F.sum("n").alias("n"), F.max("reach").alias("reach")).collect()  # a row for each cell
    cells.reach = np.zeros(len(cells.pivots))
    blocks = {}
    for r in totals:
        blocks[r["dim"], r["cell"]] = max(1, -(-r["n"] // BLOCK_VECTORS))
        if r["dim"] == dim:
            cells.reach[r["cell"]] = r["reach"]
    shared, folder = context.broadcast((cells, blocks)), shared_folder(spark, "vector-blocks")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, blocks = shared.value
        seen: set[int] = set()
        for batch in batches:
            # Copies that this task has sent already go as a weight alone, so a hot class is one vector a task.
            names, first, n = np.unique(batch.column("class").to_numpy(), return_index=True, return_counts=True)
            batch = batch.take(pa.array(first))
            cell = np.zeros(len(names), dtype=np.int32)
            for d, at, values in _by_dim(batch, kind):
                if d == cells.dim:
                    cell[at] = cells.nearest(_units(values))[1]
            many = np.array([blocks[key] for key in zip(batch.column("dim").to_pylist(), cell.tolist())], dtype=np.uint64)
            block = (mix64(names.view(np.uint64)) % many).astype(np.int32)
            known = np.array([x in seen for x in names.tolist()], dtype=bool)
            if len(seen) < SEEN_CLASSES:
                seen.update(names.tolist())
            vector = pc.if_else(pa.array(known), pa.scalar(None, pa.binary()), batch.column("vector"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("dim"), pa.array(n.astype(np.int64)), vector, pa.array(cell), pa.array(block)],
                ["class", "dim", "weight", "vector", "cell", "block"])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("class", "ascending")])
        ids = table.column("class").to_numpy()
        names, start = np.unique(ids, return_index=True)
        weight = np.add.reduceat(table.column("weight").to_numpy(), start)
        whole = table.filter(table.column("vector").is_valid())
        held = np.unique(whole.column("class").to_numpy(), return_index=True)[1]
        vectors = whole.column("vector").take(pa.array(held)).to_pylist()
        name = temp_name("block", ".bin")
        write_file(folder, name, iter([names.astype("<i8").tobytes(), weight.astype("<i8").tobytes(), *vectors]))
        one = lambda column: pa.array([table.column(column)[0].as_py()], pa.int32())
        return pa.table({"dim": one("dim"), "cell": one("cell"), "block": one("block"), "file": pa.array([name]), "n": pa.array([len(names)], pa.int64())})

    dealt = rows.mapInArrow(deal, "class long, dim int, weight long, vector binary, cell int, block int")
    index = written(dealt.groupBy("dim", "cell", "block").applyInArrow(pack, "dim int, cell int, block int, file string, n long"), "vector-index")
    # A row for each block: bounded by the number of vectors over that of a block.
    listed = sorted(tuple(r) for r in index.collect())
    files = context.broadcast(listed)
    slices = max(1, min(-(-len(listed) // TASK_BLOCKS), MOST_TASKS // max(1, len(listed))))

    def read(entry: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d, _, _, name, n = entry
        system, path = open_folder(folder)
        with system.open_input_stream(f"{path}/{name}", compression=None) as source:
            raw = source.read()
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<i8", n, 8 * n), np.frombuffer(raw, kind, n * d, 16 * n).reshape(n, d).astype(float)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, held = shared.value[0], None
        for batch in batches:
            for name, part in zip(batch.column("file").to_pylist(), batch.column("slice").to_pylist()):
                if held is None or held[0][3] != name:
                    entry = next(e for e in files.value if e[3] == name)
                    ids, weight, values = read(entry)
                    held = entry, ids, values, _units(values)
                entry, ids, values, units = held
                yield _linked(cells, entry, ids, values, units, [e for e in files.value[part::slices] if e[0] == entry[0]], read, threshold)

    tasks = index.select("file", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    return tasks.repartition(max(1, min(len(listed) * slices, MOST_PARTITIONS)), "file", "slice").mapInArrow(join, "a long, n long, b long")


def _linked(cells: Cells, entry: tuple, ids: np.ndarray, values: np.ndarray, units: np.ndarray, others: list[tuple], read, threshold: float) -> pa.RecordBatch:
    """Links of one block with some others: rows (a, n, null), and a spanning forest (a, null, b)."""
    dim, cell = entry[:2]
    n = np.zeros(len(ids), dtype=np.int64)
    names, labels = ids, np.arange(len(ids))
    for other in others:
        if dim == cells.dim and not cells.may_meet(cell, other[1]):
            continue
        other_ids, weight, other_values = read(other)
        other_units = _units(other_values)
        if dim == cells.dim and other[1] != cell:
            some = cells.copies(other_units, other[1], cell)
            other_ids, weight, other_values, other_units = other_ids[some], weight[some], other_values[some], other_units[some]
        # Both blocks get numbers of their own; a class of both has one number, so that its links meet.
        known = np.union1d(names, other_ids)
        new = np.arange(len(known))
        new[np.searchsorted(known, names)] = np.searchsorted(known, names)[labels]
        names, labels = known, new
        own, far = np.searchsorted(known, ids), np.searchsorted(known, other_ids)
        step = max(1, _CHUNK_CELLS // max(1, len(other_ids)))
        for k in range(0, len(ids) if len(other_ids) else 0, step):
            i, j = _links(values[k:k + step], other_values, units[k:k + step], other_units, threshold)
            differ = ids[k + i] != other_ids[j]
            i, j = i[differ] + k, j[differ]
            n += np.bincount(i, weights=weight[j], minlength=len(ids)).astype(np.int64)
            labels = _label(labels, own[i], far[j])
    away = np.flatnonzero(labels != np.arange(len(names)))
    none = pa.nulls(len(ids), pa.int64()), pa.nulls(len(away), pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([pa.array(ids), pa.array(names[away])]), pa.concat_arrays([pa.array(n), none[1]]),
        pa.concat_arrays([none[0], pa.array(names[labels[away]])])], names=["a", "n", "b"])

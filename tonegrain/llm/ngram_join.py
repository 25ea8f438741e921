"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Two texts link when the Jaccard similarity of their sets of word n-grams reaches the
threshold.  Texts of equal sets form one class, so copies never meet one another.

1. ``signatures``: one pass hashes every text; it also sums up the few n-grams that occur
   in a large share of the corpus (at most ``HOT_SHARE`` of them can exist: the only thing
   broadcast).
2. ``repeated_grams``: n-grams travel in packed blocks by hash range, where their document
   frequency is counted; hot ones travel by class instead, since their frequency is known.
   An n-gram of one class only can never be shared: a class in which these fill the whole
   prefix (rare-first order puts them in front) is out; usually most are.
3. Prefix rows of the rest join on their n-gram, under the length filter, the positional
   filter and a suffix filter (histograms of the n-grams behind the prefix).  First every
   class meets only the pivot of each n-gram; after these links are verified and turned into
   components, only n-grams that still hold several components are joined in full.  So a
   large group of near copies never becomes all its pairs, and no link between different
   components is lost.
4. Candidates are made distinct and verified on the whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tonegrain.llm.common import (
    SHINGLE_WORDS, cut_lineage, distinct_sorted, hashed_words, mix64, pieces, released, texts_of, windows, written,
)
from tonegrain.llm.components import connected_components

#: An n-gram is hot when it makes up more than one in so many of all n-grams.
HOT_SHARE = 1 << 16
HOT_LEAST = 5_000
#: N-grams that a task gathers before it packs them into blocks, and that a block range should hold.
FLUSH_GRAMS, RANGE_GRAMS = 2 << 20, 3 << 20
#: Bins of the suffix histograms.
BINS = 64


def _sets(batch: pa.RecordBatch, width: int, most: int = 2 << 20):
    """(row ids, n-gram hashes, marks, class ids) of a batch, a piece at a time."""
    for piece in pieces(batch, "text", most):
        words, marks = hashed_words(texts_of(piece.column("text")), lower=True)
        grams, marks = distinct_sorted(*windows(words, marks, width))
        raw = grams.tobytes()
        signs = [
            hashlib.blake2b(raw[8 * a:8 * b], digest_size=8).digest() if b > a else None
            for a, b in zip(marks[:-1].tolist(), marks[1:].tolist())
        ]
        yield piece.column("doc_id"), grams, marks, signs


def _class_id(sign: bytes) -> int:
    return int.from_bytes(sign, "little", signed=True)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """kind 'doc': (doc_id, class, n); kind 'hot': n-gram and its count so far, for frequent ones.

    The class is a 64-bit hash of the sorted set.  Copies that one task has seen already do
    not count again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        gathered: list[np.ndarray] = []

        def hot() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(gathered), return_counts=True)
            often = counts >= max(8, counts.sum() // HOT_SHARE)
            k = int(often.sum())
            return pa.RecordBatch.from_arrays([
                pa.array(["hot"] * k, pa.string()), pa.array(values[often].view(np.int64)),
                pa.nulls(k, pa.int64()), pa.array(counts[often].astype(np.int64)),
            ], ["kind", "id", "class", "n"])

        for batch in batches:
            for ids, grams, marks, signs in _sets(batch, width):
                yield pa.RecordBatch.from_arrays([
                    pa.array(["doc"] * len(ids)), ids.cast(pa.int64()),
                    pa.array([None if s is None else _class_id(s) for s in signs], pa.int64()),
                    pa.array(np.diff(marks).astype(np.int64)),
                ], ["kind", "id", "class", "n"])
                for i, s in enumerate(signs):
                    if s is not None and s not in seen:
                        seen.add(s)
                        gathered.append(grams[marks[i]:marks[i + 1]])
                if sum(map(len, gathered)) >= FLUSH_GRAMS:
                    yield hot()
                    gathered.clear()
        if gathered:
            yield hot()

    return docs.select("doc_id", "text").mapInArrow(lambda batches: released(run(batches)), "kind string, id long, class long, n long")


_BLOCK = "part int, classes binary, sizes binary, counts binary, grams binary, hot boolean"


def _blocks(part: np.ndarray, cls: np.ndarray, n: np.ndarray, grams: np.ndarray, hot: bool) -> pa.RecordBatch:
    """One row per part: its n-grams in class order, with runs of (class, set size, count)."""
    order = np.argsort(part, kind="stable")
    part, cls, n, grams = part[order], cls[order], n[order], grams[order]
    new_part = np.concatenate(([True], part[1:] != part[:-1]))
    new_run = new_part | np.concatenate(([True], cls[1:] != cls[:-1]))
    new_run[::0xFFFF] = True  # so that a count fits into two bytes
    runs = np.flatnonzero(new_run)
    lens = np.diff(np.append(runs, len(part)))
    rows: list[list] = [[], [], [], [], []]
    starts = np.flatnonzero(new_part)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        r = slice(*np.searchsorted(runs, [a, b]).tolist())
        for column, value in zip(rows, (
            int(part[a]), cls[runs[r]].tobytes(), n[runs[r]].astype(np.int32).tobytes(),
            lens[r].astype(np.uint16).tobytes(), grams[a:b].tobytes(),
        )):
            column.append(value)
    k = len(rows[0])
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), *[pa.array(c, pa.binary()) for c in rows[1:]], pa.array([hot] * k, pa.bool_())],
        ["part", "classes", "sizes", "counts", "grams", "hot"],
    )


def _unpack(table: pa.Table, keep: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def joined(name: str, kind) -> np.ndarray:
        values = [v for v, k in zip(table.column(name).to_pylist(), keep) if k]
        return np.frombuffer(b"".join(values), dtype=kind)

    counts = joined("counts", np.uint16)
    return np.repeat(joined("classes", np.int64), counts), np.repeat(joined("sizes", np.int32), counts), joined("grams", np.uint64)


def repeated_grams(docs: DataFrame, width: int, n_parts: int, hot: dict[int, int]) -> DataFrame:
    """Blocks by class range: (part, classes, sizes, n-grams, frequencies) of n-grams of two classes or more."""
    hot_grams = np.array(sorted(h & (2**64 - 1) for h in hot), dtype=np.uint64)
    hot_counts = np.array([hot[int(np.int64(np.uint64(h).astype(np.int64)))] for h in hot_grams], dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((hot_grams, hot_counts))  # HOT_SHARE entries at most

    def is_hot(grams: np.ndarray) -> np.ndarray:
        known = shared.value[0]
        if not len(known):
            return np.zeros(len(grams), dtype=bool)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        return known[at] == grams

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        gathered: list[tuple] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(g) for _, g in gathered])
            cls = np.repeat(np.array([c for c, _ in gathered], dtype=np.int64), sizes)
            n = np.repeat(sizes, sizes)
            grams = np.concatenate([g for _, g in gathered])
            frequent = is_hot(grams)
            for flag, chosen, key in ((False, ~frequent, grams), (True, frequent, cls.view(np.uint64))):
                if chosen.any():
                    part = (mix64(key[chosen]) % np.uint64(n_parts)).astype(np.int32)
                    yield _blocks(part, cls[chosen], n[chosen], grams[chosen], flag)

        for batch in batches:
            for _, grams, marks, signs in _sets(batch, width):
                for i, s in enumerate(signs):
                    if s is not None and s not in seen:
                        seen.add(s)
                        gathered.append((_class_id(s), grams[marks[i]:marks[i + 1]].copy()))
                        total += int(marks[i + 1] - marks[i])
                if total >= FLUSH_GRAMS:
                    yield from flush()
                    gathered.clear()
                    total = 0
        if gathered:
            yield from flush()

    def count(table: pa.Table) -> pa.Table:
        flags = table.column("hot").to_pylist()
        cls, n, grams = _unpack(table, [not f for f in flags])
        order = np.lexsort((cls, grams))
        cls, n, grams = cls[order], n[order], grams[order]
        new_gram = np.ones(len(grams), dtype=bool)
        new_gram[1:] = grams[1:] != grams[:-1]
        once = new_gram.copy()  # a class that several tasks have seen counts once
        once[1:] |= cls[1:] != cls[:-1]
        cls, n, grams, new_gram = cls[once], n[once], grams[once], new_gram[once]
        frequency = np.diff(np.append(np.flatnonzero(new_gram), len(grams)))
        frequency = np.repeat(frequency, frequency)
        often = frequency > 1
        cls, n, grams, frequency = cls[often], n[often], grams[often], frequency[often]
        if any(flags):
            cls2, n2, grams2 = _unpack(table, flags)
            known, counts = shared.value
            cls, n, grams = np.concatenate((cls, cls2)), np.concatenate((n, n2)), np.concatenate((grams, grams2))
            frequency = np.concatenate((frequency, counts[np.searchsorted(known, grams2)]))
        part = (mix64(cls.view(np.uint64)) % np.uint64(n_parts)).astype(np.int32)
        order = np.lexsort((cls, part))
        part, cls, n, grams, frequency = part[order], cls[order], n[order], grams[order], frequency[order]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.empty(0, int)
        cuts = [*starts.tolist(), len(part)]
        return pa.table({
            "part": pa.array(part[starts], pa.int32()),
            **{name: pa.array([v[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for name, v in (
                ("classes", cls), ("sizes", n.astype(np.int32)), ("grams", grams),
                ("frequencies", np.minimum(frequency, 2**31 - 1).astype(np.int32)))},
        })

    blocks = docs.select("doc_id", "text").mapInArrow(lambda batches: released(scatter(batches)), _BLOCK)
    # Part i is partition i: parts do not meet in one task, however many there are.
    return blocks.repartitionById(n_parts, "part").groupBy("part").applyInArrow(
        count, "part int, classes binary, sizes binary, grams binary, frequencies binary"
    )


def survivors(repeated: DataFrame, threshold: Fraction, n_parts: int) -> DataFrame:
    """(class, n, u, hist, grams): classes whose prefix holds a repeated n-gram.

    n: size of the set; u: how many of it no other class has; grams: the others, rarest first;
    hist: how many of these fall into each of ``BINS`` bins.
    """
    num, den = threshold.numerator, threshold.denominator

    def gather(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)

        cls, n, grams = joined("classes", np.int64), joined("sizes", np.int32), joined("grams", np.uint64)
        order = np.lexsort((grams, joined("frequencies", np.int32), cls))
        cls, n, grams = cls[order], n[order], grams[order]
        once = np.ones(len(cls), dtype=bool)
        same = (cls[1:] == cls[:-1]) & (grams[1:] == grams[:-1])
        once[1:] = ~same  # equal n-grams of a class have one frequency, so they are neighbours
        cls, n, grams = cls[once], n[once].astype(np.int64), grams[once]
        starts = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1]))) if len(cls) else np.empty(0, int)
        lens = np.diff(np.append(starts, len(cls)))
        size = n[starts]
        prefix = size - -(-size * num // den) + 1
        keep = size - lens < prefix
        values, marks = grams.view(np.int64), np.append(starts, len(cls))
        lists = [values[marks[i]:marks[i + 1]] for i in np.flatnonzero(keep)]
        bins = [np.bincount(mix64(v.view(np.uint64)) % np.uint64(BINS), minlength=BINS).astype(np.int32) for v in lists]
        return pa.table({
            "class": pa.array(cls[starts][keep]), "n": pa.array(size[keep].astype(np.int32)),
            "u": pa.array((size - lens)[keep].astype(np.int32)),
            "hist": pa.array(bins, pa.list_(pa.int32())),
            "grams": pa.array(lists, pa.list_(pa.int64())),
        })

    return repeated.repartitionById(n_parts, "part").groupBy("part").applyInArrow(gather, "class long, n int, u int, hist array<int>, grams array<long>")


def _prefix_rows(sets: DataFrame, threshold: Fraction) -> DataFrame:
    """(gram, class, n, own, pos): the repeated n-grams of each prefix, with their place in the whole order."""
    num, den = threshold.numerator, threshold.denominator
    prefix = F.expr(f"n - cast(ceil(n * {num}L / {den}.0D - 1e-9) as int) + 1 - u")
    rows = sets.select("class", "n", "u", F.posexplode(F.slice("grams", F.lit(1), prefix)).alias("at", "gram"))
    return rows.select("gram", "class", "n", F.col("u").alias("own"), (F.col("u") + F.col("at")).alias("pos"))


def _overlap(na, nb, threshold: Fraction):
    """Smallest overlap that two sets of these sizes need."""
    num, den = threshold.numerator, threshold.denominator + threshold.numerator
    return F.ceil((na + nb) * F.lit(num) / F.lit(float(den)) - 1e-9)


def _sizes_fit(a: str, b: str, threshold: Fraction):
    """Length filter."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    return F.least(na, nb) * threshold.denominator >= F.greatest(na, nb) * threshold.numerator


def _may_link(a: str, b: str, threshold: Fraction):
    """Length filter, and positional filter for the first shared n-gram at these positions."""
    na, nb, pa_, pb = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}pos"), F.col(f"{b}pos")
    return _sizes_fit(a, b, threshold) & (F.least(na - pa_, nb - pb) >= _overlap(na, nb, threshold))


def _candidates(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """Distinct pairs of joined prefix rows that pass the filters, the last shared position included."""
    found = rows.groupBy("a", "b").agg(
        F.max(F.struct("a_pos", "b_pos")).alias("last"), F.countDistinct("gram").alias("shared"),
        F.max("a_n").alias("a_n"), F.max("b_n").alias("b_n"),
    )
    rest = F.least(F.col("a_n") - F.col("last.a_pos"), F.col("b_n") - F.col("last.b_pos")) - 1
    return found.where(F.col("shared") + rest >= _overlap(F.col("a_n"), F.col("b_n"), threshold)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs whose whole sets are similar enough.

    The suffix filter goes first: two sets share at most the smaller count of each bin.  Only
    what passes it meets the sets themselves.
    """
    num, den = threshold.numerator, threshold.denominator

    def side(x: str, column: str) -> DataFrame:
        return sets.select(F.col("class").alias(x), F.col("n").alias(f"{x}_n"), F.col(column).alias(f"{x}_{column}"))

    most = F.aggregate(F.zip_with("a_hist", "b_hist", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    near = pairs.join(side("a", "hist"), "a").join(side("b", "hist"), "b")
    near = near.where(most >= _overlap(F.col("a_n"), F.col("b_n"), threshold)).select("a", "b")
    both = F.size(F.array_intersect("a_grams", "b_grams"))
    joined = near.join(side("a", "grams"), "a").join(side("b", "grams"), "b").withColumn("both", both)
    return joined.where(F.col("both") * den >= (F.col("a_n") + F.col("b_n") - F.col("both")) * num).select("a", "b")


def similar_classes(sets: DataFrame, threshold: Fraction, rounds: int = 2) -> DataFrame:
    """Links (a, b) that connect all classes which chains of similar sets connect."""
    sets = cut_lineage(sets)
    prefix = _prefix_rows(sets, threshold)
    links = None
    labels = sets.select("class", F.col("class").alias("label"))
    for turn in range(rounds):
        rows = prefix.join(labels, "class")
        # First the set with the fewest n-grams of its own: in a group of copies, the least edited one.
        rank = F.col("own").cast("long") if turn == 0 else F.xxhash64(F.lit(turn), "class")
        pivots = rows.groupBy("gram").agg(
            F.min(F.struct(rank.alias("rank"), "class", "n", "label")).alias("p"),
            F.min("label").alias("l0"), F.max("label").alias("l1"),
        ).where("l0 <> l1").select(
            "gram", F.col("p.class").alias("b"), F.col("p.n").alias("b_n"), F.col("p.label").alias("b_label")
        )
        near = rows.select("gram", F.col("class").alias("a"), F.col("n").alias("a_n"), "label").join(pivots, "gram")
        # The shared n-gram need not be the first that both have, so only the length filter holds here.
        near = near.where(F.col("label") != F.col("b_label")).where(_sizes_fit("a_", "b_", threshold))
        found = _verified(near.select("a", "b").distinct(), sets, threshold)
        links = cut_lineage(found if links is None else links.union(found))
        labels = _labels(sets, links)
    rows = prefix.join(labels, "class")
    mixed = rows.groupBy("gram").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("gram")
    rows = cut_lineage(rows.join(mixed, "gram", "left_semi"))
    a = rows.select("gram", *[F.col(c).alias(f"a_{c}") for c in ("class", "n", "pos", "label")])
    b = rows.select("gram", *[F.col(c).alias(f"b_{c}") for c in ("class", "n", "pos", "label")])
    # The shorter side needs the shorter prefix only: the overlap is at least 2t / (1 + t) of its size.
    num, den = threshold.numerator, threshold.denominator + threshold.numerator
    a = a.where(F.col("a_n") - F.col("a_pos") >= F.ceil(F.col("a_n") * F.lit(2 * num) / F.lit(float(den)) - 1e-9))
    shorter = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_class") < F.col("b_class")))
    rest = a.join(b, "gram").where(
        (F.col("a_label") != F.col("b_label")) & shorter & _may_link("a_", "b_", threshold)
    ).select("gram", F.col("a_class").alias("a"), F.col("b_class").alias("b"), "a_n", "b_n", "a_pos", "b_pos")
    return links.union(_verified(_candidates(rest, threshold), sets, threshold))


def _labels(sets: DataFrame, links: DataFrame) -> DataFrame:
    parts = connected_components(links).select(F.col("node").alias("class"), "component")
    return cut_lineage(sets.select("class").join(parts, "class", "left").select("class", F.coalesce("component", "class").alias("label")))


def _grouped(docs: DataFrame, threshold: Fraction | float | str, width: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class, n) of each row, and (class, component, chosen): the smallest doc_id that links reach (null if
    all are), and the smallest class of its rows."""
    threshold = Fraction(threshold).limit_denominator(10_000)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut_lineage(signatures(docs, width))
    rows = signed.where("kind = 'doc'").select(F.col("id").alias("doc_id"), "class", "n")
    classes = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_SHARE)
    counted = signed.where("kind = 'hot'").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= limit)
    # At most HOT_SHARE n-grams (times the share of copies that several tasks count) can pass the limit.
    hot = {r["id"]: r["n"] for r in counted.collect()}
    n_parts = max(36, -(-total // RANGE_GRAMS))
    sets = survivors(repeated_grams(docs, width, n_parts, hot), threshold, n_parts)
    links = similar_classes(sets, threshold)
    parts = connected_components(links).select(F.col("node").alias("class"), "component").join(classes, "class")
    parts = cut_lineage(parts.select("class", "component", "first"))
    place = F.struct(F.col("first").isNull().alias("no_id"), "first", "class")
    least = parts.groupBy("component").agg(F.min(place).alias("least"))
    linked = parts.join(least, "component").select("class", "least")
    return rows, classes.select("class", "first").join(linked, "class", "left").select(
        "class", F.coalesce("least.first", "first").alias("component"), F.coalesce("least.class", "class").alias("chosen")
    )

def near_duplicate_groups(
    docs: DataFrame, threshold: Fraction | float | str = Fraction(4, 5), width: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text, ...).

    Words are runs of characters other than space and 0x09-0x0D, A-Z lower-cased.  A text
    with fewer words than ``width`` is one n-gram; null, empty and blank texts have none and
    link with nothing.  The component is the smallest doc_id that links reach, so a row of a
    null doc_id never names one; it has a null component if it has no partner.  Repeated rows
    are repeated in the result; an empty table gives an empty result; other columns are not
    looked at.  A class is a 64-bit hash: among a billion different texts, two clash with a
    chance of 3 %.
    """
    rows, of_class = _grouped(docs, threshold, width)
    return rows.join(of_class, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def _with_class(docs: DataFrame, width: int) -> DataFrame:
    """(record, class): every row of ``docs`` as a struct, and its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slim = pa.RecordBatch.from_arrays([batch.column(0), pa.array(range(batch.num_rows), pa.int64())], ["text", "doc_id"])
            for at, _, _, signs in _sets(slim, width):
                found = pa.array([None if s is None else _class_id(s) for s in signs], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at[0].as_py(), len(at)), found], names=["record", "class"])

    schema = T.StructType([T.StructField("record", docs.schema), T.StructField("class", T.LongType())])
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.col("text").cast("string").alias("text"), record.alias("record")).mapInArrow(lambda batches: released(run(batches)), schema)


def drop_near_duplicates(docs: DataFrame, threshold: Fraction | float | str = Fraction(4, 5), width: int = SHINGLE_WORDS) -> DataFrame:
    """One row of ``docs`` of each group of near copies, all columns kept.

    The row of the smallest doc_id stays, null ids last; of several rows of this id, one of the
    smallest class, and of these the one of the lowest hash.  Rows are judged by their own text,
    so a clean text stays beside a near copy of the same doc_id, and rows without words all stay,
    with or without an id.

    The ids whose rows all go are written first: where they measure below Spark's threshold they
    are broadcast, and the texts are not shuffled.  Only rows of ids of which some go and some
    stay are hashed again.  Texts of any length are read whole, columns of any name come through
    in their order, and an empty table stays empty.
    """
    rows, of_class = _grouped(docs, threshold, width)
    pairs = rows.groupBy("doc_id", "class").agg(F.count(F.lit(1)).alias("times")).join(of_class, "class", "left")
    chosen = F.col("doc_id").eqNullSafe(F.col("component")) & (F.col("class") == F.col("chosen"))
    goes = F.col("class").isNotNull() & ~chosen
    judged = pairs.groupBy("doc_id").agg(
        F.bool_and(goes).alias("all_go"), F.bool_or(goes | (F.col("class").isNotNull() & (F.col("times") > 1))).alias("some_go"))
    judged = written(judged.where("some_go").select("doc_id", (F.col("all_go") & F.col("doc_id").isNotNull()).alias("all_go")), "near-duplicates")
    mixed = judged.where("not all_go").select("doc_id")
    columns = [F.col(f"`{c}`") for c in docs.columns]  # a join by name would move doc_id to the front
    left = docs.join(judged.where("doc_id is not null").select("doc_id"), "doc_id", "left_anti").select(*columns)
    if mixed.isEmpty():
        return left
    again = docs.join(mixed, "doc_id", "left_semi").select(*columns)
    if not mixed.where("doc_id is null").isEmpty():
        left, again = left.where("doc_id is not null"), again.union(docs.where("doc_id is null"))
    again = _with_class(again, width)
    stay = written(of_class.where("class = chosen").select("class", F.col("component").alias("id")), "near-duplicate-rows")
    some = again.join(stay, "class").where(F.col("record.doc_id").cast("long").eqNullSafe(F.col("id")))
    one = some.groupBy("class").agg(F.min_by("record", F.xxhash64("record")).alias("record"))
    return left.union(one.select("record.*")).union(again.where(F.col("class").isNull()).select("record.*"))

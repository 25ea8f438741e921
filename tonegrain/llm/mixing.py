"""Mixing sources to target weights by balanced sampling with the cube method.

Each source gets a target number of words.  Whole repeats of the source cover the whole part
of target / size; the rest f is a sample in which every document has inclusion probability f.
The flight phase moves the probabilities of three units at a time along the null space of two
constraints (documents and words of the sample), until each is 0 or 1.  It runs in blocks of
bounded size; each leaves two open units at most, and these meet in further rounds of blocks.
The last block of a source stops at a dozen open units; the landing phase rounds these with
the least error in words.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.llm.common import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
BLOCK_UNITS = 20_000
#: Open units that the landing phase rounds by looking at all choices.
LANDING_UNITS = 12
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_no, source_size, target) from (source, size).

    Sources in code point order, null last, take the weights in turn.  All targets add up to
    ``share`` of all sizes; none exceeds ``cap`` times its source's size, and the excess goes to
    the others by weight.  Sources sorted by cap / weight, the capped ones come first: so one
    running sum finds them all.  The windows run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    no = F.row_number().over(by_name) - 1
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    named = sums.withColumn("source_no", no).withColumn("w", given).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("w"), "source_no")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - before
    flagged = named.withColumn("capped", F.col("most") / F.col("w") <= left / weight_left)
    open_words = F.sum("source_size").over(everything) * F.lit(float(share)) - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("w") * open_words / open_weight)
    return flagged.select("source", "source_no", "source_size", target.alias("target"))


def flight(p: np.ndarray, documents: np.ndarray, words: np.ndarray, rng: np.random.Generator, leave: int = 2) -> np.ndarray:
    """Move p to 0 or 1, but for ``leave`` units at most, keeping the documents and words that p adds up to."""
    p = p.copy()
    moving = np.flatnonzero((p > _EPS) & (p < 1 - _EPS)).tolist()
    waiting, n_open = iter(moving), len(moving)
    active = list(itertools.islice(waiting, 3))
    while len(active) == 3 and n_open > leave:
        (c1, c2, c3), (t1, t2, t3) = documents[active].tolist(), words[active].tolist()
        u = [c2 * t3 - c3 * t2, c3 * t1 - c1 * t3, c1 * t2 - c2 * t1]
        if not any(u):
            u = [c2, -c1, 0.0]
        up = down = float("inf")
        for k, v in zip(active, u):
            if v > 0:
                up, down = min(up, (1 - p[k]) / v), min(down, p[k] / v)
            elif v < 0:
                up, down = min(up, p[k] / -v), min(down, (1 - p[k]) / -v)
        step = up if rng.random() * (up + down) < down else -down
        for k, v in zip(active, u):
            p[k] += step * v
        still = [k for k in active if _EPS < p[k] < 1 - _EPS]
        n_open -= 3 - len(still)
        active = still + list(itertools.islice(waiting, 3 - len(still)))
    done = (p <= _EPS) | (p >= 1 - _EPS)
    p[done] = np.round(p[done])
    return p


def landing(p: np.ndarray, documents: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Round the few open units with the least error in words, then in documents."""
    open_units = np.flatnonzero((p > 0) & (p < 1))
    choices = (np.arange(1 << len(open_units))[:, None] >> np.arange(len(open_units))) & 1
    moved = choices - p[open_units]
    best = np.lexsort((np.abs(moved @ documents[open_units]), np.round(np.abs(moved @ words[open_units]), 6)))[0]
    p = p.copy()
    p[open_units] = choices[best]
    return p


def _fly(seed: int, level: int, last: bool):
    def run(units: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values(["draw", "doc_id", "size"], kind="stable", na_position="last")
        first = units.iloc[0]
        name = f"{seed}:{level}:{first['source_no']}:{first['block']}".encode()
        rng = np.random.default_rng(int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little"))
        documents = units["rows"].to_numpy(dtype=float)
        words = documents * units["size"].to_numpy(dtype=float)
        p = flight(units["p"].to_numpy(dtype=float), documents, words, rng, LANDING_UNITS if last else 2)
        return units.assign(p=landing(p, documents, words) if last else p)

    return run


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
    seed: int = 0, block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, times) for each unit of ``docs``.

    ``times``: how often the mix takes it.  Rows equal in doc_id, source and size are one unit
    of ``rows`` rows, taken or left together.  Null doc_id and null source are values like
    others; a null or empty text has size 0; an empty table gives an empty mix.  The result
    depends on the rows and the seed alone.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    units = cut_lineage(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")))
    goals = cut_lineage(targets(units.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, share, cap))
    goals = goals.withColumnRenamed("source", "of_source")
    joined = units.join(goals, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A rest within rounding of a whole number is none.
    whole = F.floor(times + 1e-12)
    placed = joined.withColumn("base", whole).withColumn("p", F.greatest(times - whole, F.lit(0.0)))
    placed = placed.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "source", "size"))
    most = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    schema = "doc_id long, source string, size long, rows long, source_no int, source_size long, target double, base long, p double, draw long, block long"
    columns = [c.split()[0] for c in schema.split(", ")]
    done, level = None, 0
    state = placed
    while True:
        last = most <= block_units
        n_blocks = 1 if last else -(-most // (block_units // 2))
        state = state.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "draw"), F.lit(n_blocks))).select(*columns)
        flown = cut_lineage(state.groupBy("source_no", "block").applyInPandas(_fly(seed, level, last), schema))
        closed = flown if last else flown.where("p = 0 or p = 1")
        done = closed if done is None else done.union(closed)
        if last:
            break
        state, most, level = flown.where("p > 0 and p < 1").drop("block"), 2 * n_blocks, level + 1
    return done.select("doc_id", "source", "size", "rows", "source_size", "target", (F.col("base") + F.col("p").cast("long")).alias("times"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept, whatever their names.

    Texts that are null or empty have size 0 and are taken by their source's share like others;
    a null source is a source, a null doc_id an id.  Texts of any length count by their words.
    Rows equal in doc_id, source and size are taken alike.  An empty table gives no rows.
    """
    taken = mix(docs, **options).where("times > 0").select(
        F.col("doc_id").alias("of_id"), F.col("source").alias("of_source"), F.col("size").alias("of_size"), "times")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.col("doc_id").cast("long").alias("id"),
        F.col("source").alias("from"), word_count(F.col("text")).alias("words"))
    joined = keyed.join(taken, F.col("id").eqNullSafe(F.col("of_id")) & F.col("from").eqNullSafe(F.col("of_source")) & (F.col("words") == F.col("of_size")))
    return joined.select("record", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("record.*")

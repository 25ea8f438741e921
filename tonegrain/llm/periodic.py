"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a longest stretch of words with smallest period q that is at least ``TURNS`` * q words
and at least ``LEAST`` words long.  Every word of a run occurs in it ``TURNS`` times or more, so a
word that occurs more rarely in the current segment cannot belong to a run there and splits it.
This is repeated until no segment changes; all segments of a batch split together.

Surviving segments are scanned by lag.  Words q apart are equal all along a run, so three
points q apart inside it agree with the words a lag later: a lag looks at every q-th word only, and
at whole stretches only around such hits.  Hits inside a run of a smaller period are passed over:
by the theorem of Fine and Wilf, what they lead to has that smaller period too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.llm.common import hashed_words, mix64, pieces, texts_of

#: Turns of the period, and words, that a run has at least.
TURNS, LEAST = 4, 6
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_STRETCH = 64


# ------------------------------------------------------------------ splitting
def segments(words: np.ndarray, marks: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of words, none across texts, that no word splits any more."""
    alive = np.arange(len(words))
    text = np.repeat(np.arange(len(marks) - 1), np.diff(marks))
    done = []
    while len(alive):
        new = np.ones(len(alive), dtype=bool)
        new[1:] = (np.diff(alive) > 1) | (np.diff(text[alive]) > 0)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(alive)))
        segment = np.repeat(np.arange(len(first)), size)
        # Counts of each word within its segment; the key mixes both, all segments are counted at once.
        with np.errstate(over="ignore"):
            key = mix64(words[alive] + mix64(segment.astype(np.uint64) + np.uint64(1)))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        stays = times[which] >= TURNS
        whole = (np.logical_and.reduceat(stays, first)) & (size >= LEAST)
        done += [(int(alive[f]), int(alive[f] + n)) for f, n in zip(first[whole], size[whole])]
        alive = alive[stays & ~np.repeat(whole | (size < LEAST), size)]
    return done


# ----------------------------------------------------------------- lag scan
def _agreement(words: np.ndarray, lag: int, at: int) -> tuple[int, int]:
    """The stretch around ``at`` in which each word equals the one a lag later."""
    last = len(words) - lag
    end, step = at, _STRETCH
    while end < last:
        upto = min(end + step, last)
        differ = words[end:upto] != words[end + lag:upto + lag]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = upto, step * 2
    start, step = at, _STRETCH
    while start > 0:
        since = max(start - step, 0)
        differ = (words[since:start] != words[since + lag:start + lag])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = since, step * 2
    return start, end


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a segment."""
    n, found = len(words), []
    covered = np.zeros(n, dtype=np.int64)  # end of the farthest known run over each word
    for lag in range(1, n // TURNS + 1):
        least = max(LEAST, TURNS * lag) - lag
        hit = words[:n - lag:lag] == words[lag::lag]
        # A stretch of (TURNS - 1) * lag words holds that many of the points looked at.
        row = hit[:len(hit) - TURNS + 2].copy()
        for k in range(1, TURNS - 1):
            row &= hit[k:len(hit) - TURNS + 2 + k]
        if not row.any():
            continue
        passed = 0
        for at in (np.flatnonzero(row) * lag).tolist():
            if at < passed or covered[at] > at + (TURNS - 1) * lag:
                continue
            start, end = _agreement(words, lag, at)
            passed = max(end, at + 1)
            if end - start >= least and covered[start] < end + lag:
                found.append((start, end + lag - start, lag))
                np.maximum(covered[start:end + lag], end + lag, out=covered[start:end + lag])
    return found


def runs_of(words: np.ndarray, marks: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, word numbers counted from its first word, by start and period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(marks) - 1)]
    for start, end in segments(words, marks):
        text = int(np.searchsorted(marks, start, side="right")) - 1
        before = start - int(marks[text])
        found[text] += [(before + s, n, q) for s, n, q in lag_scan(words[start:end])]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run only its first turn and what no run repeats."""
    words = text.split()
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


# ------------------------------------------------------------------ on Spark
def collapse_runs(docs: DataFrame, text: str = "text", runs: str = "runs") -> DataFrame:
    """``docs`` with the periodic runs of ``text`` as one more column, and ``text`` without their repeats.

    Words are runs of characters other than space and 0x09-0x0D, numbered from 0.  ``runs`` holds
    (start, length, period) by start, then period.  A word that some run contains after its first
    ``period`` words goes; the words that stay are joined by one space.

    A null or empty text gives no runs and an empty text.  Texts of any length are read whole; a
    text is one row and never leaves its task.  Each row is judged by its own text, so ties and
    repeated rows come out alike; an empty table gives no rows.  All other columns, null or not,
    come through unchanged, and nothing of the operator's own is among them; a column that is
    called like ``runs`` already is an error.
    """
    if any(c.lower() == runs.lower() for c in docs.columns):
        raise ValueError(f"a column is called {runs} already")
    place, names = docs.columns.index(text), [*docs.columns, runs]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for piece in pieces(batch, text):
                texts = texts_of(piece.column(place))
                found = runs_of(*hashed_words(texts, lower=False))
                short = pa.array([collapsed(t, r) for t, r in zip(texts, found)], pa.binary()).cast(pa.string())
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
                flat = np.array([x for r in found for x in r], dtype=np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind.value_type))
                columns = [*piece.columns, pa.ListArray.from_arrays(pa.array(offsets), structs, type=kind)]
                columns[place] = short
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{fields}, `{runs}` array<{RUN}>")


def longest_turns(runs: Column) -> Column:
    """The run of the greatest length / period, compared as whole numbers; ties go to the first."""
    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def run_lines(runs: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.array_join(F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")

"""A Bloom filter of 64-bit names that tasks share: of bounded size, whatever it holds.

It never denies a name that was put in.  More names than it has room for make it say yes too often,
which costs its user work and never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_U = np.uint64
#: Bits for each name, and at most (2**27 bits are 16 MB).
BITS_A_NAME, LEAST_LOG, MOST_LOG = 10, 13, 27
_BLOCK_LOG = 19
_FACTORS = (_U(1), _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))


def _places(names: np.ndarray, log: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        for factor in _FACTORS:
            yield (names * factor) >> _U(64 - log)


def has(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which of the names (mixed 64-bit numbers) the filter may hold."""
    log = int(len(bits) * 8).bit_length() - 1
    found = np.ones(len(names), dtype=bool)
    for place in _places(names, log):
        found &= ((bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1).astype(bool)
    return found


def filter_of(names: DataFrame, count: int) -> np.ndarray:
    """The filter of a table's only column of ``count`` longs; at most 2**MOST_LOG bits reach the driver."""
    log = min(max(int(BITS_A_NAME * count).bit_length(), LEAST_LOG), MOST_LOG)
    block_log = min(log, _BLOCK_LOG)
    column = names.columns[0]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
            place = np.unique(np.concatenate(list(_places(values, log)))) if len(values) else values
            which = place >> _U(block_log)
            for block in np.unique(which).tolist():
                yield _row(block, place[which == _U(block)] & _U((1 << block_log) - 1), block_log)

    def merged(table: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()])
        return pa.table({"block": table.column("block").slice(0, 1), "bits": pa.array([whole.tobytes()], pa.binary())})

    schema = "block int, bits binary"
    rows = names.select(column).mapInArrow(parts, schema).groupBy("block").applyInArrow(merged, schema).collect()
    bits = np.zeros(1 << log >> 3, dtype=np.uint8)
    width = 1 << block_log >> 3
    for row in rows:
        bits[row["block"] * width:(row["block"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _row(block: int, places: np.ndarray, block_log: int) -> pa.RecordBatch:
    flags = np.zeros(1 << block_log, dtype=bool)
    flags[places] = True
    packed = np.packbits(flags, bitorder="little").tobytes()
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bits": pa.array([packed], pa.binary())})

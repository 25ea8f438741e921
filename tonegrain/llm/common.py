"""Helpers of the training-data operators: batches in pieces, word hashes, shared folders."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tonegrain.session import checkpoint_dir

PIECE_BYTES = 4 << 20
SHINGLE_WORDS = 5
#: The characters that separate words.
SPACES = " \t\n\x0b\x0c\r"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


_SHIPPED: set[str] = set()


# --------------------------------------------------------------------- sessions
def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, in case they cannot import it."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        root = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / "tonegrain_package.zip"  # the driver's own; Spark serves it
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared checkpoint folder, as a URI or a plain path."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared checkpoint folder from now on."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table in the shared folder, so that Spark knows their size."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def open_folder(uri: str):
    """File system and path of a folder any executor can reach (local mount or object store)."""
    from pyarrow import fs

    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, chunks: Iterator[bytes]) -> int:
    """Write one file of a task; the name must be new for each attempt.  Returns its size."""
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    size = 0
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        for chunk in chunks:
            size += len(chunk)
            out.write(chunk)
    return size


# ---------------------------------------------------------------------- batches
def release_memory() -> None:
    """Give what a task has freed back to the machine: its worker stays for later stages, and idles beside theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches, and :func:`release_memory` behind the last one."""
    yield from batches
    release_memory()


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about ``most`` bytes in ``column``, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def ragged(flat: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``flat[offsets[i]:offsets[i+1]]`` of each picked i behind one another, and their lengths."""
    lens = (offsets[1:] - offsets[:-1])[pick]
    ends = np.cumsum(lens)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[pick] - (ends - lens), lens)
    return flat[at], lens


# ------------------------------------------------------------------------ words
#: Bytes of text that are hashed at a time.
BLOCK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U(32))


_FACTORS = mix64(np.arange(1, 1025, dtype=_U)) | _U(1)


def word_spans(texts: list[bytes], lower: bool, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts behind one another: bytes, 64-bit hashes, starts, ends, and each text's first word (n + 1 marks).

    A word is a run of bytes that ``apart`` does not hold, by default other than space and
    0x09-0x0D.  Its hash adds its bytes times an odd random multiplier of their position, so it
    depends on every byte.  The bytes are looked at a block at a time, so that a text, or a
    word, of any length needs little more memory than its words.
    """
    joined = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    marks = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))).astype(np.int64)
    starts, lens, sums, goes_on = [], [], [], False
    for at in range(0, len(joined), BLOCK_BYTES):
        block = joined[at:at + BLOCK_BYTES]
        inside = ~apart[block]
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        first_byte, n = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        n -= first_byte
        goes_on, more = bool(inside[-1]), goes_on and bool(inside[0])
        if not len(n):
            continue
        letters = block[inside]
        if lower:
            letters = _LOWER[letters]
        first = np.cumsum(n) - n
        position = np.arange(len(letters)) - np.repeat(first, n)
        if more:
            position[:n[0]] += lens[-1][-1]
        factor = _FACTORS[position] if position.max() < len(_FACTORS) else mix64(position.astype(_U) + _U(1)) | _U(1)
        with np.errstate(over="ignore"):
            total = np.add.reduceat((letters.astype(_U) + _U(1)) * factor, first)
            if more:  # the first word of this block is the rest of the last one of the block before
                sums[-1][-1] += total[0]
        if more:
            lens[-1][-1] += n[0]
            first_byte, n, total = first_byte[1:], n[1:], total[1:]
        if len(n):
            starts.append(first_byte + at)
            lens.append(n)
            sums.append(total)
    if not starts:
        none = np.empty(0, dtype=np.int64)
        return joined, none.astype(_U), none, none, np.zeros(len(marks), dtype=np.int64)
    start, size = np.concatenate(starts), np.concatenate(lens)
    with np.errstate(over="ignore"):
        hashes = mix64(np.concatenate(sums) ^ (size.astype(_U) * _U(0xD6E8FEB86659FD93)))
    return joined, hashes, start, start + size, np.searchsorted(start, marks)


def hashed_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts behind one another, and each text's first word (n + 1 marks)."""
    _, hashes, _, _, marks = word_spans(texts, lower)
    return hashes, marks


def windows(words: np.ndarray, marks: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside one text, in order, and the marks of the texts.

    A text with fewer words, but at least one, has its whole sequence as its only run.
    """
    counts = np.diff(marks)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_marks = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
    out = np.empty(out_marks[-1], dtype=_U)
    with np.errstate(over="ignore"):
        if len(words) >= width:
            m = len(words) - width + 1
            h = np.full(m, width, dtype=_U)
            for k in range(width):
                h = mix64(h * _U(0x9E3779B97F4A7C15) + words[k:k + m])
            long = np.flatnonzero(counts >= width)
            lens = n[long]
            at = np.arange(lens.sum()) + np.repeat(marks[:-1][long] - (np.cumsum(lens) - lens), lens)
            into = np.arange(lens.sum()) + np.repeat(out_marks[:-1][long] - (np.cumsum(lens) - lens), lens)
            out[into] = h[at]
        for i in np.flatnonzero((counts > 0) & (counts < width)):
            h = np.full(1, counts[i], dtype=_U)
            for k in range(marks[i], marks[i + 1]):
                h = mix64(h * _U(0x9E3779B97F4A7C15) + words[k:k + 1])
            out[out_marks[i]] = h[0]
    return out, out_marks


def distinct_sorted(values: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and the new marks."""
    values = values.copy()
    for start, end in zip(marks[:-1].tolist(), marks[1:].tolist()):
        if end - start > 1:
            values[start:end].sort()
    if not len(values):
        return values, marks
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[marks[:-1][marks[:-1] < len(values)]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return values[keep], kept[marks]


def temp_name(prefix: str, suffix: str) -> str:
    """A file name that no other attempt of the task has."""
    from pyspark import TaskContext

    context = TaskContext.get()
    part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, os.getpid())
    return f"{prefix}-{part:06d}-{attempt}-{uuid.uuid4().hex[:8]}{suffix}"

"""A gram index of the stored chunk table: which files can hold a keyword at all.

For each file of the table it has a bitmap of the three-byte grams of its texts (A-Z in lower case,
hashed to ``BITS`` places), 32 KB whatever the size of the file.  A file whose bitmap lacks a gram of the
keyword is not opened.  The other ones are searched as ever, so the answer is exact.  Files
that were written since are searched without the index, and entries of files that are gone are
passed over, so it may lag behind the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.operators.records import RECORD_COLUMNS, RECORD_SCHEMA
from tonegrain.operators.search import search
from tonegrain.sources.tables import has_files, read_records

BITS = 1 << 18
_SCHEMA = "file string, bits binary"
_FOLD = np.frombuffer(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)), dtype=np.uint8)
#: Bytes of text that are hashed at a time.
_BLOCK = 1 << 22


def _hashed(codes: np.ndarray) -> np.ndarray:
    """The bit of every gram of folded bytes."""
    codes = codes.astype(np.uint32)
    return ((codes[:-2] | codes[1:-1] << np.uint32(8) | codes[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(14)


def _places(text: bytes) -> np.ndarray:
    """The bit of every gram of a text."""
    return _hashed(_FOLD[np.frombuffer(text, dtype=np.uint8)])


def _mark(flags: np.ndarray, texts: pa.Array) -> None:
    """Set the bits of all grams of some texts, which lie behind each other in memory."""
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if ends[-1] == ends[0]:
        return
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    for at in range(ends[0], ends[-1], _BLOCK):
        block = _FOLD[data[at:min(at + _BLOCK + 2, ends[-1])]]
        # No gram runs from one text into the next.
        inner = ends[np.searchsorted(ends, at, "right"):np.searchsorted(ends, at + len(block))] - at
        own = np.ones(max(len(block) - 2, 0), dtype=bool)
        for back in (1, 2):
            starts = inner - back
            own[starts[(starts >= 0) & (starts < len(own))]] = False
        flags[_hashed(block)[own]] = True


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        files, texts = batch.column("file").dictionary_encode(), batch.column("text").cast(pa.large_binary()).fill_null(b"")
        for k, path in enumerate(files.dictionary.to_pylist()):
            flags = held.setdefault(path, np.zeros(BITS, dtype=bool))
            _mark(flags, texts if len(files.dictionary) == 1 else texts.filter(pc.equal(files.indices, k)))
    bits = [np.packbits(f, bitorder="little").tobytes() for f in held.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(bits, pa.binary())], names=["file", "bits"])


def _merged(table: pa.Table) -> pa.Table:
    bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table.column("bits").to_pylist()])
    return pa.table({"file": table.column("file").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})


def _indexed(spark: SparkSession, index_path: str) -> DataFrame:
    if not has_files(spark, index_path):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(index_path)


def _files(spark: SparkSession, path: str) -> dict[str, str]:
    """The table's files, by their URI with one slash behind the scheme: it comes with one or three."""
    return {re.sub("^([^/:]+):/+", r"\1:/", f): f for f in read_records(spark, path).inputFiles()}


def _table(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The rows of some files of the table, which Spark lists as URIs, and the URI of each row's file."""
    if not files:
        return spark.createDataFrame([], RECORD_SCHEMA).select(*RECORD_COLUMNS)
    return spark.read.schema(RECORD_SCHEMA).option("basePath", path).parquet(*map(unquote, files)).select("*", F.regexp_replace("_metadata.file_path", "^([^/:]+):/+", "$1:/").alias("_file"))


def update_index(spark: SparkSession, path: str, index_path: str) -> int:
    """Index the files of the table at ``path`` that are not indexed yet; returns how many."""
    known = {r[0] for r in _indexed(spark, index_path).select("file").collect()}  # a name for each file, as Spark lists them itself
    new = [f for name, f in _files(spark, path).items() if name not in known]
    if new:
        texts = _table(spark, path, new).select(F.col("_file").alias("file"), F.col("chunk_text").alias("text"))
        texts.mapInArrow(_bitmaps, _SCHEMA).groupBy("file").applyInArrow(_merged, _SCHEMA).write.mode("append").parquet(index_path)
    return len(new)


def keyword_places(keyword: str, literal: bool = False) -> list[int]:
    """The bits that a text with the keyword has; none for keywords without three letters in a row."""
    parts = [keyword] if literal else re.split("[%_]", keyword)
    return sorted({int(p) for part in parts for p in _places(part.encode("utf-8", "surrogatepass"))})


def _has(place: int) -> Column:
    byte = F.conv(F.hex(F.substring("bits", place // 8 + 1, 1)), 16, 10).cast("int")
    return byte.bitwiseAND(1 << place % 8) != 0


def candidate_files(spark: SparkSession, path: str, index_path: str, keyword: str, literal: bool = False) -> list[str]:
    """The files of the table that can hold the keyword."""
    files = _files(spark, path)
    places = keyword_places(keyword, literal)
    if not places:
        return list(files.values())
    lacks = F.lit(False)
    for place in places:
        lacks = lacks | ~_has(place)
    without = {r[0] for r in _indexed(spark, index_path).where(lacks).select("file").collect()}
    return [f for name, f in files.items() if name not in without]


def search_indexed(spark: SparkSession, path: str, index_path: str, keyword: str, *, literal: bool = False, **filters) -> DataFrame:
    """``search.search`` over the stored table, opening only files that can hold the keyword."""
    files = candidate_files(spark, path, index_path, keyword, literal)
    return search(_table(spark, path, files).select(*RECORD_COLUMNS), keyword=keyword, literal=literal, **filters)

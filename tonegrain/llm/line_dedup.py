"""Line dedup by overlapping three-line windows.

Every run of three consecutive lines is hashed (128 bits), repeated windows are found over
the whole corpus by one pre-aggregated grouping, and the lines that later occurrences cover
go.  Only hashes and line numbers travel, but for one join that takes the covered lines back
to their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tonegrain.llm.bitset import filter_of, has
from tonegrain.llm.common import SPACES, cut_lineage, pieces, release_memory, released, written

WINDOW_LINES = 3


def _row_key(doc_id: str, text: str):
    """Rows of one key have one text and one doc_id, so they share their fate."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))))


def line_windows(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """(hash, doc_id, key, lines): each run of ``width`` lines that are not blank, with their line numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows: tuple[list, list, list, list] = ([], [], [], [])
                for doc_id, key, text in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                    lines = text.split("\n") if text else []
                    at = [i for i, line in enumerate(lines) if line.strip(SPACES)]
                    for k in range(len(at) - width + 1):
                        numbers = at[k:k + width]
                        window = "\n".join([lines[i] for i in numbers]).encode("utf-8", "surrogatepass")
                        for column, value in zip(rows, (hashlib.blake2b(window, digest_size=16).digest(), doc_id, key, numbers)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int64()),
                    pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.list_(pa.int32())),
                ], ["hash", "doc_id", "key", "lines"])

    return docs.mapInArrow(lambda batches: released(run(batches)), "hash binary, doc_id long, key binary, lines array<int>")


def covered_lines(docs: DataFrame, width: int = WINDOW_LINES) -> DataFrame:
    """(key, covered): the line numbers of each row that later occurrences of windows cover."""
    found = line_windows(docs, width)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", F.col("lines")[0].alias("line"), "lines")
    first = found.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A table of its own, so that Spark can split the join at a window that half the corpus has.
    first = cut_lineage(first.select("hash", "first.key", F.col("first.lines").alias("own")).withColumnRenamed("key", "first_key"))
    later = found.join(first, "hash").where((F.col("key") != F.col("first_key")) | (F.col("lines") != F.col("own")))
    beyond = F.when(
        F.col("key") == F.col("first_key"), F.filter("lines", lambda i: i > F.element_at("own", -1))
    ).otherwise(F.col("lines"))
    return later.select("key", F.explode(beyond).alias("line")).distinct().groupBy("key").agg(F.collect_list("line").alias("covered"))


def dedup_lines(docs: DataFrame, width: int = WINDOW_LINES, removed: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the lines that repeat an earlier run of ``width`` lines.

    Lines end at ``\\n`` and compare exactly; blank ones (only space and 0x09-0x0D) are passed
    over by windows and stay.  Occurrences are ordered by doc_id (null last), then by line; the
    first of a window stays, and of each later one the lines go that are not part of the first
    itself.  A text with fewer than ``width`` lines that are not blank has no window.  All rows
    stay, with an empty text if nothing is left; a null text stays null.  Rows that are equal in
    doc_id and text count as one occurrence and are treated alike.  All columns are kept, whatever
    their names; ``removed`` names an optional column with the number of lines that went, and is an
    error if there is such a column.  Texts of any length are read whole; an empty table stays empty.
    """
    if removed and removed.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"a column is called {removed} already")
    keyed = docs.select(_row_key("doc_id", "text").alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))
    slim = keyed.select(F.col("record.doc_id").cast("long").alias("doc_id"), "key", F.col("record.text").alias("text"))
    gone = written(covered_lines(slim, width), "covered-lines")
    # Most rows lose nothing.  A filter of bounded size tells them, and their texts stay where they are; the
    # other ones, and the few that it mistakes for them, meet their lines by a shuffle.
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(gone.select(F.xxhash64("key").alias("name")), gone.count()))

    def picked(touched: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = has(bits.value, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
                yield batch.filter(pa.array(found == touched))
            release_memory()

        return pick

    record = T.StructField("record", docs.schema, False)
    named = keyed.select("record", "key", F.xxhash64("key").alias("name"))
    schema = T.StructType([record, T.StructField("key", T.BinaryType()), T.StructField("name", T.LongType())])
    same = named.mapInArrow(picked(False), schema).select("record", F.lit(0).cast("long").alias("removed"))
    joined = named.mapInArrow(picked(True), schema).join(gone, "key", "left").select("record", "covered")
    text_at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, columns, covered = batch.column(0).type, batch.column(0).flatten(), batch.column(1).to_pylist()
            if any(covered):
                values = columns[text_at].to_pylist()
                for i, lines in enumerate(covered):
                    if lines:
                        away = set(lines)
                        values[i] = "\n".join([x for k, x in enumerate(values[i].split("\n")) if k not in away])
                columns[text_at] = pa.array(values, columns[text_at].type)
            counts = pa.array([len(c) if c else 0 for c in covered], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, fields=list(kind)), counts], ["record", "removed"])

    out = same.union(joined.mapInArrow(lambda batches: released(run(batches)), T.StructType([record, T.StructField("removed", T.LongType())])))
    return out.select("record.*", *([F.col("removed").alias(removed)] if removed else []))

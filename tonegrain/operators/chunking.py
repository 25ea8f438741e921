"""Group the lines of a file into chunks whose size depends on the file's line count.

Two forms with the same result:

* ``explode_chunks`` when the lines of a file sit in one row (documents, small files):
  array functions inside the row, no shuffle at all;
* ``assemble_chunks`` when every line is a row (large files): one shuffle on
  ``(file, chunk_index)``.  A group never holds more than one chunk, so a file with a
  third of all lines spreads over as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.functions.text import as_column, let
from tonegrain.lexicon import CHUNK_SIZES, LARGEST_CHUNK_SIZE
from tonegrain.operators.unnest import each_struct


def chunk_size(total_lines: Column | str) -> Column:
    """Lines per chunk for a file of ``total_lines`` non-blank lines."""
    n = as_column(total_lines)
    (bound, size), *rest = CHUNK_SIZES
    out = F.when(n < bound, F.lit(size))
    for bound, size in rest:
        out = out.when(n < bound, F.lit(size))
    return out.otherwise(F.lit(LARGEST_CHUNK_SIZE))


def chunk_index(line_no: Column | str, total_lines: Column | str) -> Column:
    """Chunk of a 0-based line number."""
    return F.floor(as_column(line_no) / chunk_size(total_lines)).cast("long")


def chunk_count(total_lines: Column | str) -> Column:
    n = as_column(total_lines)
    return F.ceil(n / chunk_size(n)).cast("long")


def chunk_array(lines: Column) -> Column:
    """Chunks of one file's lines: ``array<struct<chunk_index, chunk_text, chunk_lines>>``."""

    def cut(ls: Column, size: Column) -> Column:
        numbers = F.when(F.size(ls) == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / size).cast("int"))
        )

        def one(k: Column) -> Column:
            part = F.slice(ls, k * size + 1, size)
            return F.struct(
                k.cast("long").alias("chunk_index"),
                F.array_join(part, " ").alias("chunk_text"),
                F.size(part).cast("long").alias("chunk_lines"),
            )

        return F.transform(numbers, one)

    return let(lines, lambda ls: let(chunk_size(F.size(ls)), lambda size: cut(ls, size)))


def explode_chunks(df: DataFrame, lines: Column, keep: list[str]) -> DataFrame:
    """One row per chunk out of one row per file; ``lines`` is an array of its lines."""
    chunked = df.select(*keep, chunk_array(lines).alias("_chunks"))
    total = F.size("_chunks").cast("long").alias("total_chunks")
    return each_struct(chunked, [*keep, total], "_chunks", "chunk_index")


def assemble_chunks(numbered: DataFrame, file_cols: list[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """Chunks out of numbered lines (``line_no``, ``line``, ``total_lines``).

    ``carry`` adds aggregates over the lines of a chunk, by name.
    """
    lines = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    extra = [c.alias(name) for name, c in (carry or {}).items()]
    # The partition count is given, so that scoring, which follows in the same stage and
    # is heavy per byte, is not squeezed into a few tasks by size.  The grouping reuses
    # this shuffle.
    partitions = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        numbered.withColumn("chunk_index", chunk_index("line_no", "total_lines"))
        .repartition(partitions, *file_cols, "chunk_index")
        .groupBy(*file_cols, "chunk_index")
        .agg(lines.alias("_lines"), F.max("total_lines").alias("total_lines"), *extra)
        .select(
            *file_cols, "chunk_index",
            F.array_join(F.transform("_lines", lambda x: x["line"]), " ").alias("chunk_text"),
            F.size("_lines").cast("long").alias("chunk_lines"),
            chunk_count("total_lines").alias("total_chunks"),
            *list(carry or {}),
        )
    )

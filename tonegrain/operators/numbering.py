"""Gap-free line numbers without sorting a file in one task.

``row_number()`` over a file puts the whole file into one task, and one file may hold
a third of all rows.  Here rows are numbered inside small pieces, the pieces are
counted, and running sums over the counts give every piece its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A piece covers this many values of the order column, and so do the levels above it:
# with 2**16, three levels cover every 64-bit key and no window group exceeds 2**16 rows.
SPAN = 1 << 16
LEVELS = 3


def _sum_before(group: list[str], order: str, count: str) -> Column:
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(earlier), F.lit(0))


def piece_offsets(counts: DataFrame, file_cols: list[str], piece_col: str) -> DataFrame:
    """Add ``lines_before`` and ``total_lines`` to ``piece_lines`` per piece of a file.

    For pieces that are few per file, such as the splits of one file.
    """
    return counts.select(
        *file_cols, piece_col, "piece_lines",
        _sum_before(file_cols, piece_col, "piece_lines").alias("lines_before"),
        F.sum("piece_lines").over(Window.partitionBy(*file_cols)).alias("total_lines"),
    )


def nested_offsets(counts: DataFrame, file_cols: list[str], pieces: list[str]) -> DataFrame:
    """The same for any number of pieces: pieces are summed up within wider pieces, those
    within wider ones again, and the offsets are added on the way back down.

    ``pieces`` names the piece columns, the narrowest first.
    """
    tables = [counts]
    for level in range(1, len(pieces)):
        tables.append(
            tables[-1].groupBy(*file_cols, *pieces[level:]).agg(F.sum("piece_lines").alias("piece_lines"))
        )
    out = piece_offsets(tables[-1], file_cols, pieces[-1]).drop("piece_lines")
    for level in range(len(pieces) - 2, -1, -1):
        own, parent = pieces[level], pieces[level + 1]
        group = [*file_cols, parent]
        inner = tables[level].select(*group, own, _sum_before(group, own, "piece_lines").alias("_within"))
        out = inner.join(out, group).select(
            *file_cols, own, (F.col("lines_before") + F.col("_within")).alias("lines_before"), "total_lines"
        )
    return out


def number_lines(df: DataFrame, file_cols: list[str], order_col: str, span: int = SPAN, levels: int = LEVELS) -> DataFrame:
    """Add 0-based ``line_no`` and ``total_lines`` per file, in ``order_col`` order.

    ``order_col`` is an integer, unique within a file, dense or not; neither it nor the file
    may be NULL.  No window group holds more than ``span`` rows.  The join and the window use
    the same keys, so lines are shuffled once whether or not the offsets are broadcast;
    Spark broadcasts them only when they measure below its threshold.
    """
    pieces = [f"_piece{level}" for level in range(levels)]
    keyed, inner = df, order_col
    for piece in pieces:
        keyed = keyed.withColumn(piece, F.floor(F.col(inner) / F.lit(span)))
        inner = piece
    counts = keyed.groupBy(*file_cols, *pieces).agg(F.count(F.lit(1)).alias("piece_lines"))
    # All levels start from these counts.  Stating here the null tests that the joins below
    # imply keeps their plans alike, so that the counting is run once and reused.
    for col in (*file_cols, *pieces):
        counts = counts.filter(F.col(col).isNotNull())
    within = Window.partitionBy(*file_cols, pieces[0]).orderBy(order_col)
    return (
        keyed.withColumn("_rank", F.row_number().over(within))
        .join(nested_offsets(counts, file_cols, pieces), [*file_cols, pieces[0]])
        .withColumn("line_no", F.col("lines_before") + F.col("_rank") - 1)
        .drop(*pieces, "_rank", "lines_before")
    )

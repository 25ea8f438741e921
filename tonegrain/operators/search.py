"""Filtered search over the chunk table, paging, suggestions and page data."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.functions.text import fold_ascii
from tonegrain.operators.records import LIST_COLUMNS, ORDER_KEY
from tonegrain.operators.topn import top_n


def newest_first() -> list[Column]:
    return [F.desc(c) for c in ORDER_KEY]


def oldest_first() -> list[Column]:
    return [F.asc(c) for c in ORDER_KEY]


def keyword_test(keyword: str, text_col: str = "chunk_text", *, literal: bool = False) -> Column:
    """ASCII-case-insensitive substring test; ``%`` and ``_`` are wildcards unless ``literal``."""
    folded = keyword.translate({c: c + 32 for c in range(65, 91)})
    text = fold_ascii(text_col)
    if literal or not set("%_") & set(keyword):
        test = text.contains(folded)
        # Lower-casing is quicker than folding and finds at least the same rows.
        return F.lower(F.col(text_col)).contains(folded) & test if keyword.isascii() else test
    # LIKE must not see an escape character, so take one the keyword does not hold.
    unused = next(chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in keyword)
    return F.like(text, F.lit(f"%{folded}%"), F.lit(unused))


def search(
    records: DataFrame, keyword: str | None = None, min_score: float | None = None,
    max_score: float | None = None, label: str | None = None, batch_id: str | None = None,
    date_from: str | date | datetime | None = None, date_to: str | date | datetime | None = None,
    *, literal: bool = False,
) -> DataFrame:
    """Rows that pass all given filters; empty text filters are no filters, bounds are inclusive.

    A bare date as ``date_to`` means its midnight.
    """
    tests: list[Column] = []
    if batch_id:
        tests.append(F.col("batch_id") == batch_id)
    if label:
        tests.append(F.col("sentiment_label") == label)
    if min_score is not None:
        tests.append(F.col("sentiment_score") >= min_score)
    if max_score is not None:
        tests.append(F.col("sentiment_score") <= max_score)
    if date_from:
        tests.append(F.col("processed_at") >= F.lit(date_from).cast("timestamp"))
    if date_to:
        tests.append(F.col("processed_at") <= F.lit(date_to).cast("timestamp"))
    if keyword:
        tests.append(keyword_test(keyword, literal=literal))
    return records.filter(reduce(lambda a, b: a & b, tests)) if tests else records


def total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("total"))


def page(hits: DataFrame, number: int = 1, size: int = 50) -> DataFrame:
    """One page, newest first, with ``result_no`` and ``tags_preview``.

    Pages below 1 act as page 1.  A negative size means no limit: all rows, sorted in parallel,
    with NULL as ``result_no``, since numbering them all would take one task.
    For pages far down use :func:`page_after`, whose cost does not grow with the depth.
    """
    if size < 0:
        return hits.withColumns({"result_no": F.lit(None).cast("int"), "tags_preview": tags_preview()}).orderBy(*newest_first())
    skip = max(0, (number - 1) * size)
    rows = top_n(hits, newest_first(), skip + size)
    # At most skip + size rows are left, in one partition after the limit.
    numbered = rows.withColumn("result_no", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(*newest_first())
    ))
    return numbered.filter(F.col("result_no") > skip).withColumn("tags_preview", tags_preview())


def page_after(hits: DataFrame, last_key: dict, size: int = 50) -> DataFrame:
    """The page that follows the row with the given key (keyset paging)."""
    key = F.struct(*ORDER_KEY)
    last = F.struct(*[F.lit(last_key[c]).alias(c) for c in ORDER_KEY])
    return top_n(hits.filter(key < last), newest_first(), size).withColumn("tags_preview", tags_preview())


def search_page(records: DataFrame, number: int = 1, size: int = 50, **filters) -> tuple[DataFrame, DataFrame]:
    """``(total, page)`` under the same filters."""
    hits = search(records, **filters)
    return total(hits), page(hits, number, size)


def tags_preview() -> Column:
    return F.array_join(F.slice("tags", 1, 2), ", ")


def page_count(total_rows: Column | int, size: int = 50) -> Column | int:
    if isinstance(total_rows, int):
        return ceil(total_rows / size) or 1
    return F.greatest(F.ceil(total_rows / size), F.lit(1)).cast("long")


def suggest(vocabulary: DataFrame, prefix: str, k: int = 8) -> DataFrame:
    """Words of a keyword table that start with the prefix, most frequent first."""
    start = prefix.strip().lower()
    rows = vocabulary.filter(F.col("word").startswith(start) if len(start) >= 2 else F.lit(False))
    return rows.orderBy(F.desc("n"), F.asc("word")).limit(k)


def flatten_lists(records: DataFrame) -> DataFrame:
    """List columns as text, joined by ", "."""
    return records.withColumns({c: F.array_join(c, ", ") for c in LIST_COLUMNS})


def export_rows(records: DataFrame, batch_id: str | None = None) -> DataFrame:
    """All rows (of a batch), oldest first, list columns as text."""
    return flatten_lists(search(records, batch_id=batch_id)).orderBy(*oldest_first())


def export_search(
    records: DataFrame, keyword: str, batch_id: str | None = None, limit: int | None = None,
) -> DataFrame:
    """All hits of a search, newest first, list columns as text: one range-partitioned sort.

    ``limit`` keeps the newest ones only.  It is applied to the keys alone: the oldest key that
    still fits is found first (narrow rows, merged in steps), then whole rows down to it are
    sorted in parallel.
    """
    hits = search(records, keyword=keyword, batch_id=batch_id)
    if limit is None:
        return flatten_lists(hits).orderBy(*newest_first())
    keys = top_n(hits.select(*ORDER_KEY), newest_first(), limit)
    oldest = keys.agg(F.min(F.struct(*ORDER_KEY)).alias("k"))
    kept = hits.filter(F.struct(*ORDER_KEY) >= oldest.scalar())
    return flatten_lists(kept).orderBy(*newest_first())

"""Rows out of an array column, computing the array once.

For a plain ``explode`` the planner puts a filter on the size of the array in front of it,
and with it a second copy of whatever builds the array.  The outer form followed by a
null test gives the same rows without that copy.  Elements are never NULL here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def each(df: DataFrame, keep: list[str | Column], array: Column | str, name: str, position: str | None = None) -> DataFrame:
    """``keep`` columns, the element as ``name`` and, if asked for, its 0-based ``position``."""
    one = F.posexplode_outer(array).alias(position, name) if position else F.explode_outer(array).alias(name)
    return df.select(*keep, one).filter(F.col(name).isNotNull())


def each_struct(df: DataFrame, keep: list[str | Column], array: Column | str, field: str) -> DataFrame:
    """``keep`` columns and the fields of each struct; ``field`` is one that is never NULL."""
    return df.select(*keep, F.inline_outer(array)).filter(F.col(field).isNotNull())

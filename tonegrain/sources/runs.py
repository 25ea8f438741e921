"""Records that run across the lines of a file read by splits.

Whether a line starts a record depends on everything before it.  A line is therefore summed up as
a step of a small automaton, whose state 0 means "between records": it leads to a fixed state, or
adds to the state.  Such steps compose, so a window over those of a split that change anything, and
one over the splits of a file, give every line its true first state.  Only numbers travel for that.

The lines of a record that runs across lines are then the only ones that meet by a shuffle; all
others are records by themselves, and stay where they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.functions.structured import delimited_lines, open_at_end, record_to_line
from tonegrain.operators.unnest import each
from tonegrain.session import broadcast_limit, shared_table

_SPLIT = ["file_path", "block_start"]
_LINE = [*_SPLIT, "rid"]
#: How much larger a stored table may be in memory.
_UNPACKED = 4


def _states(df: DataFrame, group: list[str], order: str, modulus: int) -> DataFrame:
    """Add the state before each row: ``state`` if the group starts in 0, and whether it is ``known``
    whatever the group starts in.

    A row has ``fixed`` (it leads to the state ``value``) or adds ``value`` to the state.
    """
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turn = F.when(F.col("fixed"), 0).otherwise(F.col("value"))
    counted = df.withColumn("_turns", F.sum(turn).over(upto))
    anchor = F.last(F.when(F.col("fixed"), F.struct("_turns", "value")), ignorenulls=True).over(before)
    since = F.col("_turns") - turn - F.coalesce(F.col("_anchor._turns"), F.lit(0))
    return counted.withColumn("_anchor", anchor).withColumns({
        "known": F.col("_anchor").isNotNull(),
        "state": F.pmod(F.coalesce(F.col("_anchor.value"), F.lit(0)) + since, F.lit(modulus)).cast("int"),
    }).drop("_turns", "_anchor")


def _run_lines(raw: DataFrame, step: Column, modulus: int) -> DataFrame:
    """(file_path, block_start, rid, first): the lines of records that run across lines, with the line
    (block_start, rid) that such a record starts with."""
    through = lambda state: F.when(F.col("fixed"), F.col("value")).otherwise(F.pmod(state + F.col("value"), F.lit(modulus))).cast("int")
    steps = raw.select(*_LINE, step.alias("step")).where("step IS NOT NULL").select(*_LINE, "step.fixed", "step.value")
    steps = shared_table(_states(steps, _SPLIT, "rid", modulus), "run-steps")
    # What a split does as a whole: its last step, behind the state that its other steps lead to.
    last = F.max_by(F.struct((F.col("fixed") | F.col("known")).alias("fixed"), through(F.col("state")).alias("value")), "rid")
    whole = steps.groupBy(*_SPLIT).agg(last.alias("whole")).select(*_SPLIT, "whole.*")
    splits = raw.groupBy(*_SPLIT).agg(F.min("rid").alias("lo"), F.max("rid").alias("hi")).join(whole, _SPLIT, "left")
    splits = splits.withColumns({"fixed": F.coalesce("fixed", F.lit(False)), "value": F.coalesce("value", F.lit(0))})
    # One row a split: a file of 100 TB has less than a million.
    starts = _states(splits, ["file_path"], "block_start", modulus).select(*_SPLIT, "lo", "hi", F.col("state").alias("start"))
    first_state = F.when(F.col("known"), F.col("state")).otherwise(F.pmod(F.col("state") + F.col("start"), F.lit(modulus)))
    changes = steps.join(starts, _SPLIT).withColumn("before", first_state).withColumn("after", through(F.col("before")))
    changes = changes.where((F.col("before") == 0) != (F.col("after") == 0)).withColumn("opens", F.col("before") == 0)
    following = F.lead("rid").over(Window.partitionBy(*_SPLIT).orderBy("rid"))
    changes = shared_table(changes.select(*_LINE, "lo", "hi", "opens", following.alias("next")), "run-changes")
    opened = changes.where("opens").select(
        *_SPLIT, F.struct("block_start", "rid").alias("first"), F.col("rid").alias("a"), F.coalesce("next", "hi").alias("z"))
    # A split that starts inside a record carries on the last one opened before it.
    own = changes.groupBy(*_SPLIT).agg(
        F.min("rid").alias("change"), F.max(F.when(F.col("opens"), F.struct("block_start", "rid"))).alias("opened"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.join(own, _SPLIT, "left").withColumn("first", F.last("opened", ignorenulls=True).over(earlier)).where("start <> 0")
    heads = carried.select(*_SPLIT, "first", F.col("lo").alias("a"), F.coalesce("change", "hi").alias("z"))
    stretches = opened.unionByName(heads)
    return stretches.select(*_SPLIT, "first", F.explode(F.sequence("a", "z")).alias("rid"))


def attach(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """``rows`` joined with a stored ``table``, in the order of each split.

    A table that measures below Spark's threshold is broadcast, and rows stay where they are.  Beyond
    it the splits are gathered again, by ``rid``.
    """
    stats = table._jdf.queryExecution().optimizedPlan().stats()
    if int(str(stats.sizeInBytes())) * _UNPACKED <= broadcast_limit(rows):
        return rows.join(F.broadcast(table), on, how)
    return rows.join(table, on, how).repartition(*_SPLIT).sortWithinPartitions(*_LINE)


def merge_runs(raw: DataFrame, step: Column, modulus: int, glue: str) -> DataFrame:
    """``raw`` with each record that runs across lines as one ``value`` at its first line, in the order of each split.

    ``raw`` has value, file_path, block_start and rid, ascending within a split, and any other
    columns.  ``step`` is a struct (fixed boolean, value int), null where a line changes nothing;
    ``glue`` is what stood between two lines.  A record that never ends takes in all that follows.
    """
    if raw.where(step["value"] != 0).isEmpty():
        return raw
    return merge_parts(raw, shared_table(_run_lines(raw, step, modulus), "run-lines"), glue)


def merge_parts(raw: DataFrame, parts: DataFrame, glue: str, stored: DataFrame | None = None) -> DataFrame:
    """``raw`` with the lines of each group of ``parts`` as one value at the first of them.

    ``parts`` is a stored table of (file_path, block_start, rid, first); see :func:`merge_runs`.  ``stored``
    has the lines of ``parts``, where they are stored apart from the other ones.
    """
    pieces = F.array_sort(F.collect_list(F.struct("block_start", "rid", "value")))
    text = F.array_join(F.transform(pieces, lambda p: p["value"]), glue)
    merged = (raw if stored is None else stored).join(parts, _LINE).groupBy("file_path", "first").agg(text.alias("whole")).select("file_path", "first.*", "whole")
    rest = parts.where("rid <> first.rid or block_start <> first.block_start").select(*_LINE, F.lit(None).cast("string").alias("whole"))
    changed = shared_table(merged.unionByName(rest).withColumn("changed", F.lit(True)), "runs")
    joined = attach(raw, changed, _LINE)
    value = F.when(F.col("changed"), F.col("whole")).otherwise(F.col("value"))
    columns = [value.alias("value") if c == "value" else F.col(c) for c in raw.columns]
    return joined.where("changed IS NULL OR whole IS NOT NULL").select(*columns)


# ------------------------------------------------------------------ delimited
def _quote_step(value: Column, sep: str) -> Column:
    """What a line does to the state "inside a quoted cell" (1)."""
    ends, goes_on = open_at_end(value, sep), open_at_end(F.concat(F.lit('"'), value), sep)
    step = F.struct((ends == goes_on).alias("fixed"), ends.cast("int").alias("value"))
    return F.when(value.contains('"') & (ends | ~goes_on), step)


def delimited_by_splits(reader, sep: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``line`` of every record of delimited files read by splits, in the order of each split.

    A record stands at its first line.  Blank records are out.  A quote that is never closed makes
    one record of all that follows, as in any reader of such files.
    """
    records = merge_runs(reader.pieces("\n"), _quote_step(F.col("value"), sep), 2, "\n")
    bare = F.rtrim(F.col("value"), F.lit("\r"))
    lines = F.when(bare.rlike("[\r\n]"), delimited_lines(bare, sep)).otherwise(F.array(record_to_line(bare, sep)))
    return each(records, keep, lines, "line").where("line <> ''")


# -------------------------------------------------------------- wide charsets
def aligned(raw: DataFrame, unit: int, glue: str) -> DataFrame:
    """Pieces of a charset of ``unit`` bytes a character unit, out of what lies between the bytes of a separator.

    These bytes also occur across two units.  A separator is one only where it ends a whole number
    of units, so pieces of another length go on in the next one.
    """
    rest = F.octet_length("value") % unit
    return merge_runs(raw, F.when(rest != 0, F.struct(F.lit(False).alias("fixed"), rest.cast("int").alias("value"))), unit, glue)

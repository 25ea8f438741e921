"""JSON arrays and markup by splits: formats in which a line break ends nothing.

A file is read in pieces between commas (JSON) or between ``>`` (markup).  One scan in order goes
through the pieces of each split and cuts them into fragments: whole elements or sentences, a head
that an earlier split began, a tail that goes on in a later one.  No text is shuffled but those heads
and tails, two of a split at most.  Built-in functions cannot look at the rows of a partition in order
without a shuffle, so the scan is an Arrow function; all else stays with them.

For JSON a structural index comes first.  A split is summed up by its quotes (odd or even) and by
how far brackets lead up or down if it starts outside a string, and if it starts inside one.
A sum over the splits of a file gives each its true start, and with it the commas that part the
elements of the array.  Whether the whole text is one JSON value is an aggregate over the fragments.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.functions.structured import is_json_value, json_element_line, json_line, json_lines
from tonegrain.functions.text import SPACE_CHARS, SPACE_LIST, strip
from tonegrain.operators.unnest import each
from tonegrain.session import shared_table
from tonegrain.sources.runs import attach, merge_parts

_SPLIT = ["file_path", "block_start"]
_FILE = ["file_path", "file_name", "file_size"]


@dataclass(frozen=True)
class Reader:
    """The large files of one format: in pieces between a separator, or whole."""

    pieces: Callable[[str], DataFrame]
    whole: Callable[[], DataFrame]


def _in_order(rows: DataFrame, scanner: Callable, columns: str) -> DataFrame:
    """What ``scanner(split values, first row of extra columns, batches)`` makes of each split, in order.

    ``rows`` holds FILE columns, block_start, value and what the scanner needs to start a split.
    """
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch.column(names.index("file_path")).dictionary_encode().indices.to_numpy()
            block = batch.column(names.index("block_start")).to_numpy()
            cuts = np.flatnonzero((np.diff(path) != 0) | (np.diff(block) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(a, b - a)
                first = {n: part.column(i)[0].as_py() for i, n in enumerate(names) if n not in ("value", "rid", "last")}
                if held != (first["file_path"], first["block_start"]):
                    if state is not None:
                        yield from state.end()
                    state, held = scanner(first), (first["file_path"], first["block_start"])
                yield from state.feed(part, names)
        if state is not None:
            yield from state.end()

    return rows.mapInArrow(run, columns)


# ------------------------------------------------------------------- JSON
_KIND = np.zeros(256, dtype=np.int8)
_QUOTE, _OPEN, _CLOSE, _COMMA = 1, 2, 3, 4
_KIND[ord('"')] = _QUOTE
_KIND[[ord("["), ord("{")]] = _OPEN
_KIND[[ord("]"), ord("}")]] = _CLOSE
_KIND[ord(",")] = _COMMA
_ESCAPE = re.compile(rb"\\.", re.DOTALL)


def _marks(part: pa.RecordBatch, names: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes of all pieces, a comma behind each, and the places and kinds of the marks of JSON in them."""
    data = b"".join([v + b"," for v in part.column(names.index("value")).cast(pa.binary()).to_pylist()])
    plain = _ESCAPE.sub(b"__", data) if b"\\" in data else data
    kind = _KIND[np.frombuffer(plain, dtype=np.uint8)]
    at = np.flatnonzero(kind)
    return data, at, kind[at]


class _Summary:
    """Quotes of a split (mod 2), and its change of depth from either state."""

    def __init__(self, first: dict):
        self.first, self.quotes, self.depth = first, 0, [0, 0]

    def feed(self, part: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
        _, at, kind = _marks(part, names)
        quoted = (kind == _QUOTE)
        inside = (self.quotes + np.cumsum(quoted)) % 2
        step = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
        for start in (0, 1):
            self.depth[start] += int(step[inside == start].sum())
        self.quotes = (self.quotes + int(quoted.sum())) % 2
        return iter(())

    def end(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({
            "file_path": [self.first["file_path"]], "block_start": [self.first["block_start"]], "quotes": pa.array([self.quotes], pa.int32()),
            "depth0": [self.depth[0]], "depth1": [self.depth[1]]})


class _Fragments:
    """Rows of one split: value, whether it goes on an earlier split's (head) or on in the next one (open)."""

    def __init__(self, first: dict):
        self.first, self.held, self.rows, self.head = first, [], [], first["block_start"] > 0

    def cut(self, is_open: bool, mark: int) -> None:
        self.rows.append((b"".join(self.held), self.head, is_open, mark))
        self.held, self.head = [], False

    def flushed(self) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        if rows:
            n, f = len(rows), self.first
            yield pa.RecordBatch.from_arrays([
                *[pa.array([f[c]] * n) for c in (*_FILE, "block_start")], pa.array([r[0] for r in rows], pa.binary()).cast(pa.string()),
                pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows], pa.int32())],
                [*_FILE, "block_start", "value", "head", "open", "mark"])

    def end(self) -> Iterator[pa.RecordBatch]:
        self.cut(True, self.now())
        yield from self.flushed()

    def now(self) -> int:
        return 0


_FRAGMENT = "file_path string, file_name string, file_size long, block_start long, value string, head boolean, open boolean, mark int"


class _Elements(_Fragments):
    """Elements of the top-level array of a JSON text; ``mark`` is 1 for them and 0 for what is around the array."""

    def __init__(self, first: dict):
        super().__init__(first)
        self.inside, self.depth = first["inside"], first["depth"]
        self.start = self.depth

    def now(self) -> int:
        return int(self.start > 0)

    def feed(self, part: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
        data, at, kind = _marks(part, names)
        quoted = kind == _QUOTE
        inside = (self.inside + np.cumsum(quoted)) % 2
        outside = (inside == 0) & ~quoted
        at, kind = at[outside], kind[outside]
        step = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
        depth = self.depth + np.cumsum(step)
        square = np.isin(np.frombuffer(data, dtype=np.uint8)[at], [ord("["), ord("]")])
        begins, ends = (kind == _OPEN) & (depth == 1) & square, (kind == _CLOSE) & (depth == 0) & square
        cuts = begins | ends | ((kind == _COMMA) & (depth == 1))
        last = 0
        for place, after in zip(at[cuts].tolist(), depth[cuts].tolist()):
            self.held.append(data[last:place])
            self.cut(False, self.now())
            last, self.start = place + 1, after
        self.held.append(data[last:])
        self.inside = (self.inside + int(quoted.sum())) % 2
        if len(depth):
            self.depth = int(depth[-1])
        yield from self.flushed()


def _joined(fragments: DataFrame) -> DataFrame:
    """Fragments with heads and tails put together, at the tail that began them."""
    rows = fragments.withColumn("rid", F.monotonically_increasing_id())
    upto = Window.partitionBy("file_path").orderBy("block_start", "rid").rowsBetween(Window.unboundedPreceding, 0)
    # Two rows a split at most.  They are stored with their texts, so that no other row is scanned for them again.
    edges = shared_table(rows.where("head OR open").select(*_SPLIT, "rid", "head", "value"), "fragment-edges")
    first = F.last(F.when(~F.col("head"), F.struct("block_start", "rid")), ignorenulls=True).over(upto)
    parts = shared_table(edges.select(*_SPLIT, "rid", first.alias("first")).where("first IS NOT NULL"), "fragment-parts")
    return merge_parts(rows, parts, "", edges)


def json_by_splits(reader: Reader, keep: list[str]) -> DataFrame:
    """``keep`` and ``line`` of JSON files: elements of an array, one value, or newline-delimited values.

    The structure of an array is followed over the splits.  A file is an array if nothing but
    blanks stands around one pair of brackets and every element is JSON by itself; that is counted
    over the fragments.  Another file that is one JSON value is a single line, or none, and read
    whole; all else is newline-delimited.
    """
    raw = reader.pieces(",")
    summed = _in_order(raw.select(*_SPLIT, "value"), _Summary, "file_path string, block_start long, quotes int, depth0 long, depth1 long")
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    states = summed.withColumn("inside", F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)).cast("int"))
    change = F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    # One row a split.
    starts = shared_table(states.select(*_SPLIT, "inside", F.coalesce(F.sum(change).over(earlier), F.lit(0)).alias("depth")), "json-starts")
    fragments = _joined(_in_order(attach(raw.select(*_FILE, "block_start", "rid", "value"), starts, _SPLIT), _Elements, _FRAGMENT))
    element, value = F.col("mark") == 1, F.col("value")
    around = F.regexp_replace(value, rf"[{SPACE_CHARS}]*,?[{SPACE_CHARS}]*\z", "") != ""
    blank = element & (strip(value) == "")
    wrong = F.when(element, ~blank & ~is_json_value(value)).otherwise(around)
    count = lambda test: F.sum(F.coalesce(test.cast("int"), F.lit(0)))
    judged = fragments.groupBy("file_path").agg(
        count(wrong).alias("wrong"), count(blank).alias("blank"), count(element).alias("elements"), count(~element).alias("around"))
    ends = raw.groupBy("file_path", "file_size").agg(F.sum(F.col("bytes") + 1).alias("read"))
    # A comma behind the last bracket shows only in the size (three bytes more with a byte order mark).
    closed = ends.select("file_path", (~(F.col("file_size") - F.col("read")).isin(0, 3)).alias("closed"))
    fine = (F.col("wrong") == 0) & (F.col("around") == 2) & F.col("closed") & ((F.col("blank") == 0) | (F.col("elements") == 1))
    arrays = shared_table(judged.join(closed, "file_path").select("file_path", fine.alias("array")), "json-arrays")
    parts = [each(attach(fragments.where(element), arrays, ["file_path"]).where("array"), keep, F.array(json_element_line(value)), "line")]
    other = arrays.where("NOT array")
    if not other.isEmpty():
        # An object over several lines: its first line is no value by itself, and the last one closes it.
        texts = attach(reader.pieces("\n"), arrays, ["file_path"]).where("NOT array")
        place, bare = F.struct("block_start", "rid"), strip(F.col("value"))
        some = texts.where(bare != "").groupBy("file_path").agg(
            F.count(F.lit(1)).alias("n"), F.min_by(F.left(bare, F.lit(1)), place).alias("first"),
            F.min_by(is_json_value("value"), place).alias("alone"), F.max_by(F.right(bare, F.lit(1)), place).alias("last"))
        one = shared_table(some.select("file_path", F.expr("n = 1 OR (first = '{' AND NOT alone AND last = '}')").alias("one")), "json-single")
        if not one.where("one").isEmpty():
            whole = reader.whole().join(one.where("one"), "file_path", "left_semi")
            parts.append(each(whole.withColumn("block_start", F.lit(0).cast("long")), keep, json_lines("value"), "line"))
        rest = each(attach(texts, one, ["file_path"]).where("NOT one"), keep, F.split("value", "\r"), "value")
        parts.append(each(rest, keep, F.array(json_line("value")), "line"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------ markup
_SPACES = f"[{re.escape(SPACE_LIST)}]"
_SENTENCE_END = re.compile(f"(?<=[.!?]){_SPACES}+")


class _Sentences(_Fragments):
    """Sentences of a markup text; pieces end with ``>``, but for the last one of a file that does not."""

    def feed(self, part: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
        for value, last in zip(part.column(names.index("value")).to_pylist(), part.column(names.index("last")).to_pylist()):
            at = -1 if last else value.find("<")
            text = value if last else value[:at] + " " if 0 <= at < len(value) - 1 else value + ">"
            begin = 0
            for end in _SENTENCE_END.finditer(text):
                self.held.append(text[begin:end.start()].encode("utf-8", "surrogatepass"))
                self.cut(False, 0)
                begin = end.end()
            self.held.append(text[begin:].encode("utf-8", "surrogatepass"))
        yield from self.flushed()


def markup_by_splits(reader: Reader, keep: list[str], min_chars: int = 11) -> DataFrame:
    """``keep`` and ``line`` of markup files: sentences, tags out, white space collapsed."""
    raw = reader.pieces(">")
    ends = raw.groupBy("file_path", "file_size").agg(F.max(F.struct("block_start", "rid")).alias("end"), F.sum(F.col("bytes") + 1).alias("read"))
    # The last piece of a file, if nothing closes it.
    ends = shared_table(ends.where(~(F.col("file_size") - F.col("read")).isin(0, 3)).select("file_path", "end"), "markup-ends")
    last = F.coalesce((F.col("block_start") == F.col("end.block_start")) & (F.col("rid") == F.col("end.rid")), F.lit(False))
    rows = attach(raw, ends, ["file_path"]).select(*_FILE, "block_start", "rid", "value", last.alias("last"))
    sentences = _joined(_in_order(rows, _Sentences, _FRAGMENT))
    line = strip(F.regexp_replace("value", rf"[{SPACE_CHARS}]+", " "))
    return sentences.withColumn("line", line).where(F.length("line") >= min_chars).select(*keep, "line")

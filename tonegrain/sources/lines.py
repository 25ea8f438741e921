"""Read files of any supported format into lines or chunks.

A file up to ``whole_file_limit`` bytes is one row: its lines, their numbers and its
chunks come out of array functions inside the row, with no shuffle.  A larger file is
read by splits, so that one huge file spreads over the cluster: lines are numbered
inside each split and moved by the running sum of the line counts of the splits before.
The size test is a file-level predicate, so each of the two scans opens only its files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.functions.text import clean_lines
from tonegrain.operators.chunking import assemble_chunks, explode_chunks
from tonegrain.operators.numbering import nested_offsets
from tonegrain.operators.unnest import each
from tonegrain.session import pin_file_splits, shared_table
from tonegrain.sources.formats import BY_SUFFIX, FORMATS, LineFormat, format_of
from tonegrain.sources.fragments import Reader
from tonegrain.sources.runs import aligned, attach

WHOLE_FILE_LIMIT = 64 * 1024 * 1024
STRETCH_BYTES = 64 << 30
FILE_COLS = ["file_path", "file_name", "file_size"]
#: Bytes of a character unit.  The plain names leave the byte order to a mark, big-endian without one.
_UNITS = {"UTF-16": 2, "UTF-16LE": 2, "UTF-16BE": 2, "UTF-32": 4}


def _decoded(value: Column, encoding: str) -> Column:
    """Bytes of a text column as text; malformed UTF-8 is replaced, never an error."""
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        return F.make_valid_utf8(value)
    return F.decode(value.cast("binary"), encoding)


def _glob(fmt: LineFormat) -> str:
    def any_case(suffix: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)

    return "*{" + ",".join(any_case(s) for s in fmt.suffixes) + "}"


def _scan(spark: SparkSession, paths: list[str], glob: str | None, whole: bool, **options: str) -> DataFrame:
    options |= {"pathGlobFilter": glob} if glob else {}
    # wholetext must be an argument: text() overrides the option of the same name.
    return spark.read.options(**options).text(paths, wholetext=whole).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def _whole_files(spark, paths, glob, fmt: LineFormat, encoding: str, limit: int | None) -> DataFrame:
    files = _whole_texts(spark, paths, glob, encoding)
    if limit is not None:
        files = files.filter(F.col("file_size") <= limit)
    return files.select(*FILE_COLS, fmt.whole(F.col("value")).alias("lines"))


def _wide_pieces(spark, paths, glob, name: str, limit: int, separator: str) -> DataFrame:
    """Decoded pieces of large files in a charset of wide units, as ``_pieces`` gives them."""
    unit, parts = _UNITS[name], []
    for order in ("LE", "BE"):
        if name[-2:] not in ("LE", "BE") or name.endswith(order):
            charset = name.removesuffix(order) + order
            mark = separator + "\0" * (unit - 1)
            raw = _scan(spark, paths, glob, False, lineSep=separator, encoding=charset).filter(F.col("file_size") > limit)
            raw = raw.withColumn("rid", F.monotonically_increasing_id())
            # One row a file: the piece at its start, and whether a mark there says little-endian.
            little = F.hex(F.min_by("value", "rid").cast("binary")).startswith("FFFE")
            heads = shared_table(raw.where("block_start = 0").groupBy("file_path").agg(F.min("rid").alias("start"), little.alias("little")), "file-heads")
            if charset != name:
                raw = attach(raw, heads, ["file_path"]).where(F.col("little") == (order == "LE")).select(*raw.columns)
            pieces = attach(aligned(raw, unit, mark if order == "LE" else mark[::-1]), heads, ["file_path"])
            # Spark decodes UTF-32 by its plain name only, little-endian behind a mark.
            ahead = F.lit(bytes.fromhex("FFFE0000" if charset == "UTF-32LE" else ""))
            text = F.decode(F.concat(ahead, F.col("value").cast("binary")), charset if unit == 2 else name)
            bare = F.when(F.col("rid") == F.col("start"), F.regexp_replace(text, r"\A\x{FEFF}", "")).otherwise(text)
            size = F.octet_length("value") + (unit - 1)  # so that a separator counts for one more
            parts.append(pieces.withColumns({"bytes": size, "value": bare}).select(*raw.columns, "bytes"))
    return _union(parts)


def _pieces(spark, paths, glob, encoding: str, limit: int, separator: str = "\n") -> DataFrame:
    """What lies between separators in large files: value, FILE_COLS, block_start, rid (ascending within a
    split) and its bytes."""
    name = encoding.upper().replace("_", "-")
    if name in _UNITS:
        return _wide_pieces(spark, paths, glob, name, limit, separator)
    raw = _scan(spark, paths, glob, False, lineSep=separator).filter(F.col("file_size") > limit)
    return raw.select(
        _decoded(F.col("value"), encoding).alias("value"), *FILE_COLS, "block_start", F.monotonically_increasing_id().alias("rid"),
        F.octet_length("value").alias("bytes"))


def _whole_texts(spark, paths, glob, encoding: str) -> DataFrame:
    """FILE_COLS and the text of each file as ``value``, without a byte order mark."""
    files = _scan(spark, paths, glob, whole=True)
    # The reader by splits drops a byte order mark, so it goes here too.
    return files.select(*FILE_COLS, F.regexp_replace(_decoded(F.col("value"), encoding), r"\A\x{FEFF}", "").alias("value"))


def _split_lines(spark, paths, glob, fmt: LineFormat, encoding: str, limit: int) -> DataFrame:
    """FILE_COLS, block_start, line of large files; lines of one split follow each other in one task."""
    keep = [*FILE_COLS, "block_start"]
    if fmt.by_splits:
        reader = Reader(lambda separator: _pieces(spark, paths, glob, encoding, limit, separator), lambda: _whole_texts(spark, paths, glob, encoding).filter(F.col("file_size") > limit))
        return fmt.by_splits(reader, keep)
    if encoding.upper().replace("_", "-") in _UNITS:
        lines = each(_pieces(spark, paths, glob, encoding, limit), keep, F.split("value", r"\r"), "value")
    else:
        lines = _scan(spark, paths, glob, whole=False).filter(F.col("file_size") > limit).withColumn("value", _decoded(F.col("value"), encoding))
    return lines.withColumn("line", fmt.per_line(F.col("value"))).filter(F.col("line").isNotNull()).select(*keep, "line")


def _numbered_lines(spark, paths, glob, fmt: LineFormat, encoding: str, limit: int) -> DataFrame:
    """Lines of large files with file-wide numbers, without sorting a file anywhere."""
    pin_file_splits(spark)
    kept = _split_lines(spark, paths, glob, fmt, encoding, limit).withColumn("_id", F.monotonically_increasing_id())
    if fmt.by_splits:
        # Records were put together over several scans; that is done once, for the counts and for the lines.
        kept = shared_table(kept, "split-records")
    # Lines of one split follow each other in one task, so their ids are consecutive.
    counts = shared_table(kept.groupBy("file_path", "block_start").agg(
        F.count(F.lit(1)).alias("piece_lines"), F.min("_id").alias("_first")
    ), "split-lines")
    # The splits of one huge file do not meet in one window group: they are summed up in stretches.
    stretched = counts.withColumn("_stretch", F.floor(F.col("block_start") / F.lit(STRETCH_BYTES)))
    # One row a split, written before it meets the lines: Spark then knows that it is small, and the
    # text is not shuffled for it.
    offsets = shared_table(nested_offsets(stretched.drop("_first"), ["file_path"], ["block_start", "_stretch"]).join(
        counts, ["file_path", "block_start"]
    ), "split-offsets")
    place = F.col("_id") - F.col("_first")
    checked = F.when(
        (place >= 0) & (place < F.col("piece_lines")), F.col("lines_before") + place
    ).otherwise(F.raise_error(F.lit("file splits changed between the two scans of the input")).cast("long"))
    # Left join: a split without an offset must fail, not vanish.
    return kept.join(offsets, ["file_path", "block_start"], "left").select(
        *FILE_COLS, checked.alias("line_no"), "line", "total_lines"
    )


def _sizes(spark: SparkSession, paths: list[str]) -> dict[str, tuple[int, int]]:
    """Least and greatest file size for each suffix, from a listing that reads no content."""
    suffix = F.lower(F.regexp_extract(F.col("path"), r"(\.[^./]*)$", 1))
    found = spark.read.format("binaryFile").load(paths).groupBy(suffix.alias("s")).agg(F.min("length").alias("lo"), F.max("length").alias("hi"))
    known = found.filter(F.col("s").isin(*BY_SUFFIX)).collect()  # a dozen rows at most
    for row in found.filter(~F.col("s").isin(*BY_SUFFIX)).orderBy("s").limit(1).collect():
        known.append(row)
    return {row.s: (row.lo, row.hi) for row in known}


def _plan(spark, paths, fmt, encoding, whole_file_limit):
    """``(format, glob, whole, limit)`` for each scan needed: whether files are read whole, up to
    the limit if there is one, and whether larger ones are by splits."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    sizes = {} if fmt else _sizes(spark, paths)
    for suffix in sizes:
        format_of("x" + suffix)
    formats = [FORMATS[fmt]] if fmt else list({f.name: f for f in map(BY_SUFFIX.get, sizes)}.values())
    scans = []
    for f in formats:
        own = [sizes[s] for s in f.suffixes if s in sizes]
        small = not own or min(lo for lo, _ in own) <= whole_file_limit
        large = not own or max(hi for _, hi in own) > whole_file_limit
        scans.append((f, None if fmt else _glob(f), small, whole_file_limit if large else None))
    return paths, scans


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], fmt: str | None = None, *,
    encoding: str = "UTF-8", whole_file_limit: int = WHOLE_FILE_LIMIT,
) -> DataFrame:
    """Lines of files: file_path, file_name, file_size, line_no (0-based), line, total_lines.

    ``fmt`` is one of text, csv, tsv, json, ndjson, markup; without it each file's suffix
    decides, and an unknown suffix raises ValueError.  A file above ``whole_file_limit`` gives the same
    lines, read by splits; the small tables that this needs are made when this function is called.
    """
    paths, scans = _plan(spark, paths, fmt, encoding, whole_file_limit)
    parts = []
    for f, glob, small, limit in scans:
        if small:
            whole = _whole_files(spark, paths, glob, f, encoding, limit)
            total = F.size("lines").cast("long").alias("total_lines")
            parts.append(each(whole, [*FILE_COLS, total], "lines", "line", "line_no").select(*FILE_COLS, F.col("line_no").cast("long").alias("line_no"), "line", "total_lines"))
        if limit is not None:
            parts.append(_numbered_lines(spark, paths, glob, f, encoding, limit))
    return _union(parts)


def read_chunks(
    spark: SparkSession, paths: str | Sequence[str], fmt: str | None = None, *,
    encoding: str = "UTF-8", whole_file_limit: int = WHOLE_FILE_LIMIT,
) -> DataFrame:
    """Chunks of files, ready for scoring; see :func:`read_lines` for the arguments."""
    paths, scans = _plan(spark, paths, fmt, encoding, whole_file_limit)
    columns = [*FILE_COLS, "chunk_index", "chunk_text", "chunk_lines", "total_chunks"]
    parts = []
    for f, glob, small, limit in scans:
        if small:
            whole = _whole_files(spark, paths, glob, f, encoding, limit)
            parts.append(explode_chunks(whole, F.col("lines"), FILE_COLS).select(*columns))
        if limit is not None:
            numbered = _numbered_lines(spark, paths, glob, f, encoding, limit)
            parts.append(assemble_chunks(numbered, FILE_COLS).select(*columns))
    return _union(parts)


def line_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Physical lines per file, blank ones included."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        _scan(spark, paths, None, whole=False)
        .groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("n_lines"))
    )


def lines_from_text(spark: SparkSession, text: str, file_name: str = "raw_input.txt") -> DataFrame:
    """Lines of a text typed in by a user."""
    return lines_from_column(
        spark.createDataFrame([(file_name, text)], "file_name string, text string"), "text", ["file_name"]
    )


def lines_from_column(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Stripped, non-blank lines of a text column: ``keep`` columns, line_no, line."""
    return each(df, keep, clean_lines(text_col), "line", "line_no")


def file_list(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Non-empty files with their sizes, from a listing that reads no content."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("binaryFile").load(paths).select(
        F.col("path").alias("file_path"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
        F.col("length").alias("file_size"),
    )

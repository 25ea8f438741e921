"""The line formats: how the text of a file, or one physical line of it, becomes lines."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.functions.structured import delimited_lines, json_line, json_lines
from tonegrain.functions.text import clean_lines, html_sentences, strip
from tonegrain.sources.fragments import Reader, json_by_splits, markup_by_splits
from tonegrain.sources.runs import delimited_by_splits


@dataclass(frozen=True)
class LineFormat:
    """``whole`` maps a file's text to an array of lines.  ``per_line`` maps one physical line to
    its line, or NULL to drop it.  ``by_splits`` reads large files where records may run across
    lines: from a reader of their pieces to the given columns and ``line``."""

    name: str
    suffixes: tuple[str, ...]
    whole: Callable[[Column], Column]
    per_line: Callable[[Column], Column] | None = None
    by_splits: Callable[[Reader, list[str]], DataFrame] | None = None


def _delimited(sep: str, name: str) -> LineFormat:
    return LineFormat(
        name, (f".{name}",), lambda c: delimited_lines(c, sep),
        by_splits=lambda reader, keep: delimited_by_splits(reader, sep, keep))


TEXT = LineFormat(
    "text", (".txt", ".log", ".md", ".text"), clean_lines, lambda c: F.nullif(strip(c), F.lit(""))
)
CSV = _delimited(",", "csv")
TSV = _delimited("\t", "tsv")
JSON = LineFormat("json", (".json",), json_lines, by_splits=json_by_splits)
# Each physical line is a record of its own, whether the file is read whole or by splits.
NDJSON = LineFormat("ndjson", (".ndjson", ".jsonl"), lambda c: F.array_compact(F.transform(F.split(c, r"\r\n|\r|\n"), json_line)), json_line)
MARKUP = LineFormat("markup", (".xml", ".html"), html_sentences, by_splits=markup_by_splits)

FORMATS = {f.name: f for f in (TEXT, CSV, TSV, JSON, NDJSON, MARKUP)}
BY_SUFFIX = {suffix: f for f in FORMATS.values() for suffix in f.suffixes}


def format_of(file_name: str) -> LineFormat:
    """The format for a file name, by its suffix in any case."""
    dot = file_name.rfind(".")
    suffix = file_name[dot:].lower() if dot > 0 else ""
    if suffix not in BY_SUFFIX:
        raise ValueError(
            f"Unsupported file type '{suffix}'. Supported: {', '.join(sorted(BY_SUFFIX))}"
        )
    return BY_SUFFIX[suffix]

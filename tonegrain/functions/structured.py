"""Turn structured text (CSV/TSV records, JSON values) into plain lines, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tonegrain.functions.text import as_column, let, split_lines, strip

# ------------------------------------------------------------------ delimited


def _quoted(sep: str, newlines: str) -> str:
    """A field that opens with a quote: text with doubled quotes, then any rest."""
    return rf'"[^"]*+(?:""[^"]*+)*+(?:"[^{sep}{newlines}]*+|\z)'


def _cell_text(cell: Column) -> Column:
    """Undo the quoting of one cell; a quote that does not open the cell is plain text."""
    opened = r'(?s)\A"([^"]*+(?:""[^"]*+)*+)(?:"(.*)|\z)\z'
    inner = F.replace(F.regexp_extract(cell, opened, 1), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), F.concat(inner, F.regexp_extract(cell, opened, 2))).otherwise(cell)


def _join_cells(cells: Column) -> Column:
    return F.array_join(F.filter(F.transform(cells, strip), lambda c: c != ""), " ")


def _cells(record: Column, sep: str) -> Column:
    s = "\\t" if sep == "\t" else sep
    quoted = F.regexp_extract_all(
        F.concat(F.lit(sep), record), F.lit(rf"{s}(?:{_quoted(s, '')}|[^{s}]*+)"), F.lit(0)
    )
    return F.when(
        record.contains('"'), F.transform(quoted, lambda c: _cell_text(F.substring(c, 2, 2_147_483_647)))
    ).otherwise(F.split(record, s))


def record_to_line(record: Column | str, sep: str = ",") -> Column:
    """One delimited record -> its non-blank cells, stripped, joined by a space.

    Works on the record text, so a row may have any number of cells.
    """
    return _join_cells(_cells(as_column(record), sep))


def open_at_end(text: Column | str, sep: str = ",") -> Column:
    """True when a text that starts between records ends inside a quoted cell."""
    c = as_column(text)
    s = "\\t" if sep == "\t" else sep
    closed = rf'"[^"]*+(?:""[^"]*+)*+"[^{s}\r\n]*+'
    cell = rf'(?:{closed}|[^"{s}\r\n][^{s}\r\n]*+|)'
    return c.contains('"') & c.rlike(rf'\A(?:{cell}[{s}\r\n])*+"[^"]*+(?:""[^"]*+)*+\z')


def delimited_lines(content: Column | str, sep: str = ",") -> Column:
    """All records of a delimited text as lines; a quoted cell may hold line breaks."""
    c = as_column(content)
    s = "\\t" if sep == "\t" else sep
    field = rf"(?:{_quoted(s, chr(92) + 'r' + chr(92) + 'n')}|[^{s}\r\n]*+)"
    records = F.when(
        c.contains('"'),
        F.regexp_extract_all(c, F.lit(rf"({field}(?:{s}{field})*+)(?:\r\n|\r|\n|\z)"), F.lit(1)),
    ).otherwise(split_lines(c))
    return F.filter(F.transform(records, lambda r: record_to_line(r, sep)), lambda x: x != "")


# ----------------------------------------------------------------------- JSON

# A text nobody writes; it closes the wrapped value, so trailing content is noticed.
_SENTINEL = "end"


def _root(text: Column) -> Column:
    """The text parsed as exactly one JSON value, as text, or NULL."""
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_SENTINEL}"]'))

    def value(ends: Column) -> Column:
        whole = (F.size(ends) == 2) & (F.element_at(ends, -1) == _SENTINEL)
        return F.when(whole, F.get(ends, F.lit(0)))

    return let(F.from_json(wrapped, "array<string>"), value)


def is_json_value(text: Column | str) -> Column:
    """True when the whole text is one JSON value."""
    return _root(as_column(text)).isNotNull() | (strip(text) == "null")


def plain_float(text: Column) -> Column:
    """A float in its shortest form: ``1.0E7`` -> ``10000000.0``, ``1.0E-5`` -> ``1e-05``."""
    value = F.abs(text.cast("double"))
    digits = F.rtrim(text.cast("decimal(38,20)").cast("string"), F.lit("0"))
    expanded = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).cast("int")
    sign = F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+"))
    short = F.concat(mantissa, sign, F.format_string("%02d", F.abs(power)))
    exponent = F.when((value >= 1e-4) & (value < 1e16), expanded).otherwise(short)
    return F.when(text.contains("E"), exponent).otherwise(text)


def object_to_line(text: Column | str) -> Column:
    """Values of a JSON object that count as true, as text, in key order, joined by a space.

    Null, false, 0, "", [] and {} are left out; the string "0" is kept.  Nested values
    appear as JSON text.  The result is stripped and may be empty.
    """
    t = as_column(text)
    kinds = F.map_values(F.from_json(t, "map<string,variant>"))
    texts = F.map_values(F.from_json(t, "map<string,string>"))

    def keep(value: Column, kind: Column) -> Column:
        number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        falsy = (
            value.isNull() | (value == "")
            | ((kind == "BOOLEAN") & (value == "false"))
            | (number & (value.cast("double") == 0))
            | (kind.startswith("ARRAY") & (value == "[]"))
            | ((kind == "OBJECT<>") & (value == "{}"))
        )
        shown = (
            F.when(kind == "BOOLEAN", F.lit("True"))
            .when(number & value.rlike("[.E]"), plain_float(value))
            .otherwise(value)
        )
        return F.when(~falsy, shown)

    def joined(values: Column, types: Column) -> Column:
        return F.array_join(F.array_compact(F.zip_with(values, types, keep)), " ")

    return strip(let(
        F.struct(texts.alias("texts"), F.transform(kinds, lambda v: F.schema_of_variant(v)).alias("types")),
        lambda x: joined(x["texts"], x["types"]),
    ))


def _first_char(text: Column) -> Column:
    return F.left(strip(text), F.lit(1))


def json_line(text: Column | str) -> Column:
    """One line of newline-delimited JSON -> its line, or NULL when it gives none.

    A string stands for itself, an object for its values, text that is no JSON stays as it
    is; numbers, arrays and other values give nothing.
    """
    def rule(line: Column) -> Column:
        kind = _first_char(line)
        return (
            F.when(line == "", F.lit(None))
            .when(~is_json_value(line), line)
            .when(kind == '"', _root(line))
            .when(kind == "{", F.nullif(object_to_line(line), F.lit("")))
        )

    return let(strip(text), rule)


def _element_line(value: Column, kind: Column, text: Column) -> Column:
    """The line of one element of a JSON array: strings stripped (empty ones kept), objects as their values."""
    return F.when(kind == "STRING", strip(value)).when(kind.startswith("OBJECT"), F.nullif(object_to_line(text), F.lit("")))


def json_element_line(text: Column | str) -> Column:
    """One element of a JSON array, as JSON text -> its line, or NULL when it gives none."""
    return let(strip(as_column(text)), lambda t: _element_line(
        _root(t), F.when(_first_char(t) == '"', F.lit("STRING")).when(_first_char(t) == "{", F.lit("OBJECT")), t))


def _array_lines(text: Column) -> Column:
    """Lines of a JSON array."""
    texts = F.from_json(text, "array<string>")
    kinds = F.transform(F.from_json(text, "array<variant>"), lambda v: F.schema_of_variant(v))
    return F.array_compact(F.zip_with(texts, kinds, lambda value, kind: _element_line(value, kind, value)))


def json_lines(content: Column | str) -> Column:
    """All lines of a JSON text: array, object, scalar (none), or newline-delimited values."""
    def rule(text: Column) -> Column:
        kind = _first_char(text)
        none = F.array().cast("array<string>")
        one = F.array_compact(F.array(F.nullif(object_to_line(text), F.lit(""))))
        return (
            F.when(is_json_value(text), F.when(kind == "[", _array_lines(text)).when(kind == "{", one).otherwise(none))
            .otherwise(F.array_compact(F.transform(split_lines(text), json_line)))
        )

    return let(F.coalesce(as_column(content), F.lit("")), rule)

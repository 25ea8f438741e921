"""Text helpers with Unicode-aware semantics, as plain Column expressions.

Java's ``\\w``, ``\\s`` and ``\\b`` do not mean what a Unicode text tool means by
them, so the character classes are written out once here and reused.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tonegrain.functions.sql import regex_literal

WORD_CHARS = r"A-Za-z0-9_\p{L}\p{N}"      # the ASCII part first: it is tested first
SPACE_CHARS = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
# The same white space as SPACE_CHARS, one character after the other.
SPACE_LIST = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
TOKEN_PATTERN = rf"[{WORD_CHARS}]++(?:'[{WORD_CHARS}]++)?+"
LINE_BREAK = r"\r\n|\r|\n"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove leading and trailing Unicode white space (``trim`` only removes U+0020)."""
    return F.btrim(as_column(col), F.lit(SPACE_LIST))


def is_blank(col: Column | str) -> Column:
    """True for NULL, empty or white-space-only text."""
    c = as_column(col)
    return c.isNull() | ~c.rlike(rf"[^{SPACE_CHARS}]")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, inside one expression.

    A lambda variable is bound to the value, so ``body`` may refer to it as often
    as it likes and no later projection can duplicate the work.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(col: Column | str) -> Column:
    """Words of the text as written: letters, digits, ``_``, one inner apostrophe part."""
    return F.regexp_extract_all(as_column(col), F.lit(TOKEN_PATTERN), F.lit(0))


def lower_tokens(col: Column | str) -> Column:
    """Lower-cased tokens, one per token of the original text.

    The text is lower-cased as a whole (one pass).  Only U+0130 grows when lower-cased
    and would change token borders, so it is first replaced by another lower-case,
    non-ASCII letter; no lexicon word holds either of them.
    """
    c = as_column(col)
    return tokens(F.lower(F.when(c.contains("İ"), F.translate(c, "İ", "ı")).otherwise(c)))


def words_sql(text: str) -> str:
    """The same as SQL text, NULL counting as empty."""
    plain = f"CASE WHEN contains({text}, 'İ') THEN translate({text}, 'İ', 'ı') ELSE coalesce({text}, '') END"
    return f"regexp_extract_all(lower({plain}), {regex_literal(TOKEN_PATTERN)}, 0)"


def split_lines(col: Column | str) -> Column:
    """Lines of a text value; LF, CRLF and CR all end a line."""
    return F.split(as_column(col), LINE_BREAK)


def clean_lines(col: Column | str) -> Column:
    """Stripped, non-blank lines of a text value, in order.

    A break swallows the white space on both sides, other breaks included, so lines come
    out stripped and blank ones never appear.
    """
    breaks = rf"[{SPACE_CHARS}&&[^\r\n]]*+[\r\n][{SPACE_CHARS}]*+"
    return F.filter(F.split(strip(col), breaks), lambda x: x != "")


def fold_ascii(col: Column | str) -> Column:
    """Lower-case ASCII letters only."""
    return F.translate(as_column(col), _UPPER, _LOWER)


def html_sentences(col: Column | str, min_chars: int = 11) -> Column:
    """Sentences of a markup text: tags out, white space collapsed, split after ``.!?``."""
    text = F.regexp_replace(as_column(col), "<[^>]+>", " ")
    text = F.regexp_replace(text, rf"[{SPACE_CHARS}]+", " ")
    pieces = F.transform(F.split(text, r"(?<=[.!?]) "), strip)
    return F.filter(pieces, lambda x: F.length(x) >= min_chars)


def join_non_blank(cells: list[Column | str]) -> Column:
    """One line out of a row: cells as text, stripped, blanks dropped, joined by a space."""
    return F.concat_ws(" ", *[F.nullif(strip(as_column(c).cast("string")), F.lit("")) for c in cells])


def join_cells(cells: list[Column | str]) -> Column:
    """One line out of a sheet row: NULL cells dropped, empty cells kept, result stripped."""
    return strip(F.concat_ws(" ", *[as_column(c).cast("string") for c in cells]))


def highlight(col: Column | str, keyword: str) -> Column:
    """HTML-escape the text, then mark every case-insensitive hit of the keyword."""
    text = F.coalesce(as_column(col), F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    if not keyword:
        return text
    quoted = "(" + "".join("\\" + c if c in r"\.^$|?*+()[]{}-&" else c for c in keyword) + ")"
    return F.regexp_replace(text, "(?iu)" + quoted, '<mark class="highlight">$1</mark>')


def physical_lines(text: Column | str) -> Column:
    """Lines of a text as a file counts them, blank ones included; a last line break ends no further line."""
    t = as_column(text)
    return F.size(split_lines(t)) - F.when(t.rlike(r"[\r\n]\z"), 1).otherwise(0)

"""Entity patterns and domain tags of a text, as array Columns.

Only existence matters, so each pattern is written in its shortest form that is
found in exactly the same texts.  Word borders are spelled as look-arounds over the
Unicode word class, and each costly pattern sits behind a byte search for a
character it cannot do without.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tonegrain.functions.sql import let, name, regex_literal, text_literal
from tonegrain.functions.text import SPACE_CHARS, WORD_CHARS, words_sql
from tonegrain.lexicon import DEFAULT_LEXICON, PATTERNS, Lexicon

# Letters that match A-Z or a-z when case is ignored by Unicode rules.
_ASCII_LETTERS = "A-Za-zİıſK"
_BORDER = rf"(?:(?<=[{WORD_CHARS}])(?![{WORD_CHARS}])|(?<![{WORD_CHARS}])(?=[{WORD_CHARS}]))"
_STARTS = rf"(?<![{WORD_CHARS}])"
_ENDS = rf"(?![{WORD_CHARS}])"
_DIGIT = r"\p{Nd}"
# A digit that begins a word.  The digit comes first so that the scan skips quickly.
_FIRST_DIGIT = rf"{_DIGIT}(?<![{WORD_CHARS}]{_DIGIT})"

_EMAIL = (
    rf"{_BORDER}[{_ASCII_LETTERS}0-9._%+\-]+@[{_ASCII_LETTERS}0-9.\-]+\.[{_ASCII_LETTERS}]{{2,}}{_ENDS}"
)
_URL = rf"[hH][tT][tT][pP][sSſ]?://[^{SPACE_CHARS}]"
_PHONE = rf"{_FIRST_DIGIT}[{_DIGIT}\-{SPACE_CHARS}().]{{7,14}}{_DIGIT}{_ENDS}"
_DATE = rf"{_FIRST_DIGIT}{_DIGIT}?[/-]{_DIGIT}{{1,2}}[/-]{_DIGIT}{{2,4}}{_ENDS}"
_DOLLARS = rf"\$[{_DIGIT},]"
_CURRENCY_CODE = (
    rf"{_FIRST_DIGIT}{_DIGIT}*(?:\.{_DIGIT}{{2}})?[{SPACE_CHARS}]*"
    r"(?:[uU][sSſ][dD]|[eE][uU][rR]|[gG][bB][pP]|[iIİı][nN][rR])" + _ENDS
)
_PERCENT = rf"{_FIRST_DIGIT}{_DIGIT}*%"
_NUMBER = rf"{_FIRST_DIGIT}{_DIGIT}*{_ENDS}"
_ANY_WORD = rf"{_STARTS}[{_ASCII_LETTERS}]{{2,}}{_ENDS}"
_CAPS_WORD = rf"{_STARTS}[A-Z]{{2,}}{_ENDS}"


_LETTERS_ONLY = re.compile("[a-z]+").fullmatch


def pattern_tests(text_col: str, lexicon: Lexicon = DEFAULT_LEXICON, *, strict_caps: bool = False) -> dict[str, str]:
    """One SQL test per pattern of the lexicon, in its order.

    A fixed pattern has a fast form here; any other is searched as it is, whatever the case.
    """
    t = name(text_col)

    def has(*chars: str) -> str:
        return "(" + " OR ".join(f"contains({t}, {text_literal(c)})" for c in chars) + ")"

    def found(pattern: str) -> str:
        return f"rlike({t}, {regex_literal(pattern)})"

    tests = {
        "email": f"{has('@')} AND {found(_EMAIL)}",
        "url": f"{has('://')} AND {found(_URL)}",
        "phone": found(_PHONE),
        "date": f"{has('/', '-')} AND {found(_DATE)}",
        "currency": f"({has('$')} AND {found(_DOLLARS)}) OR {found(_CURRENCY_CODE)}",
        "percentage": f"{has('%')} AND {found(_PERCENT)}",
        "hashtag": f"{has('#')} AND {found(f'#[{WORD_CHARS}]')}",
        "mention": f"{has('@')} AND {found(f'@[{WORD_CHARS}]')}",
        "number": found(_NUMBER),
        "question": has("?"),
        "exclamation": has("!"),
        # Case is ignored for every pattern, this one included, so it finds any word
        # of two or more ASCII letters; strict_caps asks for real capitals.
        "all_caps_word": found(_CAPS_WORD if strict_caps else _ANY_WORD),
    }
    return {
        key: tests[key] if PATTERNS.get(key) == pattern else found(f"(?iuU){pattern}")
        for key, pattern in lexicon.patterns.items()
    }


def _names_found(tests: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {test} THEN {text_literal(key)} END" for key, test in tests.items())
    return f"array_compact(array({cases}))" if tests else "cast(array() AS array<string>)"


def _unless_blank(text_col: str, value: str) -> Column:
    blank = f"{name(text_col)} IS NULL OR NOT rlike({name(text_col)}, {regex_literal(f'[^{SPACE_CHARS}]')})"
    return F.expr(f"CASE WHEN {blank} THEN cast(array() AS array<string>) ELSE {value} END")


def pattern_matches(text_col: str, lexicon: Lexicon = DEFAULT_LEXICON, *, strict_caps: bool = False) -> Column:
    """Names of the patterns found in the text, in the lexicon's order; [] for blank text."""
    return _unless_blank(text_col, _names_found(pattern_tests(text_col, lexicon, strict_caps=strict_caps)))


def _shortest(keywords: tuple[str, ...]) -> list[str]:
    """Drop keywords that contain another one: a substring test on that one finds them too."""
    return [k for k in keywords if not any(o != k and o in k for o in keywords)]


def tags(
    text_col: str, lexicon: Lexicon = DEFAULT_LEXICON, *, whole_word: bool = False, words_col: str | None = None,
) -> Column:
    """Domains with a keyword in the lower-cased text; substrings count unless ``whole_word``.

    A keyword of plain letters lies within one token, so the distinct tokens, joined, stand
    for the text: they are shorter, and ``words_col`` may name tokens that exist already.
    """
    text = name(text_col)

    def whole(keywords: tuple[str, ...]) -> str:
        return f"rlike(lowered, {regex_literal(_STARTS + '(?:' + '|'.join(keywords) + ')' + _ENDS)})"

    def inside(keyword: str) -> str:
        if _LETTERS_ONLY(keyword):
            return f"contains(words, {text_literal(keyword)})"
        # The text itself is looked at only when all parts of the keyword are there.
        parts = [p for p in re.split("[^a-z]+", keyword) if p]
        return " AND ".join([*(f"contains(words, {text_literal(p)})" for p in parts),
                             f"contains(lower({text}), {text_literal(keyword)})"])

    if whole_word:
        found = _names_found({domain: whole(keywords) for domain, keywords in lexicon.domains.items()})
        return _unless_blank(text_col, let("lowered", f"lower({text})", found))
    # Short keywords are the likely ones; a domain that is found is not looked for any further.
    found = _names_found({
        domain: " OR ".join(f"({inside(k)})" for k in sorted(_shortest(keywords), key=len)) for domain, keywords in lexicon.domains.items()
    })
    tokens = name(words_col) if words_col else words_sql(text)
    # Tokens spell U+0130 differently from plain lower-casing; such a text stands for itself.
    words = f"CASE WHEN contains({text}, 'İ') THEN lower({text}) ELSE array_join(array_distinct({tokens}), ' ') END"
    return _unless_blank(text_col, let("words", words, found))

"""Small helpers to write expressions as SQL text.

The scorer looks hundreds of words up.  As SQL text the whole expression reaches the
JVM in one call; built literal by literal it would take seconds of driver time per query.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def regex_literal(pattern: str) -> str:
    """A regular expression as a raw literal; quotes are spelled by their code."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def name(column: str) -> str:
    """A column name, quoted; nested fields keep their dots."""
    return ".".join(f"`{part}`" for part in column.replace("`", "").split("."))


def is_in(value: str, words: Iterable[str]) -> str:
    """Membership test; more than ten words become a hash set in the plan."""
    listed = ", ".join(text_literal(w) for w in sorted(words))
    return f"({value} IN ({listed}))" if listed else "false"


def weight_of(value: str, weights: dict[str, float], otherwise: str = "0D") -> str:
    """Look a word up: one set per distinct weight, behind one test for all of them."""
    by_weight: dict[float, list[str]] = defaultdict(list)
    for word, weight in weights.items():
        by_weight[weight].append(word)
    if not by_weight:
        return otherwise
    cases = " ".join(f"WHEN {is_in(value, words)} THEN {weight!r}D" for weight, words in sorted(by_weight.items()))
    return f"(CASE WHEN NOT {is_in(value, weights)} THEN {otherwise} {cases} ELSE {otherwise} END)"


def let(variable: str, value: str, body: str) -> str:
    """Evaluate ``value`` once, under a name that ``body`` may use as often as it likes."""
    return f"element_at(transform(array({value}), {variable} -> {body}), 1)"

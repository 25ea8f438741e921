"""Quality rules: text statistics, and decision lists learned from labelled texts.

Sequential covering: a rule grows on one part of the labelled rows by adding the threshold
with the best information gain, is pruned on the other part, and takes the rows it covers with
it; then the next rule grows on the rest.  Rules are conjunctions of thresholds; the list
becomes one ordered conditional expression in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.llm.common import hashed_words, pieces, texts_of, windows

#: Labelled rows that a list is learned from, at most: those whose doc_id hashes lowest.
MOST_LABELLED = 20_000
WINDOW_WORDS = 3
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")

#: What rules look at: ratios, so that a rule means the same for long and short texts.
FEATURES = {
    "chars_per_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"), "marks_per_word": ("n_marks", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


# -------------------------------------------------------------------- statistics
def _counts(joined: np.ndarray, table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(table[joined])))
    return np.diff(sums[marks])


def _table(characters: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=np.int64)
    found[np.frombuffer(characters, dtype=np.uint8)] = 1
    return found


def _repeated_words(hashes: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur twice or more."""
    if len(hashes) < 2:
        return 0
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    covered = np.zeros(n_words, dtype=bool)
    hit = np.flatnonzero(np.isin(hashes, twice))
    for k in range(WINDOW_WORDS):
        covered[hit + k] = True
    return int(covered.sum())


def text_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, ``STATS``) of each row; null and empty texts have zeros.

    Words are runs of characters other than space and 0x09-0x0D; n_lines and n_dup_lines count
    lines (ended by ``\\n``) with a word, and those equal to an earlier one; n_upper A-Z and
    n_marks ``!`` and ``?``.  Repeated rows, null ids and other columns do not matter.
    """
    words_in = 1 - _table(b" \t\n\x0b\x0c\r")
    words_in[0x80:0xC0] = 0  # bytes that go on with a character
    tables = (words_in, _table(SYMBOLS), _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table(b"!?"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = texts_of(piece.column("text"))
                marks = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64))).astype(np.int64)
                joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
                chars, symbols, upper, points = (_counts(joined, t, marks) for t in tables)
                words, first = hashed_words(texts, lower=False)
                runs, at = windows(words, first, WINDOW_WORDS)
                n_words = np.diff(first)
                repeated = [_repeated_words(runs[a:b], n) for a, b, n in zip(at[:-1].tolist(), at[1:].tolist(), n_words.tolist())]
                lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
                found = {
                    "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": [len(x) - len(set(x)) for x in lines],
                    "n_repeat_words": repeated, "n_lines": [len(x) for x in lines], "n_upper": upper, "n_marks": points}
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), *[pa.array(found[c], pa.int64()) for c in STATS]], ["doc_id", *STATS])

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, ", ".join(["doc_id long", *[f"{c} long" for c in STATS]]))


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        name: F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0) for name, (above, below) in FEATURES.items()})


# ---------------------------------------------------------------------- learning
@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def covers(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] >= self.threshold if self.at_least else values[self.feature] <= self.threshold

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.at_least else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    covered = np.ones(len(next(iter(values.values()))), dtype=bool)
    for condition in rule:
        covered &= condition.covers(values)
    return covered


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, most_conditions: int) -> Rule:
    """Add the condition with the best gain until the rule covers no good row or nothing helps."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < most_conditions and inside.any() and not bad[inside].all():
        p0, best, gain = bad[inside].sum(), None, 1e-9
        before = np.log2(p0 / inside.sum()) if p0 else -np.inf
        for feature, column in values.items():
            v, b = column[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1  # a threshold stands between two different values
            if not len(cut):
                continue
            below = np.cumsum(b)[cut - 1]
            for at_least, p, n in ((True, b.sum() - below, len(v) - cut), (False, below, cut)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(p > 0, p * (np.log2(p / n) - before), 0.0)
                k = int(gains.argmax())
                if gains[k] > gain:
                    gain, best = gains[k], Condition(feature, at_least, float((v[cut[k]] + v[cut[k] - 1]) / 2))
        if best is None:
            break
        rule.append(best)
        inside &= best.covers(values)
    return tuple(rule)


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The prefix of the rule that judges the other rows best, its precision and its cover."""
    best = ((), -2.0, 0.0, 0)
    for k in range(len(rule), 0, -1):
        covered = _covered(rule[:k], values)
        n, p = int(covered.sum()), int(bad[covered].sum())
        worth = (2 * p - n) / n if n else -1.0
        if worth >= best[1]:
            best = (rule[:k], worth, p / n if n else 0.0, n)
    return best[0], best[2], best[3]


def learn_list(
    values: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, least_cover: int = 3,
    most_rules: int = 16, most_conditions: int = 4, seed: int = 0,
) -> list[Rule]:
    """Rules that mark bad rows, each at least so precise on the rows that it did not grow on."""
    grows = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left, rules = np.ones(len(bad), dtype=bool), []
    while len(rules) < most_rules and bad[left & grows].any():
        pick = lambda mask: ({f: v[mask] for f, v in values.items()}, bad[mask])
        grown = _grow(*pick(left & grows), most_conditions)
        rule, share, cover = _prune(grown, *pick(left & ~grows))
        if not rule or share < precision or cover < least_cover:
            break
        rules.append(rule)
        left &= ~_covered(rule, values)
    return rules


def kept_by(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: false for the first rule that holds, else true."""
    out: Column | None = None
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, **options) -> list[Rule]:
    """Rules from rows of ``labels`` (doc_id, quality) and their texts; rows that fail the base rules teach nothing.

    Labels of null id or quality are left out, as are ids whose labels differ.  At most ``most``
    labelled ids are used, those of the lowest hash.  Of several rows of one id, the one of the
    smallest statistics teaches, so that no more rows than ids reach the driver.  Null, empty and very
    long texts have statistics like others; most of the former fail the base rules.  Empty tables, and labels
    of one kind only, give no rule.  Other columns are not looked at.
    """
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    some = one.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    known = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # ``most`` rows of two numbers
    rows = with_features(text_stats(known)).where(~base_failed()).join(F.broadcast(some), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("quality", *FEATURES)).alias("row")).select("doc_id", "row.*")
    found = rows.toPandas().sort_values(["doc_id", "quality", *FEATURES])
    return learn_list({f: found[f].to_numpy(dtype=float) for f in FEATURES}, (found["quality"] == 0).to_numpy(), **options)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, ``STATS``, ``FEATURES``, base_failed, kept) of each row.

    A null or empty text has no words, so it fails the base rules.  Texts of any length are read whole;
    repeated rows are judged alike, each by itself; an empty table gives no rows; without rules what passes the
    base rules is kept.  Columns other than doc_id and text do not come through.
    """
    rated = with_features(text_stats(docs)).withColumn("base_failed", base_failed())
    return rated.withColumn("kept", ~F.col("base_failed") & kept_by(rules))

"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram binds the vectors of its
letters, permuted by their place; a text bundles (adds up) its trigrams; a language bundles
the texts it was learned from.  A text has the language of the highest cosine.

Cosines of unrelated vectors are noise of 1 / sqrt(dimensions), and the best of several is mostly
above 0.  A clean text of a word or two may be no higher, so what tells an unlearned script
from a short text are the letters themselves: learning counts them too.

Vectors follow from the seed and the letter alone, so tasks share nothing but the seed.
Bundles are whole numbers: their sums do not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.llm.common import pieces, released

DIMENSIONS = 1024
#: A language's bundle is collected to the driver, so there must not be many.
MOST_LANGUAGES = 2_000
UNKNOWN = "und"
#: Texts whose counts are held at once, a row of trigrams each.
ROWS = 256
#: Letters that are looked at at once, and different trigrams whose vectors are held at once.
BLOCK_LETTERS, BLOCK_GRAMS = 1 << 19, 1 << 11
#: A cosine of so many times 1 / sqrt(dimensions) is no noise.
NOISE = 6
#: A letter is known if a language has it this often among its letters; strays are not.
LEAST_SHARE = 1e-4
_EDGE = 0


class Encoder:
    """Bundles of texts; letters get their vectors when they first occur."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 0):
        self.dimensions, self.seed = dimensions, seed
        self.vectors: dict[int, np.ndarray] = {}

    def _vector(self, letter: int) -> np.ndarray:
        if letter not in self.vectors:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, letter])).integers(0, 2, self.dimensions, dtype=np.int8)
            self.vectors[letter] = bits * np.int8(2) - np.int8(1)
        return self.vectors[letter]

    def _tallied(self, segments: list[tuple[int, str, bool, bool]], rows: int, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Add the trigrams of (row, text, whether its first and its last letter are neighbours only) to the rows of
        ``out``; returns the middle letter and the row of each trigram.

        A trigram is a lower-case letter between its neighbours; what is not a letter is an edge.
        """
        codes = np.frombuffer(("\0" + "\0".join(t for _, t, _, _ in segments) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(t) + 1 for _, t, _, _ in segments])
        present = np.flatnonzero(np.bincount(codes))
        lower = {int(c): ord(chr(c).lower()[0]) for c in present if chr(c).isalpha()}
        alphabet = np.array([_EDGE, *sorted(set(lower.values()))], dtype=np.int64)
        index = np.zeros(int(present[-1]) + 1, dtype=np.int64)
        for code, low in lower.items():
            index[code] = np.searchsorted(alphabet, low)
        letters = index[codes]
        counted = letters > 0
        for end, (_, text, first, last) in zip(ends.tolist(), segments):
            if first:
                counted[end - len(text)] = False
            if last:
                counted[end - 1] = False
        middle = np.flatnonzero(counted)
        owner = np.array([row for row, _, _, _ in segments])[np.searchsorted(ends + 1, middle, side="right")]
        k = len(alphabet)
        key = (letters[middle - 1] * k + letters[middle]) * k + letters[middle + 1]
        if k ** 3 <= 1 << 23:
            seen = np.bincount(key, minlength=1) > 0
            keys, gram = np.flatnonzero(seen), (np.cumsum(seen) - 1)[key]
        else:
            keys, gram = np.unique(key, return_inverse=True)
        # A block of trigrams at a time: however many different ones a script has, few are held as vectors.
        order = np.argsort(gram.astype(np.uint16 if len(keys) <= 1 << 16 else np.uint32), kind="stable")
        cuts = np.searchsorted(gram, np.arange(0, len(keys) + BLOCK_GRAMS, BLOCK_GRAMS), sorter=order)
        table = np.stack([self._vector(int(a)) for a in alphabet])
        for block, (start, end) in enumerate(zip(cuts, cuts[1:])):
            own = keys[block * BLOCK_GRAMS:(block + 1) * BLOCK_GRAMS]
            some = order[start:end]
            counts = np.bincount(owner[some] * len(own) + gram[some] - block * BLOCK_GRAMS, minlength=rows * len(own)).reshape(rows, len(own))
            bound = np.roll(table[own // (k * k)], 2, axis=1) * np.roll(table[own // k % k], 1, axis=1) * table[own % k]
            out += counts.astype(np.float32) @ bound.astype(np.float32)  # whole numbers below 2**24, so exact
        return alphabet[letters[middle]], owner

    def tally(self, texts: list[str], group: np.ndarray | None = None, n_groups: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bundle of each text or group of texts (group -1: of none), and (row, letter, how often) of their letters.

        Texts are looked at ``BLOCK_LETTERS`` at a time; a longer one is cut, with its neighbours beside each part.
        """
        rows = n_groups if group is not None else len(texts)
        out = np.zeros((rows, self.dimensions))
        triples = [np.zeros((0, 3), dtype=np.int64)]
        held: list[tuple[int, str, bool, bool]] = []

        def done() -> None:
            if held:
                letter, owner = self._tallied(held, rows, out)
                pair, n = np.unique(owner * (1 << 21) + letter, return_counts=True)
                triples.append(np.stack([pair >> 21, pair & ((1 << 21) - 1), n], axis=1))
                held.clear()

        size = 0
        for i, text in enumerate(texts):
            row = i if group is None else int(group[i])
            for at in range(0, len(text) if row >= 0 else 0, BLOCK_LETTERS):
                part = text[max(at - 1, 0):at + BLOCK_LETTERS + 1]
                if size + len(part) > BLOCK_LETTERS:
                    done()
                    size = 0
                held.append((row, part, at > 0, at + BLOCK_LETTERS < len(text)))
                size += len(part)
        done()
        return out, *np.concatenate(triples).T

    def bundles(self, texts: list[str], group: np.ndarray | None = None, n_groups: int = 0) -> np.ndarray:
        """The bundle of each text, or of each group of texts (group -1: of none)."""
        if group is None and len(texts) > ROWS:
            return np.concatenate([self.bundles(texts[k:k + ROWS]) for k in range(0, len(texts), ROWS)])
        return self.tally(texts, group, n_groups)[0]


def learn(docs: DataFrame, may_learn: Column, dimensions: int = DIMENSIONS, seed: int = 0) -> dict[str, np.ndarray]:
    """The bundle of each language, of all rows with ``may_learn``, a lang and a text."""
    return learn_letters(docs, may_learn, dimensions, seed)[0]


def learn_letters(docs: DataFrame, may_learn: Column, dimensions: int = DIMENSIONS, seed: int = 0) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The bundle of each language as ``learn``, and the sorted letters that are at least ``LEAST_SHARE`` of one.

    Each task adds up a bundle and letter counts for each language; these meet in two steps, by
    language and task and then by language, so a language that most rows have is no burden on
    one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums, letters = Encoder(dimensions, seed), {}, {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                langs = piece.column("lang").to_pylist()
                names = sorted(set(langs))
                at = {name: i for i, name in enumerate(names)}
                bundles, *found = encoder.tally(piece.column("text").to_pylist(), np.array([at[x] for x in langs]), len(names))
                for name, bundle in zip(names, bundles):
                    sums[name] = sums.get(name, 0) + bundle.astype(np.int64)
                    letters.setdefault(name, {})
                for row, letter, n in zip(*(x.tolist() for x in found)):
                    held = letters[names[row]]
                    held[letter] = held.get(letter, 0) + n
        packed = [np.array(sorted(letters[name].items()), dtype=np.int64).tobytes() for name in sums]
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.string()), pa.array([s.tobytes() for s in sums.values()], pa.binary()), pa.array(packed, pa.binary()),
        ], ["lang", "bundle", "letters"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, dtype=np.int64) for b in rows["bundle"])
        pairs = np.concatenate([_pairs(x) for x in rows["letters"]])
        different, place = np.unique(pairs[:, 0], return_inverse=True)
        held = np.zeros(len(different), dtype=np.int64)
        np.add.at(held, place, pairs[:, 1])
        return pd.DataFrame({
            "lang": [rows["lang"].iloc[0]], "bundle": [total.tobytes()], "letters": [np.stack([different, held], axis=1).tobytes()]})

    schema = "lang string, bundle binary, letters binary"
    usable = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = usable.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(lambda batches: released(run(batches)), schema)
    for keys in ([F.col("lang"), F.pmod(F.spark_partition_id(), F.lit(64))], [F.col("lang")]):
        parts = parts.groupBy(*keys).applyInPandas(add, schema)
    rows = parts.limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    known: set[int] = set()
    for r in rows:
        pairs = _pairs(bytes(r["letters"]))
        known.update(pairs[pairs[:, 1] >= LEAST_SHARE * pairs[:, 1].sum(), 0].tolist())
    bundles = {r["lang"]: np.frombuffer(bytes(r["bundle"]), dtype=np.int64) for r in sorted(rows, key=lambda r: r["lang"])}
    return bundles, np.array(sorted(known), dtype=np.int64)


def _pairs(packed: bytes) -> np.ndarray:
    """Rows of (letter, count)."""
    return np.frombuffer(packed, dtype=np.int64).reshape(-1, 2)


class Judge:
    """Languages and scores of texts; small enough to be broadcast (``MOST_LANGUAGES`` rows of ``dimensions``)."""

    def __init__(self, bundles: dict[str, np.ndarray], dimensions: int, seed: int, letters: np.ndarray | None = None):
        self.letters, self.names, self.dimensions, self.seed = letters, list(bundles), dimensions, seed
        norms = [np.linalg.norm(b.astype(float)) or 1.0 for b in bundles.values()]
        self.profiles = np.stack([b / n for b, n in zip(bundles.values(), norms)]).astype(np.float32) if bundles else None

    def __call__(self, encoder: Encoder, texts: list[str]) -> tuple[list[str], np.ndarray]:
        return self.rated(texts, encoder.bundles(texts) if self.names else None)

    def alike(self, encoder: Encoder, texts: list[str], min_score: float) -> list[bool]:
        """Whether a text has a language by a score above ``min_score``, or by known letters, half of its letters or more."""
        out: list[bool] = []
        for k in range(0, len(texts) if self.names else 0, ROWS):
            some = texts[k:k + ROWS]
            bundles, row, letter, n = encoder.tally(some)
            langs, scores = self.rated(some, bundles)
            total = np.bincount(row, weights=n, minlength=len(some))
            known = np.bincount(row, weights=n * np.isin(letter, self.letters), minlength=len(some))
            out += [x != UNKNOWN and bool(y) for x, y in zip(langs, (scores > min_score) | (2 * known >= total))]
        return out or [False] * len(texts)

    def rated(self, texts: list[str], found: np.ndarray | None) -> tuple[list[str], np.ndarray]:
        if found is None:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        length = np.linalg.norm(found, axis=1)
        cosines = (found @ self.profiles.T) / np.maximum(length, 1e-9)[:, None]
        best = cosines.argmax(axis=1)
        langs = [self.names[b] if n > 0 else UNKNOWN for b, n in zip(best.tolist(), length.tolist())]
        return langs, np.where(length > 0, np.clip(cosines.max(axis=1), 0, 1), 0.0).astype(float)


def predict(docs: DataFrame, bundles: dict[str, np.ndarray], dimensions: int = DIMENSIONS, seed: int = 0) -> DataFrame:
    """(doc_id, lang_pred, score) of each row, from its whole text alone; the score is the cosine, at least 0."""
    shared = docs.sparkSession.sparkContext.broadcast(Judge(bundles, dimensions, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dimensions, seed)
        for batch in batches:
            for piece in pieces(batch, "text"):
                langs, scores = shared.value(encoder, [t or "" for t in piece.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(langs), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: released(run(batches)), "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text; those of a null id too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(True))


def identify(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs`` (doc_id, text, lang, ...).

    Learned from the rows that are not held out; ``und`` with score 0 where the text is null or
    has no letter, or where no row could be learned from.  Ties go to the language that sorts
    first.  Repeated rows are judged alike; an empty table gives an empty result.  Texts of any
    length are read whole, a block at a time; other columns are not looked at.
    """
    bundles = learn(docs, ~held_out(), dimensions, seed)
    found = predict(docs, bundles, dimensions, seed)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, min_score: float | None = None, dimensions: int = DIMENSIONS, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` whose text has a language, all columns kept.

    It has one if its score is above ``min_score`` (``NOISE`` / sqrt(``dimensions``) if not given),
    or if half of its letters or more are known from the learned languages, however short it is.
    Texts without a letter go, and those in letters that nothing was learned from.  An unlearned
    language in a learned script stays.  Rows are judged where they are: nothing is shuffled.
    Null and empty texts go; repeated rows fare alike, columns of any name come through, null or
    not, and an empty table, or one that nothing can be learned from, gives no rows.
    """
    least = NOISE / dimensions ** 0.5 if min_score is None else min_score
    bundles, letters = learn_letters(docs, ~held_out(), dimensions, seed)
    shared = docs.sparkSession.sparkContext.broadcast(Judge(bundles, dimensions, seed, letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dimensions, seed)
        for batch in batches:
            for piece in pieces(batch, "text"):
                kept = shared.value.alike(encoder, [t or "" for t in piece.column("text").to_pylist()], least)
                yield piece.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(lambda batches: released(run(batches)), docs.schema)

"""Phrase collocations by stripes: each prefix keys an associative counter of the words that follow it.

A level of stripes is one pass over the texts.  A task keeps the stripes of the words it reads,
packed as arrays (prefixes, how many words follow each, these words, their counts), and sends them
by prefix; equal prefixes are merged elementwise, counter by counter.  What a merged stripe
holds often enough are the extensions of its prefix by one word: the phrases of this
level, which are the prefixes of the next one.  An extended phrase also tells the phrases it
was made of how often the longest stretch around them occurs (subsumption maxima).

A phrase of k words can only occur often if its first and its last k - 1 words do, so a task
passes over all others.  It learns them from a Bloom filter of bounded size; a phrase that
slips through is counted and falls out after the merge.  A prefix with more than a part's share of
all occurrences is spread over all parts by the word that follows.

Words, and phrases, are named by 64-bit hashes that hold the language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tonegrain.llm.bitset import filter_of, has
from tonegrain.llm.common import mix64, pieces, texts_of, word_spans, written

LONGEST, LEAST = 5, 100
#: Occurrences that a part of a level gets, and that a task gathers before it packs them.
PART_ENTRIES, FLUSH_ENTRIES = 1 << 20, 2 << 20
#: A prefix with this many occurrences is spread by the word that follows.
HOT_ENTRIES = PART_ENTRIES // 8
#: Ways that rank a language's phrases before they meet.
RANK_WAYS = 64

_U = np.uint64
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True


# -------------------------------------------------------------------- naming
def _language(name: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The name of the phrase of each prefix and the word behind it."""
    with np.errstate(over="ignore"):
        return mix64(prefix * _U(0x9E3779B97F4A7C15) + word)


def _named_words(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, names, starts and ends of all words, the text of each and the piece of text it is in."""
    joined, hashes, starts, ends, marks = word_spans(texts_of(piece.column(0)), True, _APART)
    text = np.repeat(np.arange(len(marks) - 1), np.diff(marks))
    seeds = {lang: _language(lang) for lang in set(piece.column(1).to_pylist())}
    seed = np.array([seeds[lang] for lang in piece.column(1).to_pylist()], dtype=_U)
    within = text + np.searchsorted(np.flatnonzero(_BREAK[joined]), starts)  # grows with either
    return joined, mix64(hashes ^ seed[text]), starts, ends, text, within


# --------------------------------------------------------------------- words
def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of all words of (text, lang)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                joined, names, starts, ends, text, _ = _named_words(piece)
                _, first, n = np.unique(names, return_index=True, return_counts=True)
                whole = joined.tobytes()
                words = [whole[s:e].lower() for s, e in zip(starts[first].tolist(), ends[first].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(1).take(pa.array(text[first])), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)], names=["lang", "word", "n"])

    return docs.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _frequent_words(words: DataFrame, least: int) -> DataFrame:
    """The phrases of one word: lang, phrase, id, n, prefix (null), firsts and rests (empty)."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = word_spans(texts_of(batch.column("phrase")), False, np.zeros(256, dtype=bool) | _APART)[1]
            seed = np.array([_language(x) for x in batch.column("lang").to_pylist()], dtype=_U)
            ids = pa.array(mix64(hashes ^ seed).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=["lang", "phrase", "n", "id"])

    named = words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), "n").mapInArrow(name, "lang string, phrase string, n long, id long")
    none = F.array().cast("array<bigint>")
    return named.select("lang", "phrase", "id", "n", F.lit(None).cast("bigint").alias("prefix"), none.alias("firsts"), none.alias("rests"))


# ------------------------------------------------------------------- stripes
_PACKED = "part int, prefixes binary, sizes binary, words binary, counts binary"


def _packed(prefix: np.ndarray, word: np.ndarray, parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The stripes of all occurrences, a row for each part."""
    if not len(prefix):
        return
    _, first, n = np.unique(extended(prefix, word), return_index=True, return_counts=True)
    prefix, word = prefix[first], word[first]
    part = np.where(has(hot, prefix), word, prefix) % _U(parts)
    order = np.lexsort((prefix, part))
    prefix, word, n, part = prefix[order], word[order], n[order].astype(np.uint32), part[order]
    new = np.ones(len(prefix), dtype=bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])
    stripe = np.flatnonzero(new)
    sizes = np.diff(np.append(stripe, len(prefix))).astype(np.uint32)
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    ends = np.append(cut[1:], len(part))
    s_cut, s_end = np.searchsorted(stripe, cut), np.searchsorted(stripe, ends)
    binary = lambda arrays: pa.array([a.tobytes() for a in arrays], pa.binary())
    yield pa.RecordBatch.from_arrays([
        pa.array(part[cut].astype(np.int32)),
        binary(prefix[stripe[a:b]] for a, b in zip(s_cut, s_end)), binary(sizes[a:b] for a, b in zip(s_cut, s_end)),
        binary(word[a:b] for a, b in zip(cut, ends)), binary(n[a:b] for a, b in zip(cut, ends)),
    ], names=["part", "prefixes", "sizes", "words", "counts"])


def _merged(least: int):
    """Stripes of one part, merged elementwise; what occurs ``least`` times stays."""
    def merge(table: pa.Table) -> pa.Table:
        join = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])
        prefix = np.repeat(join("prefixes", _U), join("sizes", np.uint32))
        word, n = join("words", _U), join("counts", np.uint32).astype(np.int64)
        _, first, which = np.unique(extended(prefix, word), return_index=True, return_inverse=True)
        total = np.bincount(which, weights=n, minlength=len(first)).astype(np.int64)  # exact below 2**53
        often = total >= least
        first = first[often]
        return pa.table({"prefix": prefix[first].view(np.int64), "word": word[first].view(np.int64), "n": total[often]})

    return merge


def stripes(docs: DataFrame, size: int, shorter: np.ndarray, hot: np.ndarray, parts: int, least: int) -> DataFrame:
    """prefix, word, n: the phrases of ``size`` words that occur ``least`` times in (text, lang).

    ``shorter`` is the filter of the frequent phrases of one word less, ``hot`` of the prefixes to spread.
    """
    context = docs.sparkSession.sparkContext
    shorter, hot = context.broadcast(shorter), context.broadcast(hot)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for piece in pieces(batch, "text"):
                _, words, _, _, _, within = _named_words(piece)
                name = words
                for k in range(1, size - 1):
                    name = extended(name[:len(words) - k], words[k:])
                often = has(shorter.value, name)
                n = max(len(words) - size + 1, 0)
                at = np.flatnonzero(often[:n] & often[1:n + 1] & (within[:n] == within[size - 1:size - 1 + n]))
                held.append((name[at], words[at + size - 1]))
                if sum(len(p) for p, _ in held) >= FLUSH_ENTRIES:
                    yield from _packed(*map(np.concatenate, zip(*held)), parts, hot.value)
                    held = []
        if held:
            yield from _packed(*map(np.concatenate, zip(*held)), parts, hot.value)

    packed = docs.mapInArrow(gather, _PACKED).repartitionById(parts, "part")
    return packed.groupBy("part").applyInArrow(_merged(least), "prefix long, word long, n long")


def _phrases(found: DataFrame, shorter: DataFrame, words: DataFrame) -> DataFrame:
    """Extensions with their text and the names of all their beginnings and ends."""
    prefix = shorter.select("lang", F.col("phrase").alias("begin"), F.col("id").alias("prefix"), "firsts", "rests")
    word = words.select(F.col("id").alias("word"), F.col("phrase").alias("end"))
    joined = found.join(prefix, "prefix").join(word, "word").select(
        "lang", F.concat_ws(" ", "begin", "end").alias("phrase"), "n", "prefix", "word", "firsts", "rests")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, word = (batch.column(c).to_numpy().view(_U) for c in ("prefix", "word"))
            rests = batch.column("rests").flatten().to_numpy().view(_U).reshape(len(word), -1)
            firsts = batch.column("firsts").flatten().to_numpy().view(_U).reshape(len(word), -1)
            rests = np.column_stack([extended(rests, np.broadcast_to(word[:, None], rests.shape)), word])
            firsts = np.column_stack([firsts, prefix])
            lists = [pa.ListArray.from_arrays(
                np.arange(len(word) + 1, dtype=np.int32) * a.shape[1], pa.array(np.ascontiguousarray(a).reshape(-1).view(np.int64))) for a in (firsts, rests)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("phrase"), pa.array(extended(prefix, word).view(np.int64)), batch.column("n"), batch.column("prefix"), *lists],
                names=["lang", "phrase", "id", "n", "prefix", "firsts", "rests"])

    return joined.mapInArrow(name, "lang string, phrase string, id long, n long, prefix long, firsts array<bigint>, rests array<bigint>")


# ------------------------------------------------------------------- mining
def phrase_levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> tuple[DataFrame, list[DataFrame]]:
    """Words a language (lang, total), and for each number of words the phrases that occur ``least`` times.

    A phrase has lang, phrase, id, n, prefix, and the ids of its beginnings and ends (firsts, rests).
    """
    docs = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    words = written(word_counts(docs), "words")
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("total")), "language_words")
    levels = [written(_frequent_words(words, least), "phrases_1")]
    for size in range(2, longest + 1):
        shorter = levels[-1]
        count, occurrences = shorter.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if count == 0:
            break
        hot = shorter.where(F.col("n") >= HOT_ENTRIES).select("id")
        found = stripes(
            docs, size, filter_of(shorter.select("id"), count), filter_of(hot, hot.count()),
            max(1, -(-occurrences // PART_ENTRIES)), least)
        levels.append(written(_phrases(found, shorter, levels[0]), f"phrases_{size}"))
    return totals, levels


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's ``first`` phrases by how far they exceed chance: lang, rank, phrase, a, l, r, n, score.

    Texts (A-Z in lower case) are cut at ``.,;:!?`` and line breaks, and into words at spaces and
    tabs.  Phrases of 2 to ``longest`` words that occur ``least`` times count; a is how often.  Cut in
    two, the parts occur l and r times, and n words are in the language: the score is
    floor(1000 a n / (l r)) of the cut with the lowest one, the earliest of equal ones.  A phrase that
    lies in a longer one which occurs as often is left out.  Ranks go by score, a, then phrase.

    A null or empty text has no words; a null language is ``und``.  Texts of any length are read
    whole.  Repeated rows count as often as they are there; ties are settled by the phrase.  An empty
    table gives no rows.  Other columns are not read, whatever their names.
    """
    totals, levels = phrase_levels(docs, least, longest, text, lang)
    both = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(both(frames[1:]))
    phrases = both(levels[1:] or [levels[0].where("false")])
    around = phrases.select(F.explode(F.array("prefix", F.get("rests", F.lit(0)))).alias("id"), "n").groupBy("id").agg(F.max("n").alias("most"))
    kept = phrases.join(around, "id", "left").where("most IS NULL OR most < n").select("lang", "phrase", F.col("n").alias("a"), "firsts", "rests")
    cuts = kept.select("lang", "phrase", "a", F.posexplode(F.arrays_zip("firsts", "rests")).alias("cut", "parts"))
    counts = both(levels[:longest - 1]).select("id", "n")
    of = lambda part, name: counts.select(F.col("id").alias(part), F.col("n").alias(name))
    parts = cuts.select("lang", "phrase", "a", "cut", "parts.firsts", "parts.rests").join(of("firsts", "l"), "firsts").join(of("rests", "r"), "rests")
    exact = lambda name, digits: F.col(name).cast(f"decimal({digits},0)")
    scored = parts.join(totals, "lang").withColumn("over", exact("a", 19) * exact("total", 19)).withColumn("under", exact("l", 19) * exact("r", 19))
    scored = scored.withColumn("score", F.expr("(1000 * over) div under"))
    lowest = scored.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct("score", "cut", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    ways = lowest.withColumn("way", F.pmod(F.xxhash64("phrase"), F.lit(RANK_WAYS)))
    near = ways.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "way").orderBy(*order))).where(F.col("rank") <= first)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

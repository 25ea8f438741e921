"""Words of texts looked up in a lexicon that is itself a table, of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tonegrain.functions.scoring import scored_sql
from tonegrain.functions.text import let, lower_tokens
from tonegrain.lexicon import DEFAULT_LEXICON, Lexicon
from tonegrain.operators.unnest import each

LEXICON_SCHEMA = "word string, weight double, factor double, negation boolean, pairs array<struct<second: string, factor: double>>"


def lexicon_counts(texts: DataFrame, lexicon: DataFrame, text_col: str = "chunk_text", word_col: str = "word") -> DataFrame:
    """Each word of ``lexicon`` (``word_col`` and any columns) that occurs, with its number of occurrences ``n``.

    Occurrences are added up per word before they meet the lexicon.  There is no hint: Spark
    broadcasts the lexicon when it measures below its threshold and shuffles both otherwise.
    """
    found = each(texts, [], lower_tokens(text_col), word_col).groupBy(word_col).agg(F.count(F.lit(1)).alias("n"))
    return found.join(lexicon, word_col)


def _mark(key: list[str]) -> Column:
    """A word for the text itself.  It is no token, and spread, so that marks do not meet in one task where tokens
    are shuffled."""
    return F.concat(F.lit("\0"), F.pmod(F.xxhash64(*key), F.lit(4096)).cast("string"))


def _is_mark(word_col: str) -> Column:
    return F.startswith(F.col(word_col), F.lit("\0"))


def word_scores(
    texts: DataFrame, key: list[str], lexicon: DataFrame, text_col: str = "chunk_text", word_col: str = "word",
) -> DataFrame:
    """Sum of ``weight`` over the words of each text, for lexicons too large for an expression.

    Tokens meet the lexicon before anything is grouped: a small lexicon is broadcast, and only
    its words, and one mark of each text, go on to the sum.  Weights add up as decimals of nine places,
    so the sum does not depend on the order of tasks.
    """
    tokens = F.concat(F.coalesce(lower_tokens(text_col), F.array().cast("array<string>")), F.array(_mark(key)))
    words = lexicon.where(~_is_mark(word_col)).select(word_col, F.col("weight").cast("decimal(28,9)").alias("weight"))
    met = each(texts, key, tokens, word_col).join(words, word_col, "left")
    met = met.where(F.col("weight").isNotNull() | _is_mark(word_col))
    return met.groupBy(*key).agg(F.coalesce(F.sum("weight").cast("double"), F.lit(0.0)).alias("weight"))


def lexicon_table(spark: SparkSession, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """A lexicon as a table: a word, its signed weight, its factor as a modifier, whether it negates, and the
    second words and factors of the two-word modifiers that start with it (0, false and [] for none)."""
    pairs: dict[str, list[tuple[str, float]]] = {}
    for pair, factor in lexicon.two_word_diminishers.items():
        first, second = pair.split(" ")
        pairs.setdefault(first, []).append((second, factor))
    weights, factors = lexicon.sentiment, lexicon.modifiers
    return spark.createDataFrame(
        [(w, weights.get(w, 0.0), factors.get(w, 0.0), w in lexicon.negations, pairs.get(w, [])) for w in sorted(lexicon.active_words)], LEXICON_SCHEMA)


def sentiment_by_table(texts: DataFrame, key: list[str], lexicon: DataFrame, text_col: str = "chunk_text") -> DataFrame:
    """``key`` and the result of ``scoring.sentiment``, by a lexicon that is a table of any size (see
    :func:`lexicon_table`), modifiers and negations included.

    ``key`` names a text.  Its tokens, each with the next one, meet the lexicon; the few that it holds come
    together again per text, in order, and the same fold runs over them.  A small lexicon is broadcast,
    so that only hits and one mark of each text are shuffled; a large one meets the tokens by word.
    """
    tokens = F.coalesce(lower_tokens(text_col), F.array().cast("array<string>"))
    mark = F.struct(_mark(key).alias("t"), F.lit(None).cast("string").alias("next"))

    def listed(words: Column) -> Column:
        own = F.transform(words, lambda t, i: F.struct(t.alias("t"), F.get(words, i + 1).alias("next")))
        return F.concat(own, F.array(mark))

    rows = texts.select(*key, F.posexplode_outer(let(tokens, listed)).alias("i", "token")).select(*key, "i", F.col("token.t").alias("word"), F.col("token.next").alias("next"))
    met = rows.join(lexicon.where(~_is_mark("word")).withColumn("known", F.lit(True)), "word", "left").where(F.col("known") | _is_mark("word"))
    second = F.get(F.filter("pairs", lambda p: p["second"] == F.col("next")), F.lit(0))["factor"]
    hit = F.struct(
        "i", F.col("word").alias("t"), F.col("weight").alias("w"), F.col("factor").alias("m1"), F.coalesce(second, F.lit(0.0)).alias("m2"),
        F.col("negation").alias("neg"))
    # The mark stands behind the last token, so its place is the number of tokens.
    gathered = met.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.when(F.col("known"), hit))).alias("hits"), F.max(F.when(_is_mark("word"), F.col("i"))).alias("n_words"))
    return gathered.select(*key, F.expr(scored_sql("hits", "n_words")).alias("s")).select(*key, "s.*")


#: Letters that a keyword is looked up by, and letters of a text that are cut into windows at once.
ANCHOR_LETTERS, BLOCK_LETTERS = 3, 1 << 16
#: Anchors that one pattern looks for, and ways on from a letter that it tries one by one.
MOST_ANCHORS, MOST_WAYS = 5000, 5


def keyword_table(spark: SparkSession, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """The domains of a lexicon as a table (domain, keyword)."""
    return spark.createDataFrame([(d, k) for d, ks in lexicon.domains.items() for k in ks], "domain string, keyword string")


def _letter(letters: list[str]) -> str:
    return "[" + "".join(c if c.isalnum() or not c.isascii() else f"\\{c}" for c in sorted(letters)) + "]"


def _starts_with(anchors: set[str]) -> str:
    """A pattern for any of some short texts, as a tree over their letters; one that starts like another is found by that."""
    if "" in anchors:
        return ""
    ends: dict[str, set[str]] = {}
    for anchor in anchors:
        ends.setdefault(anchor[0], set()).add(anchor[1:])
    ways: dict[str, list[str]] = {}
    for letter, rest in sorted(ends.items()):
        ways.setdefault(_starts_with(rest), []).append(letter)
    found = [(letters, _letter(letters) + rest) for rest, letters in ways.items()]
    while len(found) > MOST_WAYS:
        some = [found[i:i + MOST_WAYS] for i in range(0, len(found), MOST_WAYS)]
        letters = [[c for cs, _ in part for c in cs] for part in some]
        found = [(cs, f"(?={_letter(cs)})(?:{'|'.join(p for _, p in part)})") for cs, part in zip(letters, some)]
    return f"(?:{'|'.join(p for _, p in found)})"


def tags_by_table(texts: DataFrame, key: list[str], keywords: DataFrame, text_col: str = "chunk_text") -> DataFrame:
    """(``key``, domain): the domains with a keyword that the text holds, case ignored, by a table of any size.

    Each keyword is anchored at its first letters.  A text gives the letters from each place on that starts
    like an anchor, as many as the longest keyword has; they meet the keywords of the anchor, and one comparison
    tells whether the whole keyword stands there.  Up to ``MOST_ANCHORS`` different anchors are found by one
    pattern over the text; with more, all places meet the anchors.  The work follows the length of the text and the
    anchors it holds, not the number of keywords.  Keywords of null or no letters match nothing.
    """
    words = keywords.where("keyword <> ''").select("domain", F.lower("keyword").alias("keyword")).distinct()
    words = words.withColumn("letters", F.least(F.length("keyword"), F.lit(ANCHOR_LETTERS)))
    words = words.withColumn("anchor", F.expr("left(keyword, letters)"))
    sizes = words.agg(F.max(F.length("keyword")).alias("most"), F.collect_set("letters").alias("letters")).first()
    if not sizes["most"]:
        return texts.select(*key, F.lit(None).cast("string").alias("domain")).where("false")
    most, text = int(sizes["most"]), F.lower(F.col(text_col))
    # Long texts in blocks, each with the letters that a keyword may take from the next one.
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text), F.lit(BLOCK_LETTERS)))
    blocks = F.transform(starts, lambda at: F.substring(text, at, BLOCK_LETTERS + most))
    anchors = {r[0] for r in words.select("anchor").distinct().limit(MOST_ANCHORS + 1).collect()}
    at = f"(?={_starts_with(anchors)})" if len(anchors) <= MOST_ANCHORS else ""
    windows = F.regexp_extract_all(F.col("block"), F.lit(f"(?s){at}(?=(.{{1,{most}}}))"), F.lit(1))
    rows = each(each(texts, key, blocks, "block"), key, F.array_distinct(windows), "window")
    ends = F.array(*[F.struct(F.lit(n).alias("letters"), F.left("window", F.lit(n)).alias("anchor")) for n in sorted(sizes["letters"])])
    anchored = rows.select(*key, "window", F.explode(ends).alias("a")).select(*key, "window", "a.letters", "a.anchor")
    met = anchored.join(words, ["letters", "anchor"]).where(F.startswith("window", F.col("keyword")))
    return met.select(*key, "domain").distinct()

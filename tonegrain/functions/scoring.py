"""The rule-based sentiment scorer, as one expression per result.

The walk over the tokens of a text is sequential: a modifier uses up the next token, so
whether a word is a modifier or a target depends on what came before.  It is written as
a fold (``aggregate``) over the few tokens that can change the outcome; all others only
move the position, which each hit carries along.  Everything stays in the JVM, works on
whole texts and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tonegrain.functions.patterns import pattern_matches, tags
from tonegrain.functions.sql import is_in, let, name, weight_of
from tonegrain.functions.text import as_column, is_blank, tokens, words_sql
from tonegrain.lexicon import (
    DEFAULT_LEXICON, NEGATION_WINDOW, POSITIVE_THRESHOLD, PREVIEW_CHARS, Lexicon,
)


def word_count(text: Column | str) -> Column:
    return F.when(is_blank(text), F.lit(0)).otherwise(F.size(tokens(text)))


def char_count(text: Column | str) -> Column:
    """Code points of the whole text; 0 when there is nothing but white space."""
    return F.when(is_blank(text), F.lit(0)).otherwise(F.length(as_column(text)))


def hits_sql(words: str, lexicon: Lexicon) -> str:
    """The tokens that matter, with their 0-based position ``i``.

    ``w`` is the signed sentiment weight, ``m1`` and ``m2`` the factor of a modifier of one
    or two tokens that starts here (0 = none), ``neg`` tells whether it is a negation.
    """
    pair = f"concat_ws(' ', h.t, get({words}, h.i + 1))"
    return f"""
      transform(
        filter(
          transform({words}, (t, i) -> CASE WHEN {is_in("t", lexicon.active_words)} THEN struct(i AS i, t AS t) END),
          h -> h IS NOT NULL),
        h -> struct(
          h.i AS i, h.t AS t,
          {weight_of("h.t", lexicon.sentiment)} AS w,
          {weight_of("h.t", lexicon.modifiers)} AS m1,
          CASE WHEN {is_in("h.t", lexicon.two_word_starters)}
               THEN {weight_of(pair, lexicon.two_word_diminishers)} ELSE 0D END AS m2,
          {is_in("h.t", lexicon.negations)} AS neg))"""


def _with_word(list_name: str, test: str) -> str:
    """Add the word to a distinct list; lists stay as short as the lexicon."""
    return (
        f"CASE WHEN {test} AND NOT array_contains(s.{list_name}, e.t) "
        f"THEN array_append(s.{list_name}, e.t) ELSE s.{list_name} END AS {list_name}"
    )


def fold_sql(hits: str) -> str:
    """Run over the hits.  ``target`` is the position that takes the pending ``factor``,
    ``free`` the next one that may act on its own, ``last_neg`` the latest negation."""
    none = "cast(array() AS array<string>)"
    is_target = "e.i = s.target"
    idle = "(e.i <> s.target AND e.i >= s.free)"
    negated = f"(e.i - s.last_neg <= {NEGATION_WINDOW})"
    lifts = f"((e.w > 0) <> {negated})"
    last_neg = "CASE WHEN e.neg THEN e.i ELSE s.last_neg END AS last_neg"
    width = "CASE WHEN e.m2 > 0 THEN 2 ELSE 1 END"
    points = f"e.w * CASE WHEN {is_target} THEN s.factor ELSE 1D END"
    return f"""
      aggregate({hits},
        struct(0D AS raw, -1 AS target, 0 AS free, 1D AS factor, -1000 AS last_neg,
               {none} AS pos, {none} AS neg, {none} AS negated),
        (s, e) -> CASE
          -- a modifier in a place of its own: its factor waits for the token after it
          WHEN {idle} AND (e.m1 > 0 OR e.m2 > 0) THEN struct(
            s.raw AS raw, e.i + {width} AS target, e.i + {width} + 1 AS free,
            CASE WHEN e.m2 > 0 THEN e.m2 ELSE e.m1 END AS factor, {last_neg},
            s.pos AS pos, s.neg AS neg, s.negated AS negated)
          -- a sentiment word, as the target of a modifier or on its own
          WHEN ({is_target} OR {idle}) AND e.w <> 0 THEN struct(
            s.raw + CASE WHEN {negated} THEN -({points}) ELSE {points} END AS raw,
            s.target AS target, s.free AS free, s.factor AS factor, {last_neg},
            {_with_word("pos", lifts)},
            {_with_word("neg", f"NOT {lifts}")},
            {_with_word("negated", negated)})
          -- used up or without effect, except that a negation is noted
          ELSE struct(s.raw AS raw, s.target AS target, s.free AS free, s.factor AS factor, {last_neg},
                      s.pos AS pos, s.neg AS neg, s.negated AS negated)
        END)"""


def scored_sql(hits: str, n_words: str) -> str:
    """The scorer over the hits of a text that has ``n_words`` tokens."""
    score = f"CASE WHEN {n_words} = 0 THEN 0D ELSE greatest(-1D, least(1D, tanh(f.raw / (sqrt({n_words}) + 1D)))) END"
    label = (
        f"CASE WHEN score > {POSITIVE_THRESHOLD}D THEN 'positive' "
        f"WHEN score < -{POSITIVE_THRESHOLD}D THEN 'negative' ELSE 'neutral' END"
    )
    result = f"""struct(
        f.raw AS raw_score, score AS sentiment_score, {label} AS sentiment_label,
        array_sort(f.pos) AS positive_words, array_sort(f.neg) AS negative_words,
        array_sort(f.negated) AS negated_words, {n_words} AS word_count)"""
    return let("f", fold_sql(hits), let("score", score, result))


def sentiment_sql(words: str, lexicon: Lexicon) -> str:
    """The scorer over an array of lower-cased tokens."""
    return let("words", words, scored_sql(hits_sql("words", lexicon), "size(words)"))


def sentiment(text_col: str, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Score the text in a column: ``struct<raw_score, sentiment_score, sentiment_label,
    positive_words, negative_words, negated_words, word_count>``.

    ``sentiment_score`` is not rounded here.  Word lists are distinct and sorted.
    """
    return F.expr(sentiment_sql(words_sql(name(text_col)), lexicon))


def score_text(
    df: DataFrame, text_col: str = "chunk_text", lexicon: Lexicon = DEFAULT_LEXICON,
    *, strict_caps: bool = False, whole_word_tags: bool = False,
) -> DataFrame:
    """Add the ten result columns for ``text_col``; unused ones are pruned by the planner."""
    s, words = "_sentiment", "_words"
    return (
        # Tokens serve the score and the tags; they are cut once.
        df.withColumn(words, F.expr(words_sql(name(text_col))))
        .withColumn(s, F.expr(sentiment_sql(words, lexicon)))
        .withColumns({
            "raw_score": F.col(f"{s}.raw_score"),
            "sentiment_score": F.round(F.col(f"{s}.sentiment_score"), 4),
            "sentiment_label": F.col(f"{s}.sentiment_label"),
            "positive_words": F.col(f"{s}.positive_words"),
            "negative_words": F.col(f"{s}.negative_words"),
            "negated_words": F.col(f"{s}.negated_words"),
            "tags": tags(text_col, lexicon, whole_word=whole_word_tags, words_col=words),
            "pattern_matches": pattern_matches(text_col, lexicon, strict_caps=strict_caps),
            "word_count": F.col(f"{s}.word_count"),
            "char_count": char_count(text_col),
        })
        .drop(s, words)
    )


def negation_sql(words: str, lexicon: Lexicon) -> str:
    """Each token with its 0-based ``position`` and whether one of the tokens before it negates it."""
    return f"""transform({words}, (t, i) -> struct(i AS position, t AS word,
        exists(slice({words}, greatest(i - {NEGATION_WINDOW - 1}, 1), least(i, {NEGATION_WINDOW})), b -> {is_in("b", lexicon.negations)}) AS negated))"""


def with_preview(df: DataFrame, text_col: str = "chunk_text", n_chars: int = PREVIEW_CHARS) -> DataFrame:
    """Add ``preview``, the first ``n_chars`` code points of the text, for display."""
    return df.withColumn("preview", F.left(F.col(text_col), F.lit(n_chars)))

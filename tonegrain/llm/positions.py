"""Benchmark decontamination by a distributed positional inverted index; DataFrame functions only.

The index is a table of postings (term, row, pos), every word of every document.  Each task posts
the documents it reads and sorts its postings by term: a segment, in which the list of a term
lies together, written without any shuffle.  A document also posts its length, and its id, under no
term, so the index holds all that a report needs.

A search ranks the terms of each phrase from the rarest.  The list of the rarest one, moved by its
place in the phrase, gives candidate starts; the list of the next one is moved likewise and
intersected with them; what is left is intersected with the lists of all other terms.  The lists
of frequent words are read only for documents that are still candidates.

Terms are named by 64-bit hashes.  Phrases that several items share are looked for once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.llm.common import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE_WORDS = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text with A-Z in lower case; none of a null text."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


# ---------------------------------------------------------------------- index
def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The postings of ``docs``: term, row (a number for each row of docs), pos (from 0), id.

    ``term`` is null in one posting of each row, whose pos is the row's number of words and whose
    id is the row's ``key``; id is null elsewhere.  The table lies in the shared folder.
    """
    listed = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"),
        F.concat(words_of(F.col(text)), F.array(F.lit(None).cast("string"))).alias("words"))
    # Every list has an element, so the outer form gives the same rows; the inner one would compute the words twice.
    each = listed.select("row", "id", F.posexplode_outer("words").alias("pos", "word"))
    is_word = F.col("word").isNotNull()
    postings = each.select(
        F.when(is_word, F.xxhash64("word")).alias("term"), "row", "pos", F.when(~is_word, F.col("id")).alias("id"))
    return written(postings.sortWithinPartitions("term"), "positional_index")


def indexed_rows(index: DataFrame) -> DataFrame:
    """row, id and n_words of each row of the indexed documents."""
    return index.where("term IS NULL").select("row", "id", F.col("pos").cast("long").alias("n_words"))


# -------------------------------------------------------------------- phrases
def phrases_of(items: DataFrame, width: int = PHRASE_WORDS, text: str = "text", key: str = "item_id") -> DataFrame:
    """phrase, item, terms: every run of ``width`` words of each item, or all words of a shorter one."""
    listed = items.select(F.col(key).alias("item"), F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("terms"))
    n = F.size("terms")
    runs = F.when(n >= width, F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda s: F.slice("terms", s + 1, width)))
    runs = runs.when(n > 0, F.array("terms"))
    each = listed.select("item", F.explode(runs).alias("terms"))
    return each.select(F.xxhash64("terms").alias("phrase"), "item", "terms")


def ranked(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase and ``lists``: its (n, off, term) from the rarest term; phrases with a term that no document has are out."""
    distinct = phrases.select("phrase", "terms").dropDuplicates(["phrase"])
    places = distinct.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("off", "term"))
    asked = written(places.select("term").distinct(), "phrase_terms")
    counts = index.join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    lists = places.join(counts, "term").groupBy("phrase", "size").agg(F.sort_array(F.collect_list(F.struct("n", "off", "term"))).alias("lists"))
    return written(lists.where(F.size("lists") == F.col("size")).select("phrase", "lists"), "ranked_phrases")


# --------------------------------------------------------------------- search
def _starts(index: DataFrame, lists: DataFrame) -> DataFrame:
    """phrase, row, start wherever the rarest term of a phrase stands at its place.

    The index is first thinned to the rarest terms.  They are a narrow list, and far smaller than the
    phrases, so it is broadcast where these would have the whole index shuffled.
    """
    rarest = lists.select("phrase", F.col("lists")[0]["term"].alias("term"), F.col("lists")[0]["off"].alias("off"))
    terms = written(rarest.select("term").distinct(), "rarest_terms")
    postings = index.select("term", "row", "pos").join(terms, "term", "left_semi")
    return postings.join(rarest, "term").select("phrase", "row", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")


def phrase_matches(index: DataFrame, lists: DataFrame) -> DataFrame:
    """phrase, row, start, n_terms of every exact occurrence, overlapping ones included."""
    size = F.size("lists")
    starts = _starts(index, lists.where(size > 1))
    # The second list: only postings of the terms that come second somewhere meet the candidates.
    second = lists.where(size > 1).select("phrase", F.col("lists")[1]["term"].alias("term"), F.col("lists")[1]["off"].alias("off"))
    seconds = written(second.select("term").distinct(), "second_terms")
    moved = starts.join(second, "phrase").select("phrase", "row", "start", "term", (F.col("start") + F.col("off")).alias("pos"))
    both = written(
        moved.join(index.join(seconds, "term", "left_semi").select("term", "row", "pos"), ["term", "row", "pos"])
        .select("phrase", "row", "start").distinct(), "candidates")
    # All other lists, in the rows that still have candidates.
    others = lists.where(size > 2).select("phrase", F.explode(F.slice("lists", 3, size - 2)).alias("list"))
    needed = both.join(others, "phrase").select("phrase", "row", "start", F.col("list.term").alias("term"), (F.col("start") + F.col("list.off")).alias("pos"))
    terms = written(others.select("list.term").distinct(), "other_terms")
    rows = written(both.select("row").distinct(), "candidate_rows")
    postings = index.join(terms, "term", "left_semi").join(rows, "row", "left_semi").select("term", "row", "pos").distinct()
    met = needed.join(postings, ["term", "row", "pos"]).groupBy("phrase", "row", "start").agg(F.count(F.lit(1)).alias("met"))
    sizes = lists.select("phrase", size.alias("n_terms"))
    columns = ["phrase", "row", "start", "n_terms"]
    two = both.join(sizes.where("n_terms = 2"), "phrase").select(*columns)
    found = two.unionByName(met.join(sizes, "phrase").where("met = n_terms - 2").select(*columns))
    single = lists.where(size == 1)
    if single.isEmpty():
        return found
    return found.unionByName(_starts(index, single).distinct().withColumn("n_terms", F.lit(1)).select(*columns))


def proximity_matches(index: DataFrame, lists: DataFrame, within: int) -> DataFrame:
    """phrase, row, pos: the places of a phrase's rarest term that have all its other terms less than ``within`` words away.

    Order and repetitions of the terms do not matter.  The places meet the other lists by row and
    by cells of ``within`` words, so that only near postings are compared.
    """
    places = _starts(index, lists.select("phrase", F.transform("lists", lambda x: F.struct(F.lit(0).alias("off"), x["term"].alias("term"))).alias("lists")))
    places = places.withColumnRenamed("start", "pos").distinct()
    rest = F.array_except(F.array_distinct(F.transform("lists", lambda x: x["term"])), F.array(F.col("lists")[0]["term"]))
    others = lists.select("phrase", rest.alias("rest"))
    alone = places.join(others.where(F.size("rest") == 0).select("phrase"), "phrase", "left_semi")
    cell = F.floor(F.col("pos") / within)
    asked = places.join(others, "phrase").select(
        "phrase", "row", "pos", F.size("rest").alias("asked"), F.explode("rest").alias("term"),
    ).withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    terms = written(others.select(F.explode("rest").alias("term")).distinct(), "near_terms")
    near = index.join(terms, "term", "left_semi").select("term", "row", F.col("pos").alias("at"), F.floor(F.col("pos") / within).alias("cell"))
    met = asked.join(near, ["term", "row", "cell"]).where(F.abs(F.col("at") - F.col("pos")) < within)
    found = met.groupBy("phrase", "row", "pos", "asked").agg(F.count_distinct("term").alias("met")).where("met = asked")
    return alone.unionByName(found.select("phrase", "row", "pos"))


# --------------------------------------------------------------------- report
def contamination(docs: DataFrame, items: DataFrame, width: int = PHRASE_WORDS, text: str = "text", key: str = "doc_id",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: its key, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies inside an occurrence of a phrase of any item.  n_items counts the items
    with a phrase in the row, items_sha256 is the digest of their ids, sorted as strings and joined
    by commas.  A null or empty text has no words and is not contaminated; an item without words
    has no phrase; an item of null id gives hits and is not listed.  Texts of any length are read
    whole.  Each row is reported by itself, so repeated rows and rows of null or equal keys come out
    as often as they are there; equal items are listed each by its id.  An empty table of documents
    gives no rows, one of items leaves all documents clean.  Other columns do not come through, and
    their names do not matter.
    """
    index = build_index(docs, text, key)
    phrases = written(phrases_of(items, width, item_text, item_key), "phrases")
    found = written(phrase_matches(index, ranked(index, phrases)), "occurrences")
    # Words hit: each occurrence adds what lies behind the ends of those that start before it.
    stretches = found.groupBy("row", "start").agg(F.max(F.col("start") + F.col("n_terms")).alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    since = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = stretches.select("row", F.greatest(F.col("end") - since, F.lit(0)).alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
    # Items: rows with the same phrases share one list, so a passage of many rows and many items is listed once.
    sets = found.groupBy("row").agg(F.sort_array(F.collect_set("phrase")).alias("set"))
    sets = sets.select("row", "set", F.sha2(F.array_join(F.col("set").cast("array<string>"), ","), 256).alias("name"))
    sets = written(sets, "phrase_sets")
    listed = sets.groupBy("name").agg(F.first("set").alias("set")).select("name", F.explode("set").alias("phrase"))
    item = phrases.where("item IS NOT NULL").select("phrase", F.col("item").cast("string").alias("item")).distinct()
    lists = listed.join(item, "phrase").groupBy("name").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        "name", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    named = sets.select("row", "name").join(lists, "name", "left").drop("name")
    marks = hit.join(named, "row")
    return indexed_rows(index).join(marks, "row", "left").select(
        F.col("id").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))

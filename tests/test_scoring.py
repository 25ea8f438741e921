import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.rules import score, walk
from tonegrain.functions.patterns import pattern_matches, tags
from tonegrain.functions.scoring import score_text, sentiment
from tonegrain.lexicon import DEFAULT_LEXICON as LEX, Lexicon


def scored(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.asDict() for r in score_text(df, "text", **options).orderBy("i").collect()]


RAW = [
    ("good", 1), ("very good", 1.5), ("very very good", 1), ("so very good", 1), ("kind of good", 0.5),
    ("very kind of good", 2.5), ("a bit", 0), ("not good", -1), ("not bad", 1), ("not very good", -1.5),
    ("not really all that good", 1), ("good not", 1), ("don’t love", 2), ("don't love", -2),
    ("never barely good", -0.3), ("extremely", 0), ("", 0), ("GOOD Terrible", -1), ("a little good", 0.5),
    ("sort of a bit good", 1), ("a bit of good", 1), ("kind", 1), ("a good", 1),
]


def test_raw_scores(spark):
    rows = scored(spark, [t for t, _ in RAW])
    assert [round(r["raw_score"], 6) for r in rows] == [s for _, s in RAW]


def test_word_lists(spark):
    rows = scored(spark, ["not good", "not bad", "good and not good", "kind of kind"])
    assert (rows[0]["negative_words"], rows[0]["negated_words"], rows[0]["positive_words"]) == (["good"], ["good"], [])
    assert (rows[1]["positive_words"], rows[1]["negated_words"]) == (["bad"], ["bad"])
    assert (rows[2]["positive_words"], rows[2]["negative_words"]) == (["good"], ["good"])
    assert rows[3]["positive_words"] == ["kind"]


def test_blank_texts(spark):
    for r in scored(spark, [None, "", "  \t \n"]):
        assert (r["raw_score"], r["sentiment_score"], r["sentiment_label"]) == (0, 0, "neutral")
        assert (r["word_count"], r["char_count"], r["tags"], r["pattern_matches"]) == (0, 0, [], [])
    assert scored(spark, ["!!! "])[0]["char_count"] == 4


def test_tokens_and_counts(spark):
    rows = scored(spark, ["rock'n'roll", "Café déjà_vu 3x", "don’t", "a\U0001F600b", "İyi İll good"])
    assert [r["word_count"] for r in rows] == [2, 3, 2, 2, 3]
    assert [r["char_count"] for r in rows] == [11, 15, 5, 3, 12]
    assert rows[4]["positive_words"] == ["good"] and rows[4]["negative_words"] == []


def test_labels_use_strict_bounds(spark):
    rows = scored(spark, ["good", "bad", "the", "good " + "x " * 200])
    assert [r["sentiment_label"] for r in rows] == ["positive", "negative", "neutral", "neutral"]


PATTERN_CASES = {
    "email": (["mail a.b+c@x-y.example.org now", "é.a@b.co"], ["a@b", "a@b.c", "a@b.comé "]),
    "url": (["see HTTPS://x.org", "http://a"], ["http:// ", "ftp://x"]),
    "phone": (["call 555-123-4567", "+1 (555) 123 4567", "123456789"], ["12345678", "a123456789", "1234-"]),
    "date": (["12/05/2024", "1-2-99"], ["2024-01-05x", "112/05/2024", "1/2/3"]),
    "currency": (["$1,200.50", "$,", "12.50 EUR", "5usd", "7 Inr."], ["USD 5", "5 USDT", "x5 USD"]),
    "percentage": (["45%", "a 5.5% b"], ["x45%", "% 5"]),
    "hashtag": (["#refund", "#é"], ["# x"]),
    "mention": (["@team", "a@b"], ["@ x"]),
    "number": (["5", "1,200", "x 7."], ["a5", "5a", "é5"]),
    "question": (["what?"], ["what"]),
    "exclamation": (["hey!"], ["hey"]),
    "all_caps_word": (["ab", "URGENT"], ["a", "éé", "a1b2"]),
}


@pytest.mark.parametrize("strict", [False])
def test_patterns(spark, strict):
    cases = [(p, t, want) for p, (yes, no) in PATTERN_CASES.items() for want, ts in ((True, yes), (False, no)) for t in ts]
    df = spark.createDataFrame([(i, c[1]) for i, c in enumerate(cases)], "i int, text string")
    rows = df.select("i", pattern_matches("text").alias("p")).orderBy("i").collect()
    wrong = [(c, r.p) for c, r in zip(cases, rows) if (c[0] in r.p) != c[2]]
    assert not wrong


def test_date_inside_iso_date(spark):
    # "2024-01-05" holds no match: the day part would need a word border after "20".
    df = spark.createDataFrame([("2024-01-05",), ("24-01-05",)], "text string")
    got = [("date" in r.p) for r in df.select(pattern_matches("text").alias("p")).collect()]
    assert got == [False, True]


def test_strict_caps(spark):
    df = spark.createDataFrame([("urgent",), ("URGENT now",)], "text string")
    rows = df.select(pattern_matches("text", strict_caps=True).alias("p")).collect()
    assert ["all_caps_word" in r.p for r in rows] == [False, True]


def test_tags(spark):
    texts = ["Happy", "he said", "machine  learning", "machine learning", "MENTAL HEALTH", "human rights", "humanrights", "", "saİd", "İ machine, learning", "human, rights"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.t for r in df.select(tags("text").alias("t")).collect()]
    assert got == [["technology"], ["technology"], ["education"], ["technology", "education"], ["health"], ["social"], [], [], ["technology"], ["education"], []]
    whole = [r.t for r in df.select(tags("text", whole_word=True).alias("t")).collect()]
    assert whole == [[], [], ["education"], ["technology", "education"], ["health"], ["social"], [], [], [], ["education"], []]


def test_own_lexicon(spark):
    mine = LEX.with_(positive={"yay": 5.0}, negative={}, two_word_diminishers={}, domains={"pets": ("cat", "dog food")})
    row = scored(spark, ["very yay, not good, dog food"], lexicon=mine)[0]
    assert (row["raw_score"], row["positive_words"], row["tags"]) == (7.5, ["yay"], ["pets"])
    assert isinstance(mine, Lexicon)


ACTIVE = sorted(LEX.active_words)
SOUP = st.lists(
    st.one_of(
        st.sampled_from(["very", "so", "a", "bit", "little", "kind", "of", "sort", "not", "never", "good", "bad"]),
        st.sampled_from(ACTIVE), st.sampled_from(["x", "the", "it's", "été"]),
    ), max_size=25,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SOUP, min_size=40, max_size=60))
def test_fold_agrees_with_the_rules(spark, soups):
    texts = [" ".join(s) for s in soups]
    for text, row in zip(texts, scored(spark, texts)):
        raw, up, down, flipped, n = walk(text)
        assert abs(row["raw_score"] - raw) < 1e-9, text
        assert (row["positive_words"], row["negative_words"], row["negated_words"]) == (up, down, flipped), text
        assert row["word_count"] == n
        exact = score(raw, n)
        assert abs(row["sentiment_score"] - exact) <= 0.00005001 and -1 <= row["sentiment_score"] <= 1
        assert row["sentiment_label"] == ("positive" if exact > 0.15 else "negative" if exact < -0.15 else "neutral")


def test_large_random_soup(spark):
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice(ACTIVE + ["of", "bit", "little", "x"]) for _ in range(rnd.randint(0, 400))) for _ in range(300)]
    for text, row in zip(texts, scored(spark, texts)):
        raw, up, down, flipped, n = walk(text)
        assert abs(row["raw_score"] - raw) < 1e-6
        assert (row["positive_words"], row["negative_words"], row["negated_words"]) == (up, down, flipped)


def test_one_fold_and_no_python_in_the_plan(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("text"), F.col("id"))
    df = df.repartition(2)
    plan = plan_of(score_text(df, "text"))
    assert plan.count("aggregate(") == 1 and plan.count("regexp_extract_all") == 1
    assert "Python" not in plan and "Pandas" not in plan
    # Asking for tags alone must not run the fold.
    assert "aggregate(" not in plan_of(score_text(df, "text").select("tags"))


def test_sentiment_is_one_column(spark):
    df = spark.createDataFrame([("not good",)], "text string")
    assert df.select(sentiment("text").alias("s")).select("s.raw_score").collect()[0][0] == -1

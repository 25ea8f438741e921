import zlib
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import DATA, plan_of
from tests.llm.conftest import rows_of
from tonegrain.llm import queries
from tonegrain.llm.shards import shard, shard_of


def test_every_record_once_with_gapless_slots(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = shard(docs, 16, bucket_bytes=20_000).select("shard", "slot", "record.*").collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1000))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in rows)
    for s, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
        order = [r["doc_id"] for r in sorted((r for r in rows if r["shard"] == s), key=lambda r: r["slot"])]
        assert order != sorted(order)


def test_key_law(spark):
    ids = spark.range(4000)
    rows = ids.select("id", shard_of("id", 16).alias("a"), shard_of("id", 17).alias("b"), shard_of("id", 1).alias("one")).collect()
    assert all(r["b"] in (r["a"], 16) and r["one"] == 0 for r in rows)
    assert 150 < sum(r["b"] == 16 for r in rows) < 330 and set(r["a"] for r in rows) == set(range(16))
    assert max(Counter(r["a"] for r in rows).values()) < 350


def test_hot_key_is_split_into_buckets(documents):
    docs = documents(*[(7, "x" * 100)] * 600, *[(i, "y") for i in range(100)])
    rows = shard(docs, 4, bucket_bytes=10_000)
    assert rows.count() == 700 and rows.where("record.doc_id = 7").select("shard").distinct().count() == 1


def test_shuffle_is_uniform(documents):
    first = Counter()
    for seed in range(24):
        first[shard(documents(*[(i, "t") for i in range(4)]).coalesce(1), 1, seed=seed).where("slot = 0").first()["record"]["doc_id"]] += 1
    assert len(first) == 4 and max(first.values()) < 15


def test_edges(documents):
    docs = documents((1, None), (2, ""), (3, "x" * 500_000), (None, "n"), (4, "t"), (4, "t"), more=True)
    out = shard(docs, 3)
    assert rows_of(out.select("record.*"), "doc_id", "text", "shard") == rows_of(docs, "doc_id", "text", "shard")
    assert shard(documents(), 3).collect() == []
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)


def test_registered_query(spark, small):
    """Every column of the result by plain Python, and the same result again."""
    df = queries.queries()["op9_sharding"](spark, small)
    assert df.dtypes == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    rows = {r["doc_id"]: r for r in df.collect()}
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for i, text in docs.items():
        r = rows[i]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 1, zlib.crc32(text), "key")
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
    for s, n in Counter(r["shard"] for r in rows.values()).items():
        assert sorted(r["slot"] for r in rows.values() if r["shard"] == s) == list(range(n))
    again = {r["doc_id"]: r for r in queries.queries()["op9_sharding"](spark, small).collect()}
    assert again == rows


def test_texts_are_shuffled_once(spark, small):
    """Even where nothing may be broadcast by its planned size, no exchange above the shards carries a text."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    crc = F.crc32(F.col("record.text").cast("binary")).alias("crc")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(shard(docs, 4, [crc], bucket_bytes=20_000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    above = plan[:plan.index("FileScan")]
    assert "Exchange hashpartitioning(shard" in above
    assert "record" not in "".join(line for line in above.splitlines() if "Exchange" in line or "Sort [" in line or "Join" in line)
    assert "BroadcastHashJoin" in plan_of(shard(docs, 4, [crc], bucket_bytes=20_000))

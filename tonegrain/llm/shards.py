"""Sharding as a two-pass external shuffle, by DataFrame functions only.

Pass 1 scatters the records uniformly into buckets that fit into memory, by seeded hashes.
Pass 2 gathers each bucket, gives it a Fisher-Yates shuffle (Spark's ``shuffle`` of an array,
seeded by bucket) and writes it into the folder of its shard.

The law is ``key``: highest random weight of (key, shard) picks the shard, so the key and the
number of shards decide alone, and a further shard takes records only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tonegrain.llm.common import shared_folder, written

BUCKET_BYTES = 32 << 20
_SHARD, _BUCKET, _DRAW, _ROWS = "shard", "bucket", "draw", "rows"


def shard_of(key: str, n_shards: int, seed: int = 0) -> Column:
    """The shard from 0 to n_shards - 1 whose hash with the key is highest."""
    weights = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), F.col(key)).alias("w"), F.lit(i).alias("shard")) for i in range(n_shards)]
    return weights[0]["shard"] if n_shards == 1 else F.greatest(*weights)["shard"]


def scattered(records: DataFrame, size: Column, n_shards: int, key: str, seed: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """(shard, bucket, draw, record) of all ``records``, and the number of buckets.

    A shard gets as many buckets as its bytes need.  Within it a record's bucket hashes its
    place in the input too, so records of one key, or equal records, do not meet in one bucket.
    """
    sharded = records.select(
        shard_of(key, n_shards, seed).alias(_SHARD), size.cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.monotonically_increasing_id()).alias(_DRAW),
        F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record"))
    totals = {r[0]: r[1] or 0 for r in sharded.groupBy(_SHARD).agg(F.sum("size")).collect()}  # n_shards rows
    counts = [max(1, -(-totals.get(s, 0) // bucket_bytes)) for s in range(n_shards)]
    first = [sum(counts[:s]) for s in range(n_shards)]
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col(_SHARD) + 1)
    bucket = (pick(first) + F.pmod(F.col(_DRAW), pick(counts))).cast("int")
    return sharded.select(_SHARD, bucket.alias(_BUCKET), _DRAW, "record"), sum(counts)


def write_shards(
    records: DataFrame, folder: str, n_shards: int = 16, key: str = "doc_id", size: Column | None = None,
    seed: int = 0, bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write ``records`` in random order to ``folder/shard=i``, one file per bucket.

    ``size``: bytes of a record, by default those of its text and 64 more.  Any columns pass
    through, nulls included; a null key is a key of its own.  Beside the record's own columns
    (in the struct ``record``, so no name can clash) a row has its bucket and its place in it.
    Repeated rows are all written; an empty table writes no row.

    The shard follows from key and seed alone.  The order within a shard follows from the seed and
    from where each row stands in the input: a rerun on the same splits gives the same order,
    while rows that come in other partitions are drawn anew.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64 if size is None else size
    slim, n_buckets = scattered(records, size, n_shards, key, seed, bucket_bytes)
    # Bucket i is partition i, so the shuffle of each bucket has a seed of its own, whatever runs where.
    # Rows arrive in any order; they are put in one that a rerun has too.
    placed = slim.repartitionById(n_buckets, F.col(_BUCKET)).sortWithinPartitions(_BUCKET, _DRAW)
    gathered = placed.groupBy(_BUCKET, _SHARD).agg(F.shuffle(F.collect_list("record"), seed).alias(_ROWS))
    mixed = gathered.select(_SHARD, _BUCKET, F.posexplode_outer(_ROWS).alias("at", "record"))
    mixed.write.mode("errorifexists").partitionBy("shard").parquet(folder)


def read_shards(spark, folder: str, schema, fields: list[Column] | None = None) -> DataFrame:
    """(shard, slot, record) of written shards; slots count from 0 in the order of each shard.

    ``fields`` are columns to have in the place of ``record``; they are taken from it before slots
    are added, so that what follows handles no more than them.
    """
    rows = spark.read.schema(schema).parquet(folder)
    # A row for each bucket: bounded by the bytes of the corpus over those of a bucket.  It is a table of
    # its own, whose size Spark knows, so that the records need not be shuffled to meet it.
    counts = written(rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")), "shard-buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = written(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "shard-bases")
    slim = rows.select("shard", "bucket", "at", F.struct(*(fields or [F.col("record")])).alias("fields"))
    return slim.join(base, ["shard", "bucket"]).select("shard", (F.col("base") + F.col("at")).alias("slot"), "fields.*")


def shard(records: DataFrame, n_shards: int = 16, fields: list[Column] | None = None, **options) -> DataFrame:
    """Write ``records`` to shards in a new shared folder and return them as (shard, slot, record) or with ``fields`` of it.

    Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names: see :func:`write_shards`.
    """
    folder = shared_folder(records.sparkSession, "shards")
    write_shards(records, folder, n_shards, **options)
    kind = records.select(F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record")).schema
    kind.add("bucket", "integer").add("at", "integer").add("shard", "integer")
    return read_shards(records.sparkSession, folder, kind, fields)

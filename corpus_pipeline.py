"""The corpus pipeline: language ID, line dedup, near-duplicate join, mixing, tokenizing.

Each stage takes what its predecessor kept and returns a DataFrame, which is written as Parquet
and read again; all but the last return the columns of ``documents``, in their order and with their
types, and drop any other column whatever its name.  Every stage takes an empty table to an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tonegrain.llm.bpe import round_trip
from tonegrain.llm.common import shared_folder, ship_package
from tonegrain.llm.language import with_language
from tonegrain.llm.line_dedup import dedup_lines
from tonegrain.llm.mixing import mixed_documents
from tonegrain.llm.ngram_join import drop_near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text has a language; those without a letter or in unlearned letters go.

    Null and empty texts go.  Repeated rows, and rows of null or equal ids, fare by their texts alone.
    """
    return with_language(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines of passages that an earlier one has.

    Documents stay even if no line does, a null text stays null; rows equal in id and text fare alike.
    """
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id of each group of near copies.

    Null ids come last; of repeated rows one stays; null texts and texts without words all stay.
    """
    return drop_near_duplicates(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it.

    A null source is a source; null and empty texts have size 0; rows equal in id, source and size fare alike.
    """
    return mixed_documents(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document of the mix, with the digest of what they decode to.

    A null text counts as empty; every row is encoded by itself, repeated ones too.
    """
    return round_trip(docs, RANKS, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard_join", near_duplicates),
    ("mixing", mixing), ("byte_bpe", tokens),
]

#: The decisions of learned language profiles and of sampling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them goes to the shared folder."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            folder = shared_folder(spark, name)
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs

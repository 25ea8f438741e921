import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators give to columns of their own, or gave once.
OWN_NAMES = (
    "key", "class", "n", "size", "shard", "bucket", "draw", "record", "records", "rows", "lines", "line", "covered", "removed", "file",
    "part", "score", "kind", "ids", "id", "row", "pos", "term", "words", "word", "prefix", "phrase", "times", "turn", "of_id", "of_source",
    "of_size", "from", "col", "doc", "component", "chosen", "__row_key", "__covered", "__removed", "__words", "__id", "__times", "__turn",
    "__source", "__size", "__class", "__text")


@pytest.fixture()
def documents(spark):
    """Make a documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(*rows, more: bool = False):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if more:  # names that the operators use themselves, or that differ in case only from theirs
            for name in OWN_NAMES:
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

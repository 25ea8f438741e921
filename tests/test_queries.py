"""Every registered query against its SQL, at the smallest scale, value by value."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.conftest import DATA, plan_of

QUERIES = {name: run for name, run in entry_points.queries().items() if name.startswith("q_")}
SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name.startswith("q_")}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    assert len(got) == len(want)
    assert [tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r) for r in got] == [
        tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r) for r in want
    ]


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "sentiment_label" in df.columns


def test_whole_file_path_has_no_shuffle_beyond_the_spread(spark, small):
    plan = plan_of(QUERIES["q_chunk_records"](spark, small))
    assert plan.count("Exchange") == 1 and "RoundRobinPartitioning" in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_large_tables_are_not_spread(spark):
    from tonegrain.sources.tables import spread

    df = spark.range(0, 1000, 1, 64)
    assert spread(df) is df


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["q_stats_by_batch"](spark, f"{DATA}/sf0.001"))
    assert "value:double" not in plan and "props" not in plan


@pytest.mark.parametrize("name", ["q_search_label", "q_search_score_range", "q_search_combined"])
def test_filters_on_scores_do_not_score_again(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    assert plan.count("aggregate(") == 1
    assert "aggregate(" not in plan[plan.index("Exchange"):]

"""Every registered query against its SQL on the same tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from workloads.oracles import ORACLES
from workloads.queries import QUERIES
from workloads.views import view


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    assert got
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, got) == canonical(columns, found.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_answers_use_all_of_benchmark(spark):
    big = "/root/testdata/sf0.1"
    items = spark.read.parquet(f"{big}/benchmark.parquet").count()
    assert view(spark, big, "v_answers").select("item_id").distinct().count() == items


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "question" in df.columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.mark.parametrize(
    "name,most",
    [
        ("consecutive_segments", 1),  # spreading of long videos, empty otherwise
        ("placeholder_pairs", 1),
        ("validated_pairs", 1),
        ("timecodes", 0),
        ("video_paths", 0),
        ("probe_metadata", 0),
        ("youtube_ids", 0),
        ("packed_captions", 1),
        ("expanded_splits", 0),
        ("ratio_split", 0),
        ("analyze_dataset", 0),
    ],
)
def test_shuffle_budget(spark, sf_dir, name, most):
    assert shuffles(QUERIES[name](spark, sf_dir)) <= most


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if "stream" in n}))
def test_no_forbidden_operators(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "BatchEvalPython" not in text  # no row-at-a-time functions
    assert "FlatMapGroupsInPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_needed_columns_only(spark, sf_dir):
    text = plan(QUERIES["consecutive_segments"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in text
    text = plan(QUERIES["ratio_split"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint>" in text


def test_costly_parts_are_planned_once(spark, sf_dir):
    # one similarity for the score and one for each flag
    assert plan(QUERIES["min_confidence"](spark, sf_dir)).count("array_intersect") <= 3
    # the tables of the view, the videos twice: nothing for the pairs' total
    pairs_scans = plan(QUERIES["flat_pairs"](spark, sf_dir)).count("FileScan")
    assert plan(QUERIES["dataset_info"](spark, sf_dir)).count("FileScan") <= pairs_scans + 2

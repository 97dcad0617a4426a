"""Registered queries: SQL equivalents, the pipeline, and how operators reach task code."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from segqa.llm.queries import ORACLES, QUERIES

REPO = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    con = duckdb.connect()
    con.execute(f"create view documents as from read_parquet('{sf_dir}/documents.parquet')")
    expected = con.execute(ORACLES[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = [sorted(map(str, t[columns].itertuples(index=False, name=None))) for t in (found, expected)]
    assert rows[0] == rows[1]


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_stages_follow_each_other(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.count())
        assert k == 4 or docs.columns == columns
    assert counts[1] == counts[2] >= counts[3] and 0 < counts[4] <= counts[5]


def test_pipeline_over_awkward_rows(spark, awkward):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() > 0


def test_rest_works_without_the_corpus_part(tmp_path):
    copy = tmp_path / "repo"
    copy.mkdir()
    for path in REPO.rglob("*.py"):
        rel = path.relative_to(REPO)
        if "llm" not in rel.parts and rel.name != "corpus_pipeline.py":
            (copy / rel).parent.mkdir(parents=True, exist_ok=True)
            (copy / rel).write_text(path.read_text())
    code = "import __spark_entry__ as e; n = e.queries(); assert n and 'pipeline' not in n"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={"PATH": "/usr/bin"})

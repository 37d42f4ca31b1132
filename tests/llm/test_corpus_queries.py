"""Registered queries against DuckDB, and the pipeline against its stages' definitions."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from panelkit.llm import exact_dedup, near_dedup, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(queries.SQL[name])
    found = queries.QUERIES[name](spark, SMALL).select(*want.columns)
    assert sorted(map(tuple, found.collect())) == sorted(want.fetchall())


def test_all_thirteen_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = queries.documents(spark, SMALL)
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == columns, name
        assert 0 < kept.count() <= before
        docs, before = kept, kept.count()
    assert exact_dedup.exact_groups(docs).filter("not kept").count() == 0
    assert near_dedup.near_duplicates(docs).filter("not kept").count() == 0
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}


def test_dedup_stages_judge_rows_not_ids(spark):
    words = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "end"]), " ".join(reversed(words))
    rows = [(5, text), (5, text), (5, text), (9, text), (None, text), (None, near), (7, near), (None, other), (None, other), (8, "one")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string").repartition(3)
    exact = corpus_pipeline.drop_exact_copies(spark, docs, SMALL)
    assert exact.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in exact.collect()), key=str) == sorted([(5, text), (7, near), (None, other), (8, "one")], key=str)
    left = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert sorted(((r[0], r[1]) for r in left.collect()), key=str) == sorted([(5, text), (None, other), (8, "one")], key=str)

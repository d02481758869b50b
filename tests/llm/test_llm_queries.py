"""Registered queries of the text operators, and the pipeline."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from oracle_compare import compare, duck
from tablelearn.llm.queries import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(LARGER)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_duckdb(spark, con, name):
    assert not compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], LARGER)


@pytest.mark.parametrize("name", ["op5_quality_rules", "op10_line_dedup"])
def test_main_path_is_native(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "InArrow") if w in plan]


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SMALL), "test-stage")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert rows > counts[0] >= counts[2] > 0 and counts[1] == counts[0]
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(docs.columns)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SMALL), "test-empty")
    assert docs.count() == 0


def test_pipeline_on_odd_rows(spark, odd):
    """Nulls, empty and long texts, repeated rows and clashing names go through all stages."""
    docs, counts = odd, [odd.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SMALL), "test-odd")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == odd.columns
    assert counts[0] >= counts[1] == counts[2] >= counts[3] > 0
    pieces = {}
    for r in docs.collect():
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in pieces.values():
        rows.sort()
        assert rows[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:])) and sum(n for _, n in rows) <= 1024

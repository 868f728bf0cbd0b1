"""Registered queries against their SQL, and the pipeline, over whole given tables."""

import glob
import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.common import edge_rows, prose, table
from tests.llm.test_near_dedup import naive, shingles
from tierline.llm import quality_rules
from tierline.llm.common import stored
from tierline.llm.queries import QUERIES, trusted_ids
from tierline.llm.sql import STATEMENTS

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def test_queries_are_registered():
    found = entry_points.queries()
    for n in range(1, 14):
        assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert set(STATEMENTS) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    expected = duck.execute(STATEMENTS[name])
    columns = sorted(c[0] for c in expected.description)
    order = [[c[0] for c in expected.description].index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in expected.fetchall())
    result = QUERIES[name](spark, SF)
    assert sorted(result.columns) == columns
    assert Counter(tuple(r[c] for c in columns) for r in result.collect()) == want


def checked_stages(spark, docs, sf_dir):
    """Runs the stages and holds each against brute force; the last result."""
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        after = docs.collect()
        if name != "pack":
            assert docs.columns == columns
        if name == "quality":
            judged = quality_rules.quality(
                spark.createDataFrame(before, docs.schema).select("doc_id", "text"),
                trusted_ids(spark, sf_dir),
            )
            assert Counter(r.text for r in after) == Counter(
                r.text for r in judged.collect() if r.kept
            )
        if name == "exact":
            same = lambda r: re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
            assert Counter(map(same, after)) == Counter({same(r) for r in before})
        if name == "near":
            left = {r.doc_id: shingles(r.text) for r in after}
            assert len(after) == len(left)
            for i in left:
                for j in left:
                    assert i >= j or not left[i] or naive(left[i], left[j]) < 0.8
            for r in before:
                if r.doc_id not in left:
                    near = (naive(shingles(r.text), shingles(o.text)) for o in before if o != r)
                    assert any(x >= 0.8 - 1e-12 for x in near)
        if name == "mix":
            assert {r for r in after} <= set(before)
            assert max(Counter(after).values(), default=0) <= 2
        if name == "pack":
            ids = Counter(r.doc_id for r in before)
            tokens = {r.doc_id: r.doc_tokens for r in after}
            assert set(tokens) == set(ids)
            assert sum(r.length for r in after) == sum(tokens[i] * n for i, n in ids.items())
    return after


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("n_chars < 4000")
    assert checked_stages(spark, docs, SMALL)


def test_pipeline_stages_stand_edge_rows_and_empty_tables(spark):
    some = [r for r in edge_rows() if r[0] not in (8, 9)] + [(50 + i, prose(i, 40)) for i in range(9)]
    assert checked_stages(spark, table(spark, some), SMALL)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, []), SMALL).count() == 0


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 0
    assert set(found.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}

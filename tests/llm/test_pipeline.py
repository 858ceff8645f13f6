"""The pipeline and the named queries over the small sample tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from clearbook.llm.registry import QUERIES, SQL
from tests.llm.helpers import groups, jaccard, simhash, words

SF_DIR = os.environ.get("CLEARBOOK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


def test_entry_points_have_all_queries():
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    if "doc_id" in found and name not in ("op8_passages", "op10_decontaminate"):
        assert sorted(found["doc_id"]) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    if name == "op9_html":
        assert len(found) == spark.read.parquet(f"{SF_DIR}/pages.parquet").count() and (found["n_chars"] > 0).all()


def test_stages_on_the_sample(spark):
    tables = {name: spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "benchmark", "labels")}
    docs = tables["documents"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SF_DIR)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        after = {r.doc_id: r for r in rows}
        assert after.keys() <= before.keys()
        seen.append(name)
        if name == "quality":
            marks = {r.doc_id: r.quality for r in tables["labels"].collect()}
            kept = [i in after for i in before if marks.get(i) == 1]
            lost = [i not in after for i in before if marks.get(i) == 0]
            assert sum(kept) >= 0.95 * len(kept) and sum(lost) >= 0.6 * len(lost)
        if name == "near_copies":
            codes = {i: simhash(t) for i, t in before.items()}
            near = groups(codes, lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 6)
            assert after.keys() == set(groups(codes, lambda a, b: near[a] == near[b] and jaccard(before[a], before[b]) >= 0.8).values())
        if name == "passages":
            assert after.keys() == before.keys()
            windows = {}
            for i, row in sorted(after.items()):
                own = words(row.text)
                for at in range(len(own) - 50):
                    assert windows.setdefault(tuple(own[at : at + 51]), i) == i
        if name == "benchmark":
            items = [" ".join(r.text.lower().split()) for r in tables["benchmark"].collect()]
            texts = {i: " ".join(t.lower().split()) for i, t in before.items()}
            leaking = {i for i, t in texts.items() if any(item in t for item in items)}
            assert not leaking & after.keys() and len(after) >= len(before) - 2 * len(leaking) - 2
        if name == "mixing":
            assert all(0 < r.taken <= 3 * r.size for r in rows)
        else:
            assert docs.columns == tables["documents"].columns
    assert len(seen) == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    found = QUERIES[name](spark, SF_DIR)
    connection = duckdb.connect()
    for table in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    relation = connection.sql(SQL[name])
    assert sorted(relation.columns) == sorted(found.columns)
    columns = ", ".join(found.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(relation.project(columns).fetchall(), key=str)

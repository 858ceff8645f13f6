"""Every registered query against its SQL in DuckDB, over the whole small sample tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from clearbook.registry import load

SF_DIR = os.environ.get("CLEARBOOK_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def ordered(rows):
    return sorted(([plain(v) for v in row] for row in rows), key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(load()[0]) == set(load()[1])
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(load()[0]))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == types
    got = ordered(df.select(columns).collect())
    expected = ordered(relation.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert got == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "delivery_date" and not df.isEmpty()


def test_settlement_totals(spark):
    """Totals worked out independently for the stand-in tables at the next larger size."""
    larger = SF_DIR.replace("sf0.001", "sf0.01")
    if not os.path.isdir(larger) or larger == SF_DIR:
        pytest.skip("larger sample tables not present")
    final = entry_points.queries()["classic_final"](spark, larger)
    totals = {
        row.source_type: row
        for row in final.groupBy("source_type")
        .agg({"*": "count", "mark_price": "count", "bid_size": "count", "offer_size": "count", "bid_price": "count",
              "offer_price": "count", "settlement_price": "sum"})
        .collect()
    }
    bid, offer = totals["Bid"], totals["Offer"]
    assert (bid["count(1)"], bid["count(mark_price)"], bid["count(bid_price)"], bid["count(bid_size)"]) == (33854, 31169, 17016, 19785)
    assert (offer["count(1)"], offer["count(mark_price)"], offer["count(offer_price)"], offer["count(offer_size)"]) == (
        25261, 23333, 12581, 14573
    )
    assert round(bid["sum(settlement_price)"], 2) == 14509337.1
    assert round(offer["sum(settlement_price)"], 2) == 10355773.43

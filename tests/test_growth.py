"""Steps whose cost must not be paid once more for every record, or for every pass."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clearbook.operators import skew
from clearbook.plans.backfill import store_batch
from clearbook.registry.reporting import day_files
from clearbook.sources import delimited, tables
from clearbook.streaming import ingest
from tests.market import award, market, order, price

HEADER = "Delivery Date,Hour Ending,Settlement Point,QSE Name,Energy Only Bid Award in MW,Settlement Point Price,Bid ID"


def test_headers_are_compared_once_per_file(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text(
        f"{HEADER}\n2024-01-01,1,HB,QA,1,1,a\n{HEADER.lower()}\n,1,HB,QA,1,1,b\n"
        f"{HEADER.upper().replace(' ', '_')}\nDelivery Date,1,HB,QA,1,1,c\n--,1,HB,QA,1,1,d\n"
    )
    (tmp_path / "b.csv").write_text(" ,Bid ID,QSE Name\n,x,QB\n-,bid id,qse_name\n,bid id,qse_name\nBid ID,QSE Name,\n*,Bid ID,QSE\n")
    scanned = delimited.scan_by_header(spark, str(tmp_path), "bid_awards")
    kept = [("a", "QA"), ("b", "QA"), ("c", "QA"), ("d", "QA"), ("x", "QB"), ("Bid ID", "QSE")]
    assert rows(scanned, "order_id", "qse_name") == sorted(kept)
    joined = [line for line in scanned._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert len(joined) == 1 and "header" not in joined[0]


def sample(spark, folder):
    """A few lines and events of every point, and the nations that name the tracked participants."""
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    made = [(i, 3 * i, i % 45, 1 + i % 2, 2.0, 10.0 + i, 0.0, 0.0) for i in range(400)]
    spark.createDataFrame(made, lines).write.parquet(f"{folder}/lineitem.parquet")
    points = ["click", "view", "error", None]
    events = [(i, dt.datetime(2024, 1, 1 + i % 20, i % 24, 10), points[i % 4], float(i)) for i in range(200)]
    spark.createDataFrame(events, "event_id long, ts timestamp, event_type string, value double").write.parquet(f"{folder}/events.parquet")
    nations = [(i, i % 3) for i in range(12)]
    spark.createDataFrame(nations, "n_nationkey long, n_regionkey long").write.parquet(f"{folder}/nation.parquet")
    return made, events


def test_award_files_are_read_in_one_pass(spark, rows, tmp_path):
    made, events = sample(spark, tmp_path)
    names, tracked = ["click", "view", "error", "signup", "purchase"], {1, 4, 7, 10}
    kept = [names[s % 5] for _, p, s, n, *_ in made if n % 2 == 1 and s % 20 in tracked and p % 60 and s % 50]
    priced = {name: [v for _, _, point, v in events if point == name] for name in names}
    wanted = [(name, kept.count(name), round(sum(v) / len(v), 7)) for name, v in priced.items() if v and name in kept]
    found = day_files(spark, str(tmp_path))
    assert rows(found) == sorted(wanted) and wanted
    read = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line and " csv" in line]
    assert len(read) == 1


@pytest.mark.parametrize("buckets", [1, 7, skew.BUCKETS])
def test_keys_are_counted_one_by_one_only_where_one_may_be_hot(spark, monkeypatch, buckets):
    counted, count = [], skew._counts
    monkeypatch.setattr(skew, "_counts", lambda df, keys, name: counted.append(df.count()) or count(df, keys, name))
    monkeypatch.setattr(skew, "BUCKETS", buckets)
    cold = spark.range(20_000).select(F.col("id").alias("k"))
    assert skew.hot_keys(cold, ["k"], rows_per_salt=10_001).is_empty
    assert counted == [0]
    hot = cold.unionByName(spark.range(300).select(F.lit(-1).cast("long").alias("k"))).unionByName(spark.range(250).select(F.lit(None).cast("long").alias("k")))
    found = {tuple(row) for row in skew.hot_keys(hot, ["k"], rows_per_salt=100).frame.collect()}
    hashes = spark.createDataFrame([(-1,), (None,)], "k long").select(F.xxhash64("k")).collect()
    assert found == {(hashes[0][0], 3), (hashes[1][0], 3)}


@pytest.mark.parametrize("last, shuffled", [(30, False), (31, True)])
def test_loads_of_few_dates_are_written_where_they_are_made(spark, rows, tmp_path, monkeypatch, last, shuffled):
    database, start = f"growth_{last}", dt.date(2024, 1, 1)
    end = start + dt.timedelta(days=last)
    tables.create_tables(spark, database, str(tmp_path / database))
    source = market(
        spark, bids=[order("b", day=d) for d in (start, end)], bid_awards=[award("b", day=d) for d in (start, end)],
        offers=[order("o", day=d) for d in (start, end)], offer_awards=[award("o", day=d) for d in (start, end)],
        prices=[price(3.0, day=d) for d in (start, end)],
    )
    placed, place = {}, tables._in_table_order

    def noted(df, table, rebalance):
        placed[table.split(".")[1]] = rebalance
        return place(df, table, rebalance)

    monkeypatch.setattr(tables, "_in_table_order", noted)
    for _ in range(2):
        store_batch(source, database, start, end, 0, dt.datetime(2024, 6, 1))
    assert {placed[name] for name in ("bids", "bid_awards", "offers", "offer_awards", "final")} == {shuffled}
    found = rows(spark.table(f"{database}.final"), "delivery_date", "bid_id", "offer_id", "mark_price")
    assert found == sorted([(d, *ids, 3.0) for d in (start, end) for ids in (("b", None), (None, "o"))], key=lambda r: (str(r[0]), r[1] is not None))


@pytest.mark.parametrize("days, files", [(2, 6), (tables.FEW_DATES + 9, tables.FEW_DATES + 9)])
def test_batches_of_few_dates_are_not_shuffled(spark, rows, tmp_path, days, files):
    batch, seen = spark.range(0, 3 * days, 1, 3).selectExpr(
        f"date_add(DATE'2024-01-01', CAST(id % {days} AS INT)) AS delivery_date", "1 AS hour_ending", "'HB' AS settlement_point",
        "'QA' AS qse_name", "1.0D AS award_mw", "2.0D AS award_price", "CAST(id AS STRING) AS order_id",
    ), []
    write = ingest.batch_writer(str(tmp_path), "bid_awards", lambda dates, session: seen.append(dates.count()))
    write(batch, 0)
    assert len(list((tmp_path / "bid_awards" / "batch_id=0").glob("*/part-*.parquet"))) == files
    stored = ingest.read_table(spark, str(tmp_path), "bid_awards")
    assert rows(stored, "delivery_date", "order_id") == rows(batch, "delivery_date", "order_id") and seen == [days]

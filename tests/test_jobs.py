from __future__ import annotations

import datetime as dt
import itertools
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clearbook import schemas, session
from clearbook.operators import conform, filters, joins
from clearbook.operators import prices as price_ops
from clearbook.plans import backfill, monthly, paired, price_load, update
from clearbook.sources import delimited, loads, participants, tables
from clearbook.streaming import ingest
from tests.market import DAY, award, market, order, price
from tests.test_sources import AWARD_HEADER, PRICE_HEADER, write, zipped

NOW = dt.datetime(2024, 6, 1, 12)
_names = itertools.count()


@pytest.fixture
def database(spark):
    name = f"market_{next(_names)}"
    tables.create_tables(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def small(spark):
    return market(
        spark,
        bids=[order("b1", levels=[(1.0, 11.0)])],
        bid_awards=[award("b1")],
        offers=[order("o1", levels=[(1.0, 12.0)])],
        offer_awards=[award("o1")],
        prices=[price(30.0)],
    )


def test_create_append_read(spark, rows, database, small):
    table = f"{database}.bid_awards"
    tables.create_tables(spark, database)
    assert spark.table(table).columns == [*[n for n in schemas.AWARDS.names if n != "delivery_date"], "inserted_at", "delivery_date"]
    tables.append_rows(small.bid_awards, table, NOW)
    tables.append_rows(small.bid_awards, table, NOW)
    assert rows(spark.table(table), "delivery_date", "order_id", "award_mw", "inserted_at") == [(DAY, "b1", 10.0, NOW)] * 2
    tables.overwrite_dates(small.bid_awards, table, NOW)
    other = small.bid_awards.withColumn("delivery_date", F.lit("2024-01-02").cast("date"))
    tables.overwrite_dates(other, table, NOW)
    assert spark.table(table).count() == 2
    assert tables.read_or_empty(spark, f"{database}.nothing", schemas.AWARDS).isEmpty()
    assert tables.read_if_present(spark, f"{database}.nothing") is None


def test_append_several(spark, database, small):
    frames = {"bids": small.bids, "offers": None, "prices": small.prices.limit(0)}
    assert tables.append_tables(frames, database, NOW) == ["bids"]
    assert spark.table(f"{database}.bids").count() == 1


def test_date_filter_prunes_partitions(spark, database, small):
    tables.append_rows(small.bid_awards, f"{database}.bid_awards", NOW)
    plan = spark.table(f"{database}.bid_awards").filter("delivery_date = '2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(delivery_date" in plan


def test_years(spark, rows, tmp_path):
    df = spark.createDataFrame([(dt.date(2023, 5, 1),), (dt.date(2024, 5, 1),)], "delivery_date date")
    for clear in (False, False, True):
        tables.write_by_year(df, str(tmp_path / "years"), clear=clear)
        assert sorted(p.name for p in (tmp_path / "years").glob("year=*")) == ["year=2023", "year=2024"]
    assert spark.read.parquet(str(tmp_path / "years")).count() == 2


def test_price_load(spark, rows, database):
    records = spark.createDataFrame(
        [("2024-07-01", 1, 1, "SP1", "LZ", 20.0, "N", 1), ("2024-07-01", 1, 2, "SP1", "LZ", None, "N", 2),
         ("2024-07-01", 1, 3, "SP1", "LZ", 40.0, "N", 3)],
        "deliveryDate string, deliveryHour int, deliveryInterval int, settlementPointName string, "
        "settlementPointType string, settlementPointPrice double, dstFlag string, seq int",
    )
    table = f"{database}.prices"
    price_load.load_prices(records.limit(0), database, NOW)
    assert spark.table(table).isEmpty()
    price_load.load_prices(records, database, NOW, only_awarded=True)
    assert rows(spark.table(table), "delivery_date", "hour_ending", "interval", "price") == [(dt.date(2024, 7, 1), 1, 1, 30.0)]
    price_load.load_prices(records, database, NOW)
    assert rows(spark.table(table), "interval", "price") == [(1, 30.0)]
    later = records.filter("seq = 3").withColumns({"deliveryInterval": F.lit(4), "settlementPointPrice": F.lit(90.0)})
    other = later.withColumns({"deliveryInterval": F.lit(1), "settlementPointName": F.lit("SP2")})
    price_load.load_prices(later.unionByName(other), database, NOW)
    assert rows(spark.table(table), "settlement_point", "interval", "price") == [("SP1", 1, 50.0), ("SP2", 1, 90.0)]
    undated = records.withColumn("deliveryDate", F.lit(None).cast("string")).unionByName(records)
    for _ in range(2):
        price_load.load_prices(undated, database, NOW)
    assert spark.table(f"{database}.price_intervals").filter("delivery_date is null").count() == 3
    assert spark.table(table).filter("delivery_date is null").isEmpty()
    with pytest.raises(ValueError, match="Missing required fields"):
        price_load.load_prices(records.drop("dstFlag"), database, NOW)


def test_backfill_resumes_and_repeats_nothing(spark, rows, database):
    days = [dt.date(2024, 1, day) for day in (1, 2, 3)]
    lagged = [day - dt.timedelta(days=0) for day in days]
    source = market(
        spark,
        bids=[order("b", day=day, levels=[(1.0, 1.0)]) for day in days],
        bid_awards=[award("b", day=day) for day in days],
        offers=[order("o", day=day, levels=[(1.0, 1.0)]) for day in days],
        offer_awards=[award("o", day=day) for day in days],
        prices=[price(5.0, day=day) for day in lagged],
    )
    assert backfill.backfill(source, database, "2024-01-02", "2024-01-03", 1, 0, NOW) == 2
    assert backfill.backfill(source, database, "2024-01-01", "2024-01-03", 1, 0, NOW) == 1
    assert backfill.backfill(source, database, "2024-01-01", "2024-01-03", 1, 0, NOW) == 0
    final = rows(spark.table(f"{database}.final"), "delivery_date", "source_type", "settlement_price")
    assert final == [(day, side, 5.0) for day in days for side in ("Bid", "Offer")]
    assert spark.table(f"{database}.bids").count() == 3


def test_source_by_cutoff(spark, rows):
    layout = "delivery_date date, s string"
    early, late = dt.date(2024, 1, 9), dt.date(2024, 1, 10)
    archive, current = (spark.createDataFrame([(early, s), (late, s)], layout) for s in ("a", "c"))
    assert rows(backfill.select_source(archive, current, "2024-01-10")) == [(early, "a"), (late, "c")]


OFFER_HEADER = AWARD_HEADER.replace("Bid", "Offer")


def day_bundle(day, text):
    return {
        f"{day}.zip": zipped(
            {
                f"60d_DAM_EnergyBidAwards-{day}.csv": f"{AWARD_HEADER}\n{text},1,HB,QA,5,6,b1\n",
                f"60d_DAM_EnergyBids-{day}.csv": "Delivery Date,Hour Ending,Settlement Point,QSE Name,Energy Only Bid MW1,"
                f"Energy Only Bid Price1,Energy Only Bid ID,Block/Curve indicator\n{text},1,HB,QA,5,7,b1,V\n",
                f"60d_DAM_EnergyOnlyOfferAwards-{day}.csv": f"{OFFER_HEADER}\n{text},1,HB,QA,4,6,o1\n",
                f"60d_DAM_EnergyOnlyOffers-{day}.csv": "Delivery Date,Hour Ending,Settlement Point,QSE Name,"
                f"Energy Only Offer MW1,Energy Only Offer Price1,Energy Only Offer ID\n{text},1,HB,QA,4,8,o1\n",
            }
        )
    }


def test_monthly_load(spark, rows, database, tmp_path):
    prices = "\n".join(f"01/15/2024,1,{i},{point},LZ,{10 * i},N" for i in (1, 2) for point in ("HB", "unused"))
    folder = write(
        tmp_path / "drop",
        {
            "dam.zip": zipped(day_bundle("15-JAN-24", "01/15/2024")),
            "spp.zip": zipped({"spp.zip": zipped({"cdr_SPP.csv": f"{PRICE_HEADER}\n{prices}\n"})}),
        },
    )
    files = spark.createDataFrame(
        [
            ("DAM", "d1", "2024-03-20T00", "DAM 2024-03", f"{folder}/dam.zip"),
            ("DAM", "d0", "2024-05-20T00", "DAM 2024-05", f"{folder}/dam.zip"),
            ("SPP", "s1", "2024-01-31T00", "SPP 2024-01", f"{folder}/spp.zip"),
        ],
        "product string, doc_id string, post_datetime string, friendly_name string, path string",
    )
    run = (spark, files, database, str(tmp_path / "out"), "2024-01-15", "2024-01-20", 60, NOW)
    written = monthly.load_months(*run)
    assert rows(spark.table(f"{database}.prices"), "settlement_point", "hour_ending", "price") == [
        ("HB", 1, 15.0), ("unused", 1, 15.0)
    ]
    final = spark.read.parquet(written["final"])
    assert rows(final, "bid_id", "offer_id", "bid_price1", "offer_mw1", "bid_block_curve", "market_price") == [
        ("b1", "o1", 7.0, 4.0, True, 15.0)
    ]
    assert rows(spark.table(f"{database}.ledger"), "product", "month", "doc_id") == [("DAM", "2024-03", "d1"), ("SPP", "2024-01", "s1")]
    assert monthly.load_months(*run) == {}
    assert spark.table(f"{database}.bids").count() == 1
    published = conform.publish(final, schemas.PAIRED_NAMES["final"])
    assert "MULTIHOURBLOCK_OFFER" in published.columns and published.columns[-2:] == ["DSTFLAG", "INSERTEDAT"]


def test_two_months_settle_from_what_is_stored(spark, rows, database, tmp_path):
    """Prices recorded with an earlier month, and prices that come after the awards, settle like any other."""

    def price_zip(day):
        return zipped({"spp.zip": zipped({"cdr_SPP.csv": f"{PRICE_HEADER}\n{day},1,1,HB,LZ,10,N\n"})})

    folder = write(
        tmp_path / "drop",
        {
            "jan.zip": zipped(day_bundle("15-JAN-24", "01/15/2024")),
            "feb.zip": zipped(day_bundle("15-FEB-24", "02/15/2024") | {"bad.zip": b"PK damaged"}),
            "mar.zip": zipped(day_bundle("15-MAR-24", "03/15/2024")),
            "spp1.zip": price_zip("01/15/2024"), "spp2.zip": price_zip("02/15/2024"), "spp3.zip": price_zip("03/15/2024"),
        },
    )
    listed = [
        ("DAM", "d1", "2024-03-20T00", "a", f"{folder}/jan.zip"), ("DAM", "d2", "2024-04-20T00", "b", f"{folder}/feb.zip"),
        ("DAM", "d3", "2024-05-20T00", "c", f"{folder}/mar.zip"),
        ("SPP", "s1", "2024-01-31T00", "e", f"{folder}/spp1.zip"), ("SPP", "s2", "2024-02-27T00", "f", f"{folder}/spp2.zip"),
        ("SPP", "s3", "2024-03-28T00", "g", f"{folder}/spp3.zip"),
    ]
    layout = "product string, doc_id string, post_datetime string, friendly_name string, path string"

    def load(known, start, end):
        files = spark.createDataFrame(known, layout)
        return monthly.load_months(spark, files, database, str(tmp_path / "out"), start, end, 60, NOW)

    final = lambda: rows(spark.read.parquet(str(tmp_path / "out/final")), "delivery_date", "market_price")
    days = [dt.date(2024, month, 15) for month in (1, 2, 3)]
    load(listed[:5], "2024-01-15", "2024-01-20")
    assert final() == [(days[0], 10.0)]
    load(listed[:5], "2024-02-15", "2024-02-20")
    assert final() == [(day, 10.0) for day in days[:2]]
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "out/skipped")).collect()] == ["archive: BadZipFile"]
    load(listed[:5], "2024-03-15", "2024-03-20")
    assert final() == [(day, 10.0) for day in days[:2]]
    load(listed, "2024-03-15", "2024-03-20")
    assert final() == [(day, 10.0) for day in days]
    assert load(listed, "2024-03-15", "2024-03-20") == {}


def test_a_point_awarded_later_keeps_its_price(spark, rows, database, tmp_path):
    """Prices come with the first month for points whose first award comes with the second."""
    text = "\n".join(f"{month}/15/2024,1,1,{point},LZ,{value},N" for month, point, value in (("01", "HB", 10), ("02", "NEW", 20)))
    moved = {name: data for name, data in day_bundle("15-FEB-24", "02/15/2024").items()}
    inner = {
        "60d_DAM_EnergyBidAwards-15-FEB-24.csv": f"{AWARD_HEADER}\n02/15/2024,1,NEW,QA,5,6,b2\n",
        "60d_DAM_EnergyOnlyOfferAwards-15-FEB-24.csv": f"{OFFER_HEADER}\n02/15/2024,1,NEW,QA,4,6,o2\n",
    }
    folder = write(
        tmp_path / "drop",
        {
            "jan.zip": zipped(day_bundle("15-JAN-24", "01/15/2024")),
            "feb.zip": zipped({**moved, "more.zip": zipped(inner)}),
            "spp.zip": zipped({"spp.zip": zipped({"cdr_SPP.csv": f"{PRICE_HEADER}\n{text}\n"})}),
        },
    )
    listed = [
        ("DAM", "d1", "2024-03-20T00", "a", f"{folder}/jan.zip"), ("DAM", "d2", "2024-04-20T00", "b", f"{folder}/feb.zip"),
        ("SPP", "s1", "2024-01-31T00", "e", f"{folder}/spp.zip"),
    ]
    files = spark.createDataFrame(listed, "product string, doc_id string, post_datetime string, friendly_name string, path string")
    for start, end in (("2024-01-15", "2024-01-20"), ("2024-02-15", "2024-02-20")):
        monthly.load_months(spark, files, database, str(tmp_path / "out"), start, end, 60, NOW)
    final = rows(spark.read.parquet(str(tmp_path / "out/final")), "settlement_point", "bid_id", "market_price")
    assert final == [("HB", "b1", 10.0), ("NEW", "b2", 20.0)]


def test_a_load_is_published_once(spark, rows, database, small, monkeypatch):
    """Killed after some files were moved, started again, started twice at once, and started after it was done."""
    built = []

    def build():
        built.append(1)
        record = spark.createDataFrame([("DAM", "2024-03", "d", None, None)], schemas.LEDGER)
        days = small.bids.unionByName(small.bids.withColumn("delivery_date", F.lit("2024-01-02").cast("date")))
        return {"bids": days.drop("seq"), "prices": small.prices, "ledger": record}

    def counts():
        return tuple(spark.table(f"{database}.{name}").count() for name in ("bids", "prices", "ledger"))

    move, moved = loads.Files.move, []

    def killed(self, source, target):
        if len(moved) == 1:
            raise KeyboardInterrupt
        moved.append(source)
        move(self, source, target)

    monkeypatch.setattr(loads.Files, "move", killed)
    with pytest.raises(KeyboardInterrupt):
        loads.publish_once(spark, database, "DAM-2024-03", build, NOW)
    monkeypatch.setattr(loads.Files, "move", move)
    assert len(moved) == 1 and spark.table(f"{database}.ledger").isEmpty()
    assert loads.publish_once(spark, database, "DAM-2024-03", build, NOW) and counts() == (2, 1, 1)
    assert not loads.publish_once(spark, database, "DAM-2024-03", build, NOW) and len(built) == 1
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(loads.publish_once, spark, database, "DAM-2024-04", build, NOW) for _ in range(2)]
        assert all(run.result() in (True, False) for run in runs)
    assert counts() == (4, 2, 2)
    with pytest.raises(ValueError, match="folder name"):
        loads.publish_once(spark, database, "a/b", build, NOW)


def test_an_attempt_that_dies_while_staging_leaves_nothing(spark, database, small):
    broken = small.bids.drop("seq").withColumn("mw1", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        loads.publish_once(spark, database, "x", lambda: {"prices": small.prices, "bids": broken}, NOW)
    assert spark.table(f"{database}.prices").isEmpty()
    assert loads.publish_once(spark, database, "x", lambda: {"prices": small.prices}, NOW)
    assert spark.table(f"{database}.prices").count() == 1


def test_update_is_stored_once(spark, rows, database, small, tmp_path):
    dates = ("2024-01-01", "2024-01-31")
    for _ in range(2):
        update.store_update(small, ["QA"], database, dates, dates, F.col("interval"), NOW)
        written = monthly.settle_stored(spark, database, str(tmp_path / "out"), *dates, NOW)
        counts = {name: spark.table(f"{database}.{name}").count() for name in ("bids", "bid_awards", "prices")}
        assert counts == {"bids": 1, "bid_awards": 1, "prices": 1}
        assert spark.read.parquet(written["final"]).count() == 1


def test_write_paired_appends_every_table(spark, rows, small, tmp_path):
    for run in (1, 2):
        written = paired.write_paired(small, str(tmp_path / "out"), str(tmp_path / f"stage{run}"), ["seq"], ["interval"])
    counts = {name: spark.read.parquet(path).count() for name, path in written.items()}
    assert counts == {"combined_bids": 2, "combined_offers": 2, "merged_pairs": 2, "final": 2}
    assert spark.read.parquet(written["final"]).schema.names[-1] == "delivery_date"


AWARD_NAMES = AWARD_HEADER.split(",")


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None
    query.stop()


def test_stream_takes_each_file_once(spark, rows, tmp_path):
    source = tmp_path / "awards"
    write(source, {"1.csv": f"{AWARD_HEADER}\n2024-01-01,1,HB,QA,1,1,a\n"})
    args = (spark, str(source), AWARD_NAMES, "bid_awards", str(tmp_path / "table"), str(tmp_path / "check"))
    run(ingest.ingest_files(*args))
    (source / "2.csv").write_text(f"{AWARD_HEADER}\n2024-01-02,1,HB,QA,1,1,b\n")
    run(ingest.ingest_files(*args))
    run(ingest.ingest_files(*args))
    stored = spark.read.parquet(str(tmp_path / "table"))
    assert rows(stored, "delivery_date", "order_id") == [(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 2), "b")]


def test_stream_merges_touched_dates(spark, rows, small, tmp_path):
    root = str(tmp_path / "root")
    for name in ("bids", "offers", "offer_awards", "prices"):
        ingest.batch_writer(root, name, lambda dates, session: None)(getattr(small, name).drop("seq"), 0)
    source = tmp_path / "awards"
    write(source, {"1.csv": f"{AWARD_HEADER}\n2024-01-01,1,HB,QA,1,1,b1\n"})
    args = (spark, str(source), AWARD_NAMES, "bid_awards", root, str(tmp_path / "check"))
    run(ingest.ingest_and_merge(*args))
    final = lambda: rows(spark.read.parquet(f"{root}/final"), "source_type", "bid_id", "bid_price", "mark_price")
    assert final() == [("Bid", "b1", 11.0, 30.0), ("Offer", None, None, 30.0)]
    (source / "2.csv").write_text(f"{AWARD_HEADER}\n2024-01-01,1,HB,QA,1,1,b2\n2024-01-09,1,HB,QA,1,1,b3\n")
    run(ingest.ingest_and_merge(*args))
    assert final() == [("Bid", "b1", 11.0, 30.0), ("Bid", "b2", None, 30.0), ("Offer", None, None, 30.0)]


def test_replayed_batch_replaces_itself(spark, rows, small, tmp_path):
    write_batch = ingest.batch_writer(str(tmp_path), "bid_awards", lambda dates, session: None)
    for batch in (0, 0, 1):
        write_batch(small.bid_awards.drop("seq"), batch)
    assert rows(ingest.read_table(spark, str(tmp_path), "bid_awards"), "batch_id", "order_id") == [(0, "b1"), (1, "b1")]
    assert ingest.read_table(spark, str(tmp_path), "offers").isEmpty()


def test_scenario_over_day_files(spark, rows, tmp_path):
    """Day files filtered by a tracking list: kept rows are a subset, and their points have prices."""
    names = ["QA", "QB", "QC"]
    body = "".join(f"2024-01-30,{h},P{i},{q},{i},{20 + i},b{i}{h}\n" for h in (1, 2) for i, q in enumerate(names))
    folder = write(tmp_path / "day", {"60d_DAM_EnergyBidAwards-30-JAN-25.csv": f"{AWARD_HEADER}\n{body}"})
    prices = "".join(f"01/30/2024,1,{i},P{p},RN,{v},N\n" for i, v in ((1, 21.5), (2, 22.32)) for p in (0, 1))
    spp = write(tmp_path / "spp", {"cdr.SPP.csv": f"{PRICE_HEADER}\n{prices}"})
    listing = write(tmp_path / "list", {"list.csv": "SHORT NAME,NAME\nQA,x\n QB ,y\n"})
    tracked = participants.load_short_names(spark, listing)
    awards = conform.conform_table(delimited.scan_by_header(spark, folder, "bid_awards"), "bid_awards")
    kept = filters.keep_qses(awards, tracked)
    assert kept.exceptAll(awards).isEmpty() and kept.count() == 4
    assert kept.select("qse_name").exceptAll(awards.select("qse_name")).isEmpty()
    spot = conform.conform_table(delimited.scan_prices(spark, spp), "prices")
    assert round(price_ops.point_average(spot, "P0").first().avg_price, 2) == 21.91
    overlap = joins.prices_at_points(spot, kept.select("settlement_point"))
    assert rows(overlap.select("settlement_point").distinct()) == [("P0",), ("P1",)]
    assert rows(filters.keep_qses(awards, [])) == []
    assert rows(filters.keep_qses(awards.drop("qse_name"), tracked)) == []


def test_shared_folder():
    """The folder the cluster names counts; only a local session may do without one."""

    def pretend(named, master):
        conf = SimpleNamespace(get=lambda key, default: named if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert session.shared_dir(pretend("/shared/x", "yarn")) == "/shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(pretend(None, "yarn"))
    local = pretend(None, "local[4]")
    assert session.shared_dir(local) == session.shared_dir(local)

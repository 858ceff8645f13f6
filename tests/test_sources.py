from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from clearbook.sources import archives, delimited, listing, zip_source
from clearbook.sources import json_pages as pages
from clearbook.sources.routing import table_for_file


def write(folder, files):
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


PRICE_HEADER = "DeliveryDate,DeliveryHour,DeliveryInterval,SettlementPointName,SettlementPointType,SettlementPointPrice,DSTFlag"


def test_price_files_with_different_headers(spark, rows, tmp_path):
    path = write(
        tmp_path / "spp",
        {
            "a.csv": f"{PRICE_HEADER}\n2024-01-01,1,2,HB,LZ, 5.5 ,N\n2024-01-01,1,3,\"HB,X\",LZ,,N\n",
            "b.csv": " settlement_point_price ,delivery_date, settlementPoint \n7.0,2024-01-02,HC\n",
            "no_comma.csv": "nothing here\n1,2,3\n",
            "bad_utf8.csv": PRICE_HEADER.encode() + b"\n2024-01-01,1,2,H\xff,LZ,5,N\n",
            "empty.csv": "",
        },
    )
    got = rows(delimited.scan_prices(spark, path), "delivery_date", "hour_ending", "settlement_point", "price")
    assert len(got) == 3
    assert set(got) == {
        ("2024-01-01", "1", "HB", "5.5"),
        ("2024-01-01", "1", "HB,X", None),
        ("2024-01-02", None, "HC", "7.0"),
    }


def test_last_of_repeated_headers_wins(spark, rows, tmp_path):
    path = write(tmp_path / "spp", {"a.csv": "settlementpoint,SettlementPointName,price\nA,B,1\nA,,1\n"})
    assert rows(delimited.scan_prices(spark, path), "settlement_point") == [(None,), ("B",)]
    first = delimited.scan_by_header(spark, path, "prices")
    assert rows(first, "settlement_point") == [("A",), ("A",)]


def test_unknown_headers_are_reported(spark, rows, tmp_path):
    path = write(tmp_path / "spp", {"a.csv": "DSTFlag,Note\n1,2\n", "b.csv": "Note,DSTFlag\n1,2\n"})
    headers = delimited.file_headers(delimited.text_lines(spark, path))
    assert rows(delimited.unknown_headers(headers, "prices")) == [("Note", 2)]


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    path = write(tmp_path / "spp", {"a.csv": "DSTFlag,DeliveryHour\n" + "".join(f"N,{i}\n" for i in range(3000))})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scanned = delimited.scan_by_header(spark, path, "prices", multi_line=False)
        assert scanned.rdd.getNumPartitions() > 1
        hours = [int(r.hour_ending) for r in scanned.orderBy("line_order").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert hours == list(range(3000))


def test_uniform_scan(spark, rows, tmp_path):
    path = write(tmp_path / "bids", {"a.csv": "Bid ID,Hour Ending\nx, 1\n", "b.csv": "Bid ID,Hour Ending\ny,\n"})
    assert rows(delimited.scan_uniform(spark, path, "bids")) == [("x", "1"), ("y", None)]
    mixed = write(tmp_path / "mixed", {"a.csv": "Bid ID,Hour Ending\nx,1\n", "b.csv": "Hour Ending,Bid ID\n2,y\n"})
    with pytest.raises(Exception, match="(?i)header"):
        delimited.scan_uniform(spark, mixed, "bids").collect()


def zipped(files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, content in files.items():
            archive.writestr(name, content)
    return buffer.getvalue()


AWARD_HEADER = "Delivery Date,Hour Ending,Settlement Point,QSE Name,Energy Only Bid Award in MW,Settlement Point Price,Bid ID"


def bundle():
    day = zipped(
        {
            "60d_DAM_EnergyBidAwards-01-JAN-24.csv": f"{AWARD_HEADER}\n01/02/2024,1,HB,QA,5,6,b1\n",
            "60d_DAM_EnergyBids-01-JAN-24.csv": "Energy Only Bid ID,Delivery Date,Energy Only Bid MW1\nb1,01/02/2024,5\n",
            "60d_DAM_Other-01-JAN-24.csv": "a,b\n1,2\n",
            "readme.txt": "x",
        }
    )
    deep = zipped({"inner.zip": zipped({"60d_DAM_EnergyBidAwards-02-JAN-24.csv": f"{AWARD_HEADER}\n2024-01-03,2,HB,QA,7,8,b2\n"})})
    bad_text = zipped({"60d_DAM_EnergyBidAwards-03-JAN-24.csv": AWARD_HEADER.encode() + b"\n\xff,1,2,3,4,5,6\n"})
    return zipped({"day1.zip": day, "day2.zip": deep, "broken.zip": b"no zip", "bad.zip": bad_text, "note.txt": "x"})


def test_nested_archives(spark, rows, tmp_path):
    path = write(tmp_path / "zips", {"bundle.zip": bundle(), "corrupt.zip": b"PK\x03\x04 broken"})
    chunks = archives.archive_chunks(spark, path)
    awards = archives.archive_rows(chunks, "bid_awards")
    assert rows(awards, "delivery_date", "award_mw", "order_id", "line_no") == [
        ("01/02/2024", "5", "b1", 1), ("2024-01-03", "7", "b2", 1)
    ]
    assert rows(archives.archive_rows(chunks, "bids"), "order_id", "mw1", "price1") == [("b1", "5", None)]
    assert rows(archives.archive_rows(chunks, "offers")) == []


def test_price_members(spark, rows, tmp_path):
    members = {
        "a.csv": f"{PRICE_HEADER}\n2024-01-01,1,2,HB,LZ,5.5,N\n, ,,,,\"\",\n",
        "b.csv": "SettlementPointName\nHC\n",
        "c.csv": "SettlementPoint,SettlementPointName\nX,Y\n",
        "d.csv": "other,columns\n1,2\n",
    }
    path = write(tmp_path / "zips", {"z.zip": zipped({"in.zip": zipped(members)})})
    prices = archives.archive_rows(archives.archive_chunks(spark, path), "prices", {"": "prices"})
    assert rows(prices, "settlement_point", "price") == [("HB", "5.5"), ("Y", None)]


def test_long_members_come_in_chunks(spark, tmp_path):
    count = zip_source.LINES_PER_CHUNK * 2 + 5
    body = AWARD_HEADER + "\n" + "".join(f"2024-01-01,1,HB,QA,1,1,b{i}\n" for i in range(count))
    path = write(tmp_path / "zips", {"z.zip": zipped({"60d_DAM_EnergyBidAwards-x.csv": body})})
    chunks = archives.archive_chunks(spark, path)
    assert chunks.count() == 3
    got = archives.archive_rows(chunks, "bid_awards").orderBy("line_no").collect()
    assert [(r.line_no, r.order_id) for r in got] == [(i + 1, f"b{i}") for i in range(count)]


def test_one_archive_is_read_by_many_tasks(spark, rows, tmp_path):
    days = {f"day{i}.zip": zipped({f"60d_DAM_EnergyBidAwards-{i}.csv": f"{AWARD_HEADER}\n2024-01-01,{i},HB,QA,1,1,b{i}\n"}) for i in range(1, 8)}
    path = write(tmp_path / "zips", {"month.zip": zipped(days)})
    single, spread = (archives.archive_chunks(spark, path, size) for size in (1 << 20, 1))
    assert (single.rdd.getNumPartitions(), spread.rdd.getNumPartitions()) == (1, 7)
    found = [rows(archives.archive_rows(chunks, "bid_awards"), "member", "order_id") for chunks in (single, spread)]
    assert found[0] == found[1] == [(f"60d_DAM_EnergyBidAwards-{i}.csv", f"b{i}") for i in range(1, 8)]


def read_here(path, size=1 << 20):
    reader = zip_source.ArchiveReader({"paths": json.dumps([f"file://{path}"]), "bytes_per_task": str(size)})
    return [row for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]


def test_large_inner_archives_are_read_as_streams(tmp_path, monkeypatch):
    (tmp_path / "z.zip").write_bytes(bundle())
    whole = read_here(tmp_path / "z.zip")
    monkeypatch.setattr(zip_source, "INNER_IN_MEMORY", 0)
    monkeypatch.setattr(zip_source, "_READ", 7)
    assert read_here(tmp_path / "z.zip", 1) == whole
    assert sorted(row["reason"] for row in whole if row["reason"]) == ["archive: BadZipFile", "text: not UTF-8"]


def test_damage_at_the_end_of_an_entry_leaves_no_rows(tmp_path):
    body = "a,b\n" + "1,2\n" * 9000
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("bad.csv", body)
        archive.writestr("good.csv", "a,b\n3,4\n")
    data = bytearray(buffer.getvalue())
    data[data.index(b"PK", 4) - 2] = ord("9")
    (tmp_path / "z.zip").write_bytes(bytes(data))
    assert [(row["member"], row["rows"], row["reason"]) for row in read_here(tmp_path / "z.zip")] == [
        ("bad.csv", None, "entry: BadZipFile"), ("good.csv", [["3", "4"]], None)
    ]
    (tmp_path / "none.zip").write_bytes(zipped({"note.txt": "x"}))
    assert read_here(tmp_path / "none.zip") == []


def test_routing(spark):
    names = ["60d_DAM_EnergyBidAwards-1.csv", "x60d_DAM_EnergyOnlyOffers-1.csv", "60d_DAM_EnergyBids.csv"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    assert [r[0] for r in df.select(table_for_file(F.col("n"))).collect()] == ["bid_awards", "offers", None]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ([{"a": 1}, {"a": 2}], ["1", "2"]),
        ({"data": [{"a": 1}, [5], 6, None], "_meta": {"totalPages": 2}}, ["1"]),
        ({"a": 7}, ["7"]),
        ({"data": {"x": [{"a": 1}, 3], "y": {"a": 2}, "z": 5}}, ["1", "2"]),
        ({"data": []}, []),
        ({"data": None}, []),
        ("text", []),
        ([], []),
    ],
)
def test_page_shapes(spark, rows, page, expected):
    df = spark.createDataFrame([(json.dumps(page),)], "page string")
    assert [r[0] for r in rows(pages.flatten_pages(df).select(pages.item_field("a")))] == expected


def test_page_files_and_positional_records(spark, rows, tmp_path):
    record = ["2024-01-01", 1, 2, "HB", "LZ", 5.5, "N"]
    path = write(tmp_path / "pages", {"1.json": json.dumps({"data": [record]}), "2.json": json.dumps([record[:4]]), "3.json": "{"})
    items = pages.flatten_pages(pages.read_pages(spark, path), keep="lists")
    got = rows(pages.positional_rows(items, pages.PRICE_FIELDS))
    assert got == [("2024-01-01", "1", "2", "HB", None, None, None), ("2024-01-01", "1", "2", "HB", "LZ", "5.5", "N")]
    objects = pages.flatten_pages(spark.createDataFrame([('[{"a": 1, "b": "x"}]',)], "page string"))
    assert rows(pages.object_rows(objects, ["b", "c", "a"])) == [("x", None, "1")]


@pytest.fixture
def files(spark):
    return spark.createDataFrame(
        [
            ("DAM", "1", "2024-01-05T00", "B 2023-12", 1),
            ("DAM", "2", "2024-02-05T00", "B 2024-01", 2),
            ("DAM", "3", "2024-02-09T00", "B 2024-01 2024-02", 3),
        ],
        "product string, doc_id string, post_datetime string, friendly_name string, position int",
    )


def test_file_choice(spark, rows, files):
    months = spark.createDataFrame([("2024-01",), ("2024-02",), ("2030-01",)], "month string")
    assert rows(listing.files_posted_in(files, months), "month", "doc_id") == [("2024-01", "1"), ("2024-02", "2"), ("2024-02", "3")]
    assert rows(listing.first_posted_in(files, months, "position"), "month", "doc_id") == [("2024-01", "1"), ("2024-02", "2")]
    assert rows(listing.named_or_first(files, months, "position"), "month", "exact", "doc_id") == [
        ("2024-01", True, "2"), ("2024-02", True, "3"), ("2030-01", False, "1")
    ]


def test_ledger(spark, rows, files):
    ledger = spark.createDataFrame(
        [("DAM", "2024-01", "1", None, None), ("SPP", "2024-02", "9", None, None)],
        "product string, month string, doc_id string, post_datetime string, friendly_name string",
    )
    candidates = files.withColumn("month", F.substring("post_datetime", 1, 7))
    assert rows(listing.new_entries(candidates, ledger, "position"), "month", "doc_id") == [("2024-02", "2")]
    other = candidates.withColumn("doc_id", F.concat(F.lit("n"), "doc_id"))
    assert rows(listing.conflicting_entries(candidates, ledger), "doc_id") == []
    assert rows(listing.conflicting_entries(other, ledger), "doc_id", "known_doc_id") == [("n1", "1")]
    assert rows(listing.recorded_file(ledger, "DAM", "2024-01"), "doc_id") == [("1",)]

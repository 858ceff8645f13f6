"""Files of the months that have orders."""

from __future__ import annotations

import datetime as dt

from clearbook.registry.storage import files_by_month


def test_files_of_all_months_with_orders(spark, tmp_path):
    documents = spark.createDataFrame([(0, "en", "web"), (40, "en", "web"), (890, "en", "web")], "doc_id long, lang string, source string")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    orders = spark.createDataFrame([(1, dt.datetime(1995, 1, 9)), (2, dt.datetime(1997, 6, 1))], "o_orderkey long, o_orderdate timestamp")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = files_by_month(spark, str(tmp_path)).select("month", "doc_id").collect()
    assert sorted(map(tuple, found)) == [("1995-01", "0"), ("1997-06", "890")]

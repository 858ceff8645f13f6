from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clearbook.operators import sketches
from clearbook.streaming import hourly


def test_merged_sketches_equal_one_over_all(spark):
    rows = [(i % 7, f"v{i % 900}" if i % 10 else None, None) for i in range(4000)]
    df = spark.createDataFrame(rows, "a int, `b.c` string, d double")
    names = df.columns
    parts = [sketches.column_sketches(df.filter(F.col("a") % 3 == n), names) for n in range(3)]
    merged = sketches.merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    merged = sketches.merged_sketches(merged)
    profile = {r.column_name: r for r in sketches.sketched_profile(merged, 2).collect()}
    whole = {r.column_name: r for r in sketches.sketched_profile(sketches.column_sketches(df, names), 2).collect()}
    assert profile.keys() == set(names)
    for name, exact, missing in (("a", 7, 0), ("b.c", len({r[1] for r in rows} - {None}), 400), ("d", 0, 4000)):
        assert abs(profile[name].n_distinct - exact) <= sketches.BOUND * exact
        assert profile[name].n_distinct == whole[name].n_distinct
        assert (profile[name].n_rows, profile[name].n_missing) == (4000, missing)
    assert [c["count"] for c in profile["a"].most_frequent] == [572, 572]
    empty = sketches.sketched_profile(sketches.column_sketches(df.limit(0), ["a"])).first()
    assert (empty.n_rows, empty.n_distinct) == (0, 0)


def test_hours_are_replaced_and_replays_change_nothing(spark, rows, tmp_path):
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    write = hourly.hour_writer(str(tmp_path / "hours"), str(tmp_path / "stage"))

    def batch(*values):
        return spark.createDataFrame(list(values), hourly.HOURLY)

    write(batch((day, 1, "A", 10.0, 1, 1), (day, 2, "A", 1.0, 1, 1), (other, 1, "A", 5.0, 1, 1)), 0)
    for _ in range(2):
        write(batch((day, 1, "A", 20.0, 1, 2), (day, 1, "B", 7.0, 2, 1)), 1)
    write(batch(), 2)
    assert rows(hourly.read_hourly(spark, str(tmp_path / "hours")), "delivery_date", "hour_ending", "settlement_point", "price") == [
        (day, 1, "A", 20.0), (day, 1, "B", 7.0), (day, 2, "A", 1.0), (other, 1, "A", 5.0)
    ]
    assert hourly.read_hourly(spark, str(tmp_path / "nothing")).isEmpty()


def test_stream_leaves_out_missing_keys_and_values(spark, rows, tmp_path):
    header = ["Delivery Date", "Delivery Hour", "Delivery Interval", "Settlement Point Name", "Settlement Point Type",
              "Settlement Point Price", "DST Flag"]
    lines = ["2024-01-01,1,2,A,LZ,10,N", "2024-01-01,1,1,A,LZ,nan,N", "2024-01-01,1,3,A,LZ,,N", "2024-01-01,,1,A,LZ,9,N",
             ",1,1,A,LZ,9,N", "2024-01-01,1,4,,LZ,9,N"]
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "1.csv").write_text("\n".join([",".join(header), *lines]) + "\n")
    run = hourly.ingest_hourly(spark, str(tmp_path / "drop"), header, str(tmp_path / "hours"), str(tmp_path / "check"))
    run.awaitTermination(120)
    assert run.exception() is None
    assert rows(hourly.read_hourly(spark, str(tmp_path / "hours")), "price", "interval", "n_intervals") == [(10.0, 1, 3)]

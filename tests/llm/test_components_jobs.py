"""Components and written tables run no more jobs than they need: the driver holds plans and metrics of each of them."""

from __future__ import annotations

import uuid

from clearbook.llm.components import components
from clearbook.llm.shared import keep_counted


def jobs_of(spark, work):
    """What ``work`` returns, and the number of Spark jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        found = work()
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stars_need_no_round(spark):
    edges = [(1, n) for n in range(2, 40)] + [(n, -7) for n in range(50, 60)] + [(5, 5), (2, 1)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found, jobs = jobs_of(spark, lambda: components(frame))
    expected = {1: 1, -7: -7} | {n: 1 for n in range(2, 40)} | {n: -7 for n in range(50, 60)}
    assert sorted(map(tuple, found.collect())) == sorted(expected.items())
    assert jobs <= 4


def test_chains_and_rings_end_as_stars(spark):
    edges = [(n, n + 1) for n in range(1, 4)] + [(9, 8), (10, 8), (10, 9)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = components(frame)
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8), (10, 8)]


def test_no_edges(spark):
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_are_counted_while_written(spark):
    frame = spark.range(1000).repartition(7)
    (table, count), jobs = jobs_of(spark, lambda: keep_counted(frame, "counted", frame["id"] % 10 == 0))
    assert (table.count(), count) == (1000, 100)
    (empty, none), _ = jobs_of(spark, lambda: keep_counted(frame.where("id < 0").groupBy("id").count(), "counted"))
    assert (empty.count(), none) == (0, 0)
    assert jobs <= 2

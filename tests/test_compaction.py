from __future__ import annotations

import datetime as dt

import pytest

from clearbook.sources import loads
from clearbook.streaming import compaction, ingest
from tests.market import award, market


def batch(spark, number):
    days = [dt.date(2024, 1, 1 + number % 3), dt.date(2024, 1, 10)] + ([None] if number == 2 else [])
    return market(spark, bid_awards=[award(f"b{number}", day=day) for day in days]).bid_awards.drop("seq")


def stored(spark, root):
    rows = ingest.read_table(spark, root, "bid_awards").select("batch_id", "delivery_date", "order_id").collect()
    return sorted(((r.batch_id, r.delivery_date, r.order_id) for r in rows), key=str)


def wanted(spark, numbers):
    return sorted(((n, r.delivery_date, r.order_id) for n in numbers for r in batch(spark, n).collect()), key=str)


def test_folders_do_not_grow_with_batches(spark, tmp_path):
    root, seen = str(tmp_path), []
    write = ingest.batch_writer(root, "bid_awards", lambda dates, session: seen.append(sorted(map(str, (r[0] for r in dates.collect())))), 3)
    for number in range(11):
        for _ in range(1 + number % 2):
            write(batch(spark, number), number)
        assert len(list((tmp_path / "bid_awards").glob("batch_id=*"))) <= 3
    assert stored(spark, root) == wanted(spark, range(11))
    assert compaction.manifest(spark, root, "bid_awards").last == 8
    versions = list((tmp_path / "_merged" / "bid_awards").glob("version=*"))
    assert {int(v.name[8:]) for v in versions} == set(compaction.manifest(spark, root, "bid_awards").dates.values())
    # A batch that is merged already is not stored again.
    write(batch(spark, 2), 2)
    assert stored(spark, root) == wanted(spark, range(11))
    assert seen[3] == ["2024-01-03", "2024-01-10", "None"]


@pytest.mark.parametrize("step", ["mark", "remove"])
def test_a_killed_merge_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    write = ingest.batch_writer(root, "bid_awards", lambda dates, session: None, 3)
    for number in range(3):
        write(batch(spark, number), number)

    def killed(*_):
        raise KeyboardInterrupt

    kept = getattr(loads.Files, step)
    monkeypatch.setattr(loads.Files, step, killed)
    with pytest.raises(KeyboardInterrupt):
        write(batch(spark, 3), 3)
    monkeypatch.setattr(loads.Files, step, kept)
    assert stored(spark, root) == wanted(spark, range(3))
    for number in range(3, 8):
        write(batch(spark, number), number)
    assert stored(spark, root) == wanted(spark, range(8))
    assert len(list((tmp_path / "bid_awards").glob("batch_id=*"))) <= 3

"""Epoch tables: replays, compactions that fail at any point, files that do not pile up."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weatherloom.sinks import commits, storage
from weatherloom.sinks.epochs import EpochTable


def rows(spark, epoch, months=("2401", "2402"), n=5):
    made = [(epoch * 100 + i, f"m{months[(epoch + i) % len(months)]}") for i in range(n)]
    return spark.createDataFrame(made, "id long, month string")


def ids(spark, table):
    return sorted(r.id for r in table.read(spark).collect())


@pytest.fixture
def table(tmp_path):
    return EpochTable(str(tmp_path / "t"), "month", order=("id",))


def test_a_repeated_epoch_replaces_itself(spark, table):
    assert table.read(spark) is None and table.compact(spark) == 0
    table.write(rows(spark, 0), "s", 0)
    table.write(rows(spark, 1), "s", 1)
    table.write(rows(spark, 1, months=("2403",)), "s", 1)  # again, in other months
    table.write(rows(spark, 1, months=("2403",)), "a=b/c:d", 1)  # another stream, with an awkward name
    table.write(rows(spark, 2, months=("2403",)), "a=b/c:d", 1)
    assert ids(spark, table) == [0, 1, 2, 3, 4, 100, 101, 102, 103, 104, 200, 201, 202, 203, 204]
    assert table.read(spark).filter("month = 'm2403'").count() == 10


@pytest.mark.parametrize("fails", ["write", "sweep", "half a sweep"])
def test_a_failed_compaction_changes_nothing(spark, table, monkeypatch, fails):
    for epoch in range(4):
        table.write(rows(spark, epoch), "s", epoch)
    before = ids(spark, table)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if fails == "write":  # some files are there, no commit
            m.setattr(commits, "commit", lost)
        elif fails == "half a sweep":
            removed, keep = [], storage.remove
            m.setattr(storage, "remove", lambda spark, path: (removed.append(path) or keep(spark, path)) if len(removed) < 5 else lost())
        else:
            m.setattr(EpochTable, "_sweep", lost)
        with pytest.raises(RuntimeError):
            table.compact(spark)
    assert ids(spark, table) == before
    table.compact(spark)
    assert ids(spark, table) == before and len(table._epochs(spark, {})) <= 2
    assert table.compact(spark, all_epochs=True) == 1 and table.compact(spark) == 0
    assert ids(spark, table) == before and table._epochs(spark, {}) == []


def test_files_of_a_month_do_not_grow_with_epochs(spark, table, tmp_path):
    for epoch in range(10):
        table.write(rows(spark, epoch), "s", epoch)
        if epoch % 2:
            table.compact(spark, runs=3)
    assert ids(spark, table) == sorted(e * 100 + i for e in range(10) for i in range(5))
    for month in ("m2401", "m2402"):
        assert len(list(tmp_path.glob(f"t/closed/month={month}/run=*"))) <= 4
    assert table.unsettled(spark) <= {"m2401", "m2402"}
    pruned = table.read(spark, {"m2402"})
    assert all("month=m2402" in f for f in pruned.inputFiles()) and pruned.count() == 25


def test_parts_are_folded(spark, tmp_path):
    table = EpochTable(str(tmp_path / "f"), "day", fold=lambda parts: parts.groupBy("day", "key").agg(F.sum("n").alias("n")))
    for epoch in range(5):
        table.write(spark.createDataFrame([("d1", "x", 1), ("d1", "y", 2), (None, "x", 4)], "day string, key string, n long"), "s", epoch)
        table.compact(spark)
    table.compact(spark, all_epochs=True)
    assert sorted((tuple(r) for r in table.read(spark).select("day", "key", "n").collect()), key=repr) == [("d1", "x", 5), ("d1", "y", 10), (None, "x", 20)]
    assert table.unsettled(spark) == set()

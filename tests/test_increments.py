"""Cleaning by increments against the chain over all bronze at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weatherloom.catalog.readings import as_source, readings
from weatherloom.plans import cleaning, increments, jobs
from weatherloom.sinks import audit, lake


@pytest.fixture
def store(tmp_path):
    return lake.Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return readings(spark, sf_dir).transform(as_source).persist()


def rounded(df):
    columns = sorted(df.columns)
    shown = [F.round(c, 6).alias(c) if t in ("double", "float") else F.col(c) for c, t in sorted(df.select(columns).dtypes)]
    return sorted((tuple(r) for r in df.select(*shown).collect()), key=repr)


def same_as_at_once(spark, store):
    want = cleaning.by_sigma(lake.read_bronze(spark, store))
    got = increments.silver(spark, store)
    assert got.schema.names == want.schema.names and rounded(got) == rounded(want)
    return got.count()


def test_any_number_of_increments(spark, source, store):
    for up_to in (1, 2, 400, 1000):
        lake.append_increment(source.filter(F.col("id") <= up_to), store)
        increments.clean(spark, store)
        same_as_at_once(spark, store)
    before = increments.state_of(spark, store)
    assert increments.clean(spark, store) == before.state and increments.state_of(spark, store).sequence == before.sequence
    assert before.state["parts"] == 4 and before.state["rows_in"] == 1000


def shifted(df, first, last, factor, offset):
    t = F.when(F.col("id").between(first, last), F.col("temperature") * factor + offset).otherwise(F.col("temperature"))
    return df.withColumn("temperature", t)


def test_outliers_that_later_bounds_take_in_or_leave_out(spark, source, store):
    calm = shifted(source, 1, 1000, 0.01, 20.0).withColumn("temperature", F.when(F.col("id") % 97 == 0, 900.0).otherwise(F.col("temperature")))
    wide = shifted(calm, 301, 600, 0.0, 400.0)  # takes the outliers in
    narrow = shifted(wide, 601, 1000, 0.0, 20.1)
    kept = []
    for up_to in (300, 600, 1000):
        lake.append_increment(narrow.filter(F.col("id") <= up_to), store)
        increments.clean(spark, store)
        kept.append(same_as_at_once(spark, store))
    assert kept[0] < 300 and kept[-1] > kept[0]


def test_bounds_that_move_into_the_core(spark, source, store):
    few = shifted(source, 1, 20, 30.0, 0.0)  # wide at first
    many = shifted(few, 21, 1000, 0.0001, 20.0)
    for up_to in (20, 500, 1000):
        lake.append_increment(many.filter(F.col("id") <= up_to), store)
        increments.clean(spark, store)
        same_as_at_once(spark, store)
    assert increments.state_of(spark, store).state["split"] > 0


def test_no_spread_and_no_temperature(spark, source, store):
    flat = source.withColumn("temperature", F.when(F.col("id") <= 50, None).when(F.col("id") <= 100, 5.0).otherwise(F.col("temperature")))
    for up_to in (50, 100, 1000):
        lake.append_increment(flat.filter(F.col("id") <= up_to), store)
        increments.clean(spark, store)
        same_as_at_once(spark, store)


def test_a_first_load_begins_silver_anew(spark, source, store):
    lake.append_increment(source.filter("id <= 600"), store, "a")
    lake.append_increment(source.filter("id <= 300"), store, "b")
    increments.clean(spark, store)
    lake.initial_load(source.filter("id <= 200"), store, "a")
    increments.clean(spark, store)
    assert same_as_at_once(spark, store) <= 500
    assert increments.release(spark, store) and increments.release(spark, store) == []
    lake.append_increment(source, store, "a")
    increments.clean(spark, store)
    assert 1200 < same_as_at_once(spark, store) <= 1300


def test_a_late_column_and_copies(spark, source, store):
    lake.append_increment(source.filter("id <= 400").drop("pm25"), store)
    increments.clean(spark, store)
    lake.append_increment(source.unionByName(source.filter("id % 2 = 0")), store)
    increments.clean(spark, store)
    same_as_at_once(spark, store)


def test_an_increment_reads_its_own_batch(spark, source, store):
    lake.append_increment(source.filter("id <= 600"), store)
    increments.clean(spark, store)
    lake.append_increment(source, store)
    batches, seen, anew = lake.batches_after(spark, store, increments.state_of(spark, store).state["seen"])
    assert batches.count() == 400 and not anew and all("from_id=600/" in f for f in batches.inputFiles() if "from_id=0/" not in f)
    assert seen == {"sensor_readings": [0, 1000]}
    plan = batches._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "from_id" in plan


def test_a_run_that_fails_is_repeated(spark, source, store, monkeypatch):
    lake.append_increment(source.filter("id <= 600"), store)
    increments.clean(spark, store)
    before = increments.silver(spark, store).count()
    lake.append_increment(source, store)
    with monkeypatch.context() as m:
        m.setattr(increments, "_split", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            increments.clean(spark, store)
    assert increments.silver(spark, store).count() == before
    increments.clean(spark, store)
    same_as_at_once(spark, store)


def test_jobs_use_it_and_methods_may_change(spark, source, store):
    jobs.initial(source.filter("id <= 600"), store, as_of="2024-01-31")
    jobs.incremental(source, store, as_of="2024-01-31")
    n = same_as_at_once(spark, store)
    log = audit.read(spark, f"{store.audit}/silver").orderBy("records_processed").collect()[-1]
    assert (log.records_processed, log.duplicates_removed, log.outliers_removed) == (n, 0, 1000 - n)
    jobs.incremental(source, store, method="range", as_of="2024-01-31")
    assert "data_quality_score" in jobs.silver_of(spark, store).columns
    jobs.incremental(source, store, as_of="2024-01-31")
    assert same_as_at_once(spark, store) == n

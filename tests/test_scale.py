"""Hot keys, many keys, and the plans that keep them from mattering."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weatherloom.catalog.readings import readings, readings_raw, streamed
from weatherloom.operators import duplicates, filters, groupstats, impute, latest, sensors


@pytest.fixture(scope="module")
def lopsided(spark, sf_dir):
    """A third of all readings from one sensor, some without a sensor."""
    df = readings(spark, sf_dir)
    sensor = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 == 1, None).otherwise(F.col("sensor_id"))
    return df.withColumn("sensor_id", sensor)


@pytest.mark.parametrize("broadcast_keys", [0, 1, 2, 10, 10_000])
def test_attach_gives_the_same_whatever_the_bound(lopsided, as_rows, broadcast_keys):
    stats = lopsided.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("readings"), F.max("temperature").alias("hottest"))
    got = groupstats.attach(lopsided, stats, broadcast_keys=broadcast_keys).select("id", "sensor_id", "hottest")
    want = lopsided.join(stats.drop("readings"), "sensor_id", "left").select("id", "sensor_id", "hottest")
    assert as_rows(got) == as_rows(want)


def test_imputation_and_anomalies_beyond_the_bound(lopsided, as_rows):
    small, large = (impute.median_per_sensor(lopsided, broadcast_keys=n) for n in (3, 10_000))
    assert as_rows(small) == as_rows(large)
    few, many = (sensors.anomaly_rate(lopsided, broadcast_keys=n) for n in (3, 10_000))
    assert as_rows(few) == as_rows(many)


def test_heavy_keys_take_no_part_in_the_shuffle_join(spark, lopsided, plan):
    stats = lopsided.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("readings"), F.max("temperature").alias("hottest"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shape = plan(groupstats.attach(lopsided, stats, broadcast_keys=3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shape.count("SortMergeJoin") == 1
    assert "isnull(_heavy" in shape.replace(" ", "")


def test_no_cross_join_for_statistics(spark, sf_dir, plan):
    df = readings(spark, sf_dir)
    for result in (filters.sigma(df), impute.mean_global(df), impute.median_global(df)):
        shape = plan(result)
        assert "NestedLoopJoin" not in shape and "CartesianProduct" not in shape
        assert "Subquery" in shape


def test_scans_read_only_what_is_needed(spark, sf_dir, plan):
    shape = plan(streamed(spark, sf_dir).agg(F.avg("pm25")))
    assert "ReadSchema: struct<value:double>" in shape


def test_filters_reach_the_scan(spark, sf_dir, plan):
    shape = plan(readings(spark, sf_dir).transform(filters.id_after, 10, up_to=900))
    assert "GreaterThan(event_id,10)" in shape and "LessThanOrEqual(event_id,900)" in shape
    shape = plan(readings(spark, sf_dir).transform(latest.newest_full_rows, 10, "timestamp"))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in shape
    assert "TakeOrderedAndProject" in shape


def test_retention_prunes_partitions(spark, sf_dir, plan, tmp_path):
    dated = streamed(spark, sf_dir).select("id", F.to_date("ingestion_timestamp").alias("ingest_date"))
    dated.write.partitionBy("ingest_date").parquet(f"{tmp_path}/t")
    kept = spark.read.parquet(f"{tmp_path}/t").transform(filters.retained, F.lit("2024-02-14").cast("date"))
    shape = plan(kept)
    assert "PartitionFilters: [isnotnull(ingest_date" in shape
    assert kept.agg(F.min("ingest_date").cast("string")).first()[0] == "2024-01-15"


def test_copies_are_counted_once_across_a_hot_group(spark, sf_dir):
    raw = readings_raw(spark, sf_dir)
    copies = raw.filter("id = 7").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("copy")
    many = raw.unionByName(copies)
    assert duplicates.exact(many).count() == duplicates.exact(raw).count()
    assert duplicates.last_per_key(many).count() == duplicates.last_per_key(raw).count()

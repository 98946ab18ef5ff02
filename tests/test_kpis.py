"""KPI tables on hand-made readings, and relations that must hold between them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.catalog.readings import readings, readings_raw, scored
from weatherloom.functions import times
from weatherloom.operators import combine, kpis, sensors, summary


def test_wide_row_of_seed(seed):
    row = kpis.wide(seed.withColumn("pm25", F.lit(35.4))).first()
    assert (row.total_readings, row.unique_sensors) == (5, 5)
    assert row.temperature_max == 25.1 and row.temperature_min == 19.6
    assert row.temperature_avg == pytest.approx(22.46)
    assert row.air_quality_category == "Moderada"
    assert json.loads(row.alerts_json) == {
        "high_temperature": 0, "low_temperature": 0, "high_humidity": 0, "low_humidity": 0,
    }


def test_wide_row_columns_and_empty_input(seed):
    stamped = kpis.stamped(kpis.wide(seed.withColumn("pm25", F.lit(1.0)).filter("false")), "2024-01-01")
    assert tuple(stamped.columns) == V.WIDE_KPI_COLUMNS
    row = stamped.first()
    assert row.total_readings == 0 and row.temperature_std == 0.0 and row.air_quality_category == "Buena"


def test_wide_row_of_missing_measures(seed):
    columns = kpis.wide(seed.select("sensor_id", "temperature")).columns
    assert "pm25_avg" not in columns and "air_quality_category" not in columns
    assert "temperature_std" in columns and "alerts_json" in columns


def test_long_families_of_missing_measures(seed):
    short = seed.select("sensor_id", "temperature", "location")
    assert kpis.general(short).count() == 3
    assert kpis.alerts(short).count() == 2


def test_low_temperature_variants(spark):
    df = spark.createDataFrame([(7.0, 50.0), (4.0, 50.0)], "temperature double, humidity double")
    df = df.withColumn("sensor_id", F.lit(None).cast("string")).withColumn("pm25", F.lit(30.0))
    df = df.withColumn("pressure", F.lit(1000.0))
    plain, notebook = kpis.wide(df).first(), kpis.wide_notebook(df).first()
    assert json.loads(plain.alerts_json)["low_temperature"] == 2
    assert json.loads(notebook.alerts_json)["low_temperature"] == 1
    assert (plain.unique_sensors, notebook.unique_sensors) == (0, 1)
    assert (plain.air_quality_category, notebook.air_quality_category) == ("Moderada", "Moderado")


def test_location_slug(seed):
    names = {r.kpi_name for r in kpis.per_location(seed).collect()}
    assert {"sensors_in_sala_de_servidores", "avg_temperature_almacén"} <= names


def test_long_table_is_its_families(spark, sf_dir, as_rows):
    df = scored(spark, sf_dir)
    as_of = times.newest(df)
    parts = [
        kpis.general(df), kpis.per_sensor(df), kpis.per_location(df), kpis.temporal(df, as_of),
        kpis.quality(df), kpis.completeness(df), kpis.alerts(df),
    ]
    want = combine.by_name(*parts)
    got = kpis.long_table(df, as_of, as_of)
    columns = ["kpi_name", "kpi_category", F.round("kpi_value", 6).alias("v"), "kpi_unit", "description", "sensor_id", "location"]
    assert as_rows(got.select(*columns)) == as_rows(want.select(*columns))


def test_long_table_reads_once(spark, sf_dir, plan):
    shape = plan(kpis.long_table(readings(spark, sf_dir), "2024-01-30"))
    assert shape.count("FileScan") == 1


def test_long_table_without_score(spark, sf_dir):
    names = {r.kpi_name for r in kpis.long_table(readings(spark, sf_dir), "2024-01-30").collect()}
    assert "avg_data_quality" not in names and "completeness_pressure" in names


def test_temporal_rows_only_where_there_are_readings(spark, sf_dir):
    df = readings(spark, sf_dir)
    assert kpis.temporal(df, "2030-01-01").count() == 0
    assert kpis.temporal(df, "2024-02-03").count() == 1  # within the week, not within the day


def test_completeness_of_nothing(seed):
    assert kpis.completeness(seed.filter("false")).count() == 0


def test_sensor_counts_add_up(spark, sf_dir):
    df = readings(spark, sf_dir)
    assert sensors.statistics(df).agg(F.sum("readings_count")).first()[0] == df.count()


def test_cleaning_metrics_balance(spark, sf_dir):
    row = summary.cleaning(readings_raw(spark, sf_dir)).first()
    assert row.rows_in == row.rows_out + row.duplicates_removed + row.outliers_removed
    empty = summary.cleaning(readings_raw(spark, sf_dir).filter("false")).first()
    assert (empty.rows_in, empty.rows_out, empty.percent_kept) == (0, 0, None)


def test_anomalies(spark):
    calm = [("a", 20.0 + i % 2) for i in range(50)]
    df = spark.createDataFrame(calm + [("a", 99.0), ("b", 5.0), ("b", 5.0), ("b", None)], "sensor_id string, temperature double")
    got = {r.sensor_id: (r.readings, r.anomalies) for r in sensors.anomaly_rate_per_sensor(df).collect()}
    assert got == {"a": (51, 1), "b": (3, 0)}


@pytest.mark.parametrize("kept", ["true", "sensor_id = 'TEMP_001'", "false"])
def test_tables_from_parts(spark, seed, as_rows, kept):
    gaps = spark.createDataFrame([(None, None, 40.0, None, None), ("TEMP_001", 30.5, None, 990.0, None), ("TEMP_009", None, None, None, "X")], seed.schema)
    df = seed.unionByName(gaps).filter(kept).withColumn("pm25", F.col("temperature") * 2).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    held = kpis.parts(df, "2024-01-02")
    got, want = kpis.wide_of_parts(held).first().asDict(), kpis.wide(df).first().asDict()
    assert list(got) == list(want)
    assert got == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in want.items()}
    got, want = (as_rows(d) for d in (sensors.statistics_of_parts(held), sensors.statistics(df)))
    assert len(got) == len(want)
    for one, other in zip(got, want):
        assert one == tuple(pytest.approx(v) if isinstance(v, float) else v for v in other)


def test_parts_read_no_more_than_is_used(spark, sf_dir, plan):
    assert "var_pop" not in plan(kpis.long_table(readings(spark, sf_dir)))

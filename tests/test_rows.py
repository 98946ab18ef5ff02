"""Row operators on hand-made readings and edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weatherloom import schemas
from weatherloom.functions import ladders, measures, times
from weatherloom.operators import combine, duplicates, filters, impute, latest, project


def values(spark, expression, cells, kind="double"):
    df = spark.createDataFrame([(c,) for c in cells], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_comfort_of_seed(seed):
    got = {r[0]: r[1] for r in seed.select("sensor_id", measures.comfort_index(F.col("temperature"), F.col("humidity"))).collect()}
    assert got == {
        "TEMP_001": "Moderate",
        "TEMP_002": "Comfortable",
        "TEMP_003": "Uncomfortable",
        "TEMP_004": "Moderate",
        "TEMP_005": "Moderate",
    }


@pytest.mark.parametrize(
    "t, h, label",
    [
        (20.0, 40.0, "Comfortable"),
        (25.0, 60.0, "Comfortable"),
        (25.01, 60.0, "Moderate"),
        (18.0, 50.0, "Moderate"),
        (17.99, 50.0, "Uncomfortable"),
        (28.0, 50.0, "Moderate"),
        (28.01, 50.0, "Uncomfortable"),
        (22.0, 30.0, "Moderate"),
        (22.0, 29.9, "Uncomfortable"),
        (22.0, 70.0, "Moderate"),
        (22.0, 70.1, "Uncomfortable"),
        (None, 50.0, "Moderate"),
        (None, 80.0, "Uncomfortable"),
        (None, None, "Moderate"),
    ],
)
def test_comfort_edges(spark, t, h, label):
    df = spark.createDataFrame([(t, h)], "t double, h double")
    assert df.select(measures.comfort_index(F.col("t"), F.col("h"))).first()[0] == label


def test_air_quality_edges(spark):
    five = values(spark, ladders.air_quality_five, [25.0, 25.1, 50.0, 50.1, 100.0, 100.1, 150.0, 150.1, None])
    assert five == [
        "Bueno", "Moderado", "Moderado", "Insalubre", "Insalubre", "Muy insalubre", "Muy insalubre", "Peligroso", "Bueno",
    ]
    four = values(spark, ladders.air_quality_four, [12.0, 12.1, 35.4, 35.5, 55.4, 55.5])
    assert four == [
        "Buena", "Moderada", "Moderada", "Insalubre para grupos sensibles", "Insalubre para grupos sensibles", "Insalubre",
    ]


def test_status_and_bands(spark):
    assert values(spark, ladders.system_status, [95.0, 94.9, 80.0, 79.9]) == [
        "EXCELENTE", "BUENO", "BUENO", "REQUIERE ATENCIÓN",
    ]
    bands = values(spark, lambda v: ladders.dashboard_band(v, "temperature"), [14.9, 15.0, 25.0, 35.0, None])
    assert bands == ["blue", "green", "yellow", "red", None]
    assert values(spark, lambda v: ladders.dashboard_band(v, "pressure"), [1.0, None]) == ["purple", None]


def test_quality_score(spark):
    cells = [(1.0, 1.0, 1.0), (1.0, 1.0, None), (1.0, None, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(cells, "temperature double, humidity double, pressure double")
    assert [r.data_quality_score for r in project.quality_score(df).collect()] == [100, 75, 50, 25]


def test_category_and_names(spark):
    ids = ["TEMP_1", "HUM_1", "PRES_1", "10.0.0.7", None]
    assert values(spark, measures.sensor_category, ids, "string") == [
        "Temperature", "Humidity", "Pressure", "Multi-sensor", "Multi-sensor",
    ]
    assert values(spark, measures.sensor_name, ["192.168.1.42"], "string") == ["Sensor 42"]


def test_parsed_timestamp(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05", "2024-01-02 03:04:05.123456", "", "soon", None]
    got = values(spark, lambda v: times.parsed_timestamp(v).cast("string"), texts, "string")
    assert got == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", "2024-01-02 03:04:05.123456", None, None, None]


def test_nan_becomes_null(spark):
    df = schemas.nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None)], "id int, x double"))
    assert [r.x for r in df.orderBy("id").collect()] == [None, 3.0, None]


def test_alias_only_where_needed(spark):
    both = spark.createDataFrame([("a", "b")], "ip string, sensor_id string")
    assert schemas.with_sensor_id(both).first().sensor_id == "b"
    one = spark.createDataFrame([("a",)], "ip string")
    assert schemas.with_sensor_id(one).first().sensor_id == "a"


def test_valid_range_bounds(spark):
    cells = [(-50.0, 0.0, 800.0), (70.0, 100.0, 1200.0), (70.1, 50.0, 1000.0), (None, 50.0, 1000.0)]
    df = spark.createDataFrame(cells, "temperature double, humidity double, pressure double")
    assert filters.valid_range(df).count() == 2
    assert filters.valid_range(df, nulls="keep").count() == 3
    with pytest.raises(ValueError):
        filters.valid_range(df, nulls="maybe")


def test_sigma_filter(spark):
    df = spark.createDataFrame([(i, 20.0) for i in range(100)] + [(100, 900.0), (101, None)], "id int, temperature double")
    assert filters.sigma(df).count() == 100
    constant = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None)], "id int, temperature double")
    assert filters.sigma(constant).count() == 3  # no spread, no filter
    single = spark.createDataFrame([(1, 5.0), (2, None)], "id int, temperature double")
    assert filters.sigma(single).count() == 2
    empty = constant.filter("id > 9")
    assert filters.sigma(empty).count() == 0


def test_mean_imputation(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (2, None, None), (3, 4.0, 4)], "id int, temperature double, light int")
    got = {r.id: (r.temperature, r.light) for r in impute.mean_global(df).collect()}
    assert got == {1: (2.0, 1.0), 2: (3.0, 2.5), 3: (4.0, 4.0)}
    zero = spark.createDataFrame([(1, -2.0), (2, None), (3, 2.0)], "id int, temperature double")
    assert impute.mean_global(zero, skip_zero=True).filter("temperature is null").count() == 1
    nothing = spark.createDataFrame([(1, None)], "id int, temperature double")
    assert impute.mean_global(nothing).first().temperature is None


def test_median_imputation(spark):
    cells = [("a", 1.0), ("a", 2.0), ("a", 9.0), ("a", 10.0), ("a", None), ("b", None), ("b", 5.0), ("c", None), (None, None)]
    df = spark.createDataFrame(cells, "sensor_id string, temperature double")
    alone = impute.median_per_sensor(df).groupBy("sensor_id").agg(F.sort_array(F.collect_list("temperature")))
    got = {r[0]: r[1] for r in alone.collect()}
    assert got == {"a": [1.0, 2.0, 2.0, 9.0, 10.0], "b": [5.0, 5.0], "c": [5.0], None: [5.0]}
    assert impute.median_global(df).filter("temperature = 5.0").count() == 5


def test_medians_are_values_of_the_data(spark):
    fine = [(str(i % 3), 0.12345 + i / 100_000) for i in range(50)] + [("0", 0.5)] * 3
    df = spark.createDataFrame(fine, "sensor_id string, temperature double").repartition(7)
    values = sorted(t for _, t in fine)
    assert impute.medians(df, ["temperature"]).first().temperature == values[(len(values) - 1) // 2]
    for row in impute.medians(df, ["temperature"], "sensor_id").collect():
        own = sorted(t for s, t in fine if s == row.sensor_id)
        assert (row.temperature, row.readings) == (own[(len(own) - 1) // 2], len(own))


def test_medians_of_few_and_none(spark):
    empty = spark.createDataFrame([], "sensor_id string, temperature double")
    assert impute.medians(empty, ["temperature"]).collect()[0].temperature is None
    assert impute.median_global(empty).count() == 0


def test_duplicates(spark):
    cells = [(1, "s", 10, 1.0), (1, "s", 10, 1.0), (2, "s", 10, 2.0), (3, None, 10, 3.0), (3, None, 10, 3.0)]
    df = spark.createDataFrame(cells, "id int, sensor_id string, timestamp int, ingestion_timestamp double")
    assert duplicates.exact(df).count() == 3
    assert duplicates.exact(duplicates.exact(df)).count() == 3
    assert sorted(r.id for r in duplicates.last_per_key(df).collect()) == [2, 3]
    assert duplicates.any_per_key(df).count() == 2
    assert sorted(r.copies for r in duplicates.with_copies(df).collect()) == [1, 2, 2]


def test_copies_collapse_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 2 AS sensor_id", "id % 3 AS timestamp", "id", "id AS ingestion_timestamp")
    shape = plan(duplicates.last_per_key(df))
    below_exchange = shape[shape.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    stacked = combine.by_name(a, b)
    assert stacked.columns == ["id", "a", "b"] and stacked.count() == 2
    with pytest.raises(ValueError):
        combine.by_position(a, b)


def test_keyset_pages_lose_no_ties(spark):
    df = spark.createDataFrame([(i, i // 7) for i in range(100)], "id int, timestamp int")
    seen, mark = [], (-1, -1)
    while True:
        got = [(r.timestamp, r.id) for r in latest.page_after(df, *mark, limit=10).collect()]
        if not got:
            break
        seen += got
        mark = got[-1]
    assert seen == [(i // 7, i) for i in range(100)]


def test_newest_full_rows_with_ties(spark):
    df = spark.createDataFrame([(i, i // 5, "x") for i in range(50)], "id int, inserted_at int, more string")
    got = [r.id for r in latest.newest_full_rows(df, 7).collect()]
    assert got == [49, 48, 47, 46, 45, 44, 43]


def test_first_load_does_not_hide_increments(spark):
    cells = [(1, "initial_batch_0001", 1), (2, "initial_batch_0002", 1), (3, "batch_20240101_000000", 2)]
    df = spark.createDataFrame(cells, "id int, batch_id string, ingestion_timestamp int")
    assert [r.id for r in latest.newest_batches(df, 1).collect()] == [3]
    assert sorted(r.id for r in latest.newest_batches(df, 2).collect()) == [2, 3]


def test_initial_batches(spark):
    df = spark.range(1, 2502).transform(project.initial_batch_ids, 1000)
    got = {r[0]: r[1] for r in df.groupBy("batch_id").count().collect()}
    assert got == {"initial_batch_0000": 1000, "initial_batch_0001": 1000, "initial_batch_0002": 501}


def _keyed(df):
    return [(r.timestamp, r.id) for r in df.collect()]


@pytest.mark.parametrize("keys", [1, 3, 100_000])
def test_indexed_pages_are_the_plain_ones(spark, keys):
    times = [None, "2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-05"]
    data = [(times[i % 6], i // 2 if i % 7 else None) for i in range(60)] + [("2024-01-02", 5)] * 8
    df = spark.createDataFrame(data, "timestamp string, id long").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    df = df.repartition(5).withColumn("before", F.lit("kept"))
    index = latest.page_index(df, keys=keys)
    assert index.agg(F.sum("rows")).first()[0] == df.count()
    whole = _keyed(latest.page(df, 0, 1000))
    for offset in (0, 9, 25, 38, 55, 66, 70):
        assert _keyed(latest.indexed_page(df, index, offset, 9)) == whole[offset : offset + 9]
    assert latest.indexed_page(df, index, 500, 7).columns == df.columns
    empty = latest.page_index(df.limit(0), keys=keys)
    assert latest.indexed_page(df, empty, 0, 7).count() == 0


def test_an_indexed_page_reads_its_range(spark, tmp_path, capsys):
    rows = spark.range(1000).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + id * INTERVAL 1 HOUR AS timestamp", "repeat('x', 9) AS wide")
    rows.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    page = latest.indexed_page(df, latest.page_index(df, keys=50), 700, 10)
    assert [r.id for r in page.collect()] == list(range(299, 289, -1))
    bounds = "LessThanOrEqual(timestamp,2024-01-13T11:00), GreaterThanOrEqual(timestamp,2024-01-11T10:00)"
    page.explain("formatted")
    shown = capsys.readouterr().out
    assert bounds in shown and "rangepartitioning" not in shown


def test_an_indexed_page_by_instants(spark):
    df = spark.range(300).selectExpr("id", "timestamp_micros(1700000000000000 + id) AS timestamp")
    page = latest.indexed_page(df, latest.page_index(df, keys=20), 111, 5)
    assert [r.id for r in page.collect()] == [188, 187, 186, 185, 184]

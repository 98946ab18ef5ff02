"""Streams: decoding rules, replays, restarts, equality with the batch operators."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from weatherloom.catalog.readings import EVENTS, as_readings, events, readings
from weatherloom.catalog.streams import zoned
from weatherloom.operators import project
from weatherloom.sinks import timeline
from weatherloom.streaming import decode, ingest, publish, reports, run, sources


def decoded(spark, *texts):
    rows = decode.decoded(spark.createDataFrame([(t,) for t in texts], "value string"))
    return {r.message: r for r in rows.collect()}


def test_absent_fields_take_defaults(spark):
    (row,) = decoded(spark, '{"id": 7}').values()
    assert not row.rejected
    assert (row.id, row.sensor_id, row.location, row.batch_id) == (7, "Unknown", "Unknown", "")
    assert (row.temperature, row.light, row.vibration, row.timestamp) == (0.0, 0, False, None)


@pytest.mark.parametrize(
    "text, bad",
    [
        ('{"temperature": null}', True),
        ('{"temperature": "hot"}', True),
        ('{"temperature": "21.5"}', False),
        ('{"temperature": ""}', True),
        ('{"light": null}', True),
        ('{"light": 12.9}', False),
        ('{"pm25": "NaN"}', True),
        ('{"sensor_id": null}', False),
        ("{}", False),
        ("not json", True),
        ('{"temperature": 1', True),
        ("", True),
        (None, True),
        ("[1, 2]", True),
        ("5", True),
        ('{"timestamp": "31/12/2025 10:00"}', True),
        ('{"timestamp": ""}', False),
        ('{"timestamp": null}', False),
        ('{"timestamp": "2025-12-31 10:00:00"}', False),
    ],
)
def test_reject_rule(spark, text, bad):
    (row,) = decoded(spark, text).values()
    assert row.rejected is bad


def test_values_are_read(spark):
    text = '{"light": 12.9, "vibration": "true", "timestamp": "2024-01-02T03:04:05Z", "id": 9007199254740993}'
    (row,) = decoded(spark, text).values()
    assert (row.light, row.vibration, row.id) == (12, True, 9007199254740993)
    assert str(row.timestamp) == "2024-01-02 03:04:05"
    flags = {t: decoded(spark, t)[t].vibration for t in ('{"vibration": "false"}', '{"vibration": 1}', '{"vibration": 0}')}
    assert list(flags.values()) == [False, True, False]


@pytest.fixture
def event_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "in")
    events(spark, sf_dir).repartition(5, "event_id").write.parquet(path)
    return path


def reading_stream(spark, path, files_per_batch=None):
    return zoned(as_readings(sources.reading_files(spark, path, EVENTS, files_per_batch)))


def test_ingest_restarts_add_nothing(spark, event_files, tmp_path):
    def drain():
        messages = project.as_messages(reading_stream(spark, event_files, 1), keep_nulls=True).select("value")
        query = ingest.start(messages, f"{tmp_path}/t", f"{tmp_path}/cp", "s")
        query.awaitTermination()
        return ingest.counters(spark, f"{tmp_path}/t").first()

    first = drain()
    assert first["received"] == 1000 and first["inserted"] + first["errors"] == 1000 and first["errors"] > 0
    assert drain() == first  # nothing more was received
    assert timeline.read(spark, f"{tmp_path}/t").count() == first["inserted"]
    assert ingest.quarantined(spark, f"{tmp_path}/t", "s").filter("message is not null").count() == first["errors"]
    assert timeline.compact(spark, f"{tmp_path}/t") == 4  # the newest may come again
    assert ingest.counters(spark, f"{tmp_path}/t").first() == first and drain() == first


def test_message_files(spark, tmp_path):
    lines = [json.dumps({"id": i, "sensor_id": "s"}) for i in range(5)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/in")
    stream = decode.accepted(decode.decoded(sources.message_files(spark, f"{tmp_path}/in"))).select("id")
    run.to_files(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


@pytest.fixture
def mixed_files(spark, sf_dir, tmp_path):
    """The events in six files of mixed times."""
    path = str(tmp_path / "mixed")
    events(spark, sf_dir).repartition(6, F.xxhash64("event_id")).write.parquet(path)
    return path


def test_no_reading_is_lost_out_of_order(spark, mixed_files, tmp_path):
    for _ in range(2):  # the second start finds nothing new
        stream = reading_stream(spark, mixed_files, 1)
        reports.store_distinct(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    kept = reports.distinct_readings(spark, f"{tmp_path}/out")
    assert kept.count() == 1000 and kept.select("id").distinct().count() == 1000


@pytest.mark.parametrize("compacted", [False, True])
def test_repeats_in_later_files_are_not_stored(spark, sf_dir, tmp_path, compacted):
    path, out = str(tmp_path / "in"), f"{tmp_path}/out"
    for _ in range(3):
        events(spark, sf_dir).coalesce(1).write.mode("append").parquet(path)
        if compacted:
            reports.store_distinct(reading_stream(spark, path, 1), out, f"{tmp_path}/cp").awaitTermination()
            reports.distinct_table(out).compact(spark)
    reports.store_distinct(reading_stream(spark, path, 1), out, f"{tmp_path}/cp").awaitTermination()
    assert reports.distinct_readings(spark, out).count() == 1000


HALF_KEYED = [
    (1, "a", "2024-01-01 00:00:00", 1.0),
    (2, None, "2024-01-01 00:00:00", 2.0),
    (3, None, "2024-01-01 00:00:00", 3.0),
    (4, None, None, 4.0),
    (5, None, None, 5.0),
    (6, "a", None, 6.0),
    (7, "a", None, 7.0),
]


def half_keyed(spark, tmp_path, *rounds):
    """A stream of small files, one micro-batch each."""
    schema = "id long, sensor_id string, timestamp timestamp, temperature double"
    for rows in rounds:
        texts = spark.createDataFrame(rows, "id long, sensor_id string, timestamp string, temperature double")
        texts.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/half")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/half")


def test_readings_without_a_key_are_all_stored(spark, tmp_path):
    repeats = [(8, "a", "2024-01-01 00:00:00", 8.0), (0, "b", "2024-01-01 00:00:00", 0.0), (9, "b", "2024-01-01 00:00:00", 9.0)]
    stream = half_keyed(spark, tmp_path, HALF_KEYED, repeats)
    reports.store_distinct(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    ids = {r.id for r in reports.distinct_readings(spark, f"{tmp_path}/out").collect()}
    assert ids == {1, 2, 3, 4, 5, 6, 7, 0}  # of b the first


def test_a_lookup_opens_only_its_own_folders(spark, mixed_files, tmp_path, plan):
    out = f"{tmp_path}/out"
    reports.store_distinct(reading_stream(spark, mixed_files), out, f"{tmp_path}/cp").awaitTermination()
    table = reports.distinct_table(out)
    slot = reports.distinct_table(out).read(spark).first().slot
    files_read = table.read(spark, {slot}).inputFiles()
    assert files_read and all(f"slot={slot}/" in f for f in files_read) and table.read(spark, {"d19000101.b0"}) is None


def window_rows(spark, path):
    return sorted((tuple(r) for r in reports.windows(spark, path).collect()), key=repr)


def test_windows_count_every_reading(spark, mixed_files, tmp_path):
    out = f"{tmp_path}/out"
    reports.window_parts(reading_stream(spark, mixed_files, 1), out, f"{tmp_path}/cp").awaitTermination()
    before = window_rows(spark, out)
    assert sum(r[3] for r in before) == 1000
    want = zoned(as_readings(spark.read.parquet(mixed_files))).groupBy(F.window("timestamp", "10 minutes").alias("w"), "sensor_id")
    want = want.agg(F.count(F.lit(1)).alias("n"), F.min("temperature").alias("low")).select("w.start", "w.end", "sensor_id", "n", "low")
    assert sorted((tuple(r) for r in want.collect()), key=repr) == sorted(((*r[:4], r[5]) for r in before), key=repr)
    table = reports.window_table(out)
    for every in (False, True):
        table.compact(spark, every)
        after = window_rows(spark, out)
        assert [(*r[:4], *r[5:]) for r in after] == [(*r[:4], *r[5:]) for r in before]
    assert table.unsettled(spark) == set() and table.read(spark).count() == len(before)


def test_readings_without_a_time_are_counted(spark, tmp_path, plan):
    late = [(10, "a", "2024-01-01 00:05:00", 3.0), (11, None, None, 1.0), (12, "a", "2024-02-01 00:05:00", 3.0)]
    out = f"{tmp_path}/out"
    reports.window_parts(half_keyed(spark, tmp_path, HALF_KEYED, late), out, f"{tmp_path}/cp").awaitTermination()
    for _ in range(2):
        rows = {(str(r.window_start), r.sensor_id): (r.readings, r.avg_temperature) for r in reports.windows(spark, out).collect()}
        assert sum(n for n, _ in rows.values()) == 10 and len(rows) == 5
        assert rows[("None", None)] == (3, 10 / 3) and rows[("2024-01-01 00:00:00", "a")] == (2, 2.0)
        reports.window_table(out).compact(spark, all_epochs=True)
    assert "Aggregate" not in plan(reports.windows(spark, out).filter("window_start >= '2024-02-01'")).split("Union")[0]


def test_panels_survive_compaction_and_repeats(spark, mixed_files, tmp_path):
    out = f"{tmp_path}/out"
    reports.dashboard(reading_stream(spark, mixed_files, 1), out, f"{tmp_path}/cp", run.DRAIN).awaitTermination()
    totals, by_sensor = reports.panel(spark, out, "totals").first(), reports.panel(spark, out, "sensors").count()
    assert totals.total == 1000
    table = reports.panels(out)
    assert table.compact(spark) == 5 and table.compact(spark) == 0
    assert reports.panel(spark, out, "totals").first() == totals and reports.panel(spark, out, "sensors").count() == by_sensor


def test_counters_outlast_retained_progress(spark, mixed_files, tmp_path):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        messages = project.as_messages(reading_stream(spark, mixed_files, 1), keep_nulls=True).select("value")
        ingest.start(messages, f"{tmp_path}/t", f"{tmp_path}/cp", "s").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert ingest.counters(spark, f"{tmp_path}/t", "s").first()["received"] == 1000


def test_mark_without_history(spark, tmp_path):
    mark = publish.last_time_mark(spark, f"{tmp_path}/none", "db", now="2024-01-01 12:00:00").first()
    assert str(mark.mark_timestamp) == "2024-01-01 11:00:00" and mark.mark_id is None


def test_marks_over_batches(spark, event_files, tmp_path):
    stream = reading_stream(spark, event_files, 1).select("id", "timestamp")

    def commit(batch, epoch):
        publish.commit_time_mark(batch, f"{tmp_path}/marks", "db", "s", epoch)

    run.per_batch(stream, commit, f"{tmp_path}/cp").awaitTermination()
    assert publish.last_time_mark(spark, f"{tmp_path}/marks", "db").first().mark_id == 999

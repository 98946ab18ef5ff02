"""Sources, sinks, jobs."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weatherloom import schemas
from weatherloom.catalog.readings import as_source, readings, streamed
from weatherloom.operators import kpis, latest
from weatherloom.plans import jobs
from weatherloom.sinks import audit, commits, export, lake, storage, timeline, topics as topic_sink
from weatherloom.sources import database, files, report, topics


@pytest.fixture
def store(tmp_path):
    return lake.Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return readings(spark, sf_dir).transform(as_source).persist()


def test_increments_add_up_and_repeat_harmlessly(spark, source, store):
    first = source.filter("id <= 400")
    assert lake.append_increment(first, store) == 400
    assert lake.append_increment(first, store) == 400  # nothing new
    assert lake.read_bronze(spark, store).count() == 400
    assert lake.append_increment(source, store) == 1000
    bronze = lake.read_bronze(spark, store)
    assert bronze.count() == 1000 and bronze.select("id").distinct().count() == 1000
    assert set(bronze.columns) == set(schemas.BRONZE.fieldNames())


def test_a_batch_whose_mark_was_lost_is_replaced(spark, source, store):
    first = source.filter("id <= 400")
    rows = first.withColumns({"ingestion_timestamp": F.current_timestamp(), "batch_id": F.lit("half")})
    half = f"{lake.generation_of(store, 'sensor_readings', 0)}/from_id=0"
    lake._write_batch(rows.limit(100), half)  # written, but not committed
    assert lake.read_bronze(spark, store).count() == 0
    lake.append_increment(first, store)
    assert lake.read_bronze(spark, store).count() == 400
    lake._write_batch(rows.limit(100), half.replace("from_id=0", "from_id=400"))
    assert lake.read_bronze(spark, store).count() == 400
    lake.append_increment(source, store)
    assert lake.read_bronze(spark, store).count() == 1000


def broken(df):
    """Fails while it is written."""
    return df.withColumn("id", F.expr("if(id = 390, raise_error('lost'), id)").cast("bigint"))


@pytest.mark.parametrize("begin", [lake.append_increment, lake.initial_load])
def test_a_first_load_that_fails_changes_nothing(spark, source, store, begin):
    assert begin(source.filter("id <= 400"), store) == 400
    with pytest.raises(Exception, match="lost"):
        lake.initial_load(broken(source), store, up_to=1000)
    assert lake.read_bronze(spark, store).count() == 400 and lake.last_mark(spark, store, "sensor_readings") == 400
    assert lake.append_increment(source, store) == 1000
    bronze = lake.read_bronze(spark, store)
    assert bronze.count() == bronze.select("id").distinct().count() == 1000
    assert lake.initial_load(source.filter("id <= 700"), store) == 700
    assert lake.read_bronze(spark, store).count() == 700


def test_a_source_that_begins_anew(spark, source, store):
    lake.initial_load(source, store)
    assert lake.initial_load(source.filter("id <= 400"), store) == 400
    assert lake.append_increment(source.filter("id <= 800"), store) == 800
    bronze = lake.read_bronze(spark, store)
    assert bronze.count() == bronze.select("id").distinct().count() == 800


def test_release_keeps_what_is_committed(spark, source, store):
    lake.initial_load(source, store, "a")
    lake.initial_load(source.filter("id <= 400"), store, "a")
    lake.append_increment(source.filter("id <= 300"), store, "b")
    with pytest.raises(Exception, match="lost"):
        lake.append_increment(broken(source), store, "b", up_to=1000)
    source.limit(5).write.parquet(store.staging_of("old"))
    gone = lake.release(spark, store)
    assert lake.generation_of(store, "a", 1) in gone and store.staging in gone
    assert lake.release(spark, store) == []
    assert lake.read_bronze(spark, store).count() == 700
    assert storage.folders(spark, f"{store.bronze}/ingest_source=a") == ["generation=2"]


def test_planning_reads_no_footers(spark, source, store, tmp_path):
    lake.append_increment(source.filter("id <= 400").drop("pm25"), store)
    lake.append_increment(source.withColumn("light", F.col("light") + 0.5), store)
    sums = lake.read_bronze(spark, store).agg(F.sum("light")).first()[0]
    assert sums == source.agg(F.sum(F.col("light") + F.when(F.col("id") > 400, 0.5).otherwise(0))).first()[0]
    for found in tmp_path.glob("lake/bronze/**/*.parquet"):
        found.chmod(0o644)
        found.write_bytes(b"no footer")
    bronze = lake.read_bronze(spark, store)  # the columns come from the commits
    assert dict(bronze.dtypes)["light"] == "double" and dict(bronze.dtypes)["pm25"] == "double"


def test_columns_of_unlike_types_are_refused(spark, source, store):
    lake.append_increment(source.filter("id <= 400"), store)
    with pytest.raises(ValueError, match="pm25"):
        lake.append_increment(source.withColumn("pm25", F.col("pm25").cast("string")), store)
    assert lake.last_mark(spark, store, "sensor_readings") == 400


def test_commits_do_not_pile_up(spark, store):
    log = f"{store.root}/log"
    for i in range(25):
        commits.commit(spark, log, commits.newest_of(spark, log, "t"), {"n": i})
    assert commits.newest_of(spark, log, "t").state == {"n": 24} and commits.newest_of(spark, log, "t").sequence == 25
    assert len(storage.folders(spark, f"{log}/of=t")) <= 2 * commits.KEPT


def test_expired_days_are_removed(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/t"
    dated = streamed(spark, sf_dir).select("id", F.to_date("ingestion_timestamp").alias("ingest_date"), F.lit("s").alias("ingest_source"))
    dated = dated.withColumn("ingest_date", F.expr("if(id < 5, null, ingest_date)"))
    dated.write.partitionBy("ingest_source", "ingest_date").parquet(path)
    as_of = F.lit("2024-02-14").cast("date")
    want = dated.filter(F.col("ingest_date").isNull() | (F.col("ingest_date") >= "2024-01-15")).count()
    gone = lake.drop_expired(spark, path, as_of)
    assert gone and all("ingest_date=" in g for g in gone) and lake.drop_expired(spark, path, as_of) == []
    left = spark.read.parquet(path)
    assert left.count() == want < dated.count() and left.agg(F.min("ingest_date").cast("string")).first()[0] == "2024-01-15"


def test_sources_have_their_own_marks(spark, source, store):
    lake.append_increment(source.filter("id <= 10"), store, "a")
    assert lake.last_mark(spark, store, "a") == 10
    assert lake.last_mark(spark, store, "b") == 0


def test_rows_of_two_sources_stay_apart(spark, source, store):
    lake.append_increment(source.filter("id <= 400"), store, "a")
    lake.append_increment(source.filter("id <= 600"), store, "b")
    assert lake.read_bronze(spark, store).count() == 1000


@pytest.mark.parametrize("order", ["iai", "ai", "aii", "iaai"])
def test_a_first_load_replaces_what_was_there(spark, source, store, order):
    for i, step in enumerate(order):
        part = source.filter(F.col("id") <= 250 * (i + 1))
        (lake.initial_load if step == "i" else lake.append_increment)(part, store)
    bronze = lake.read_bronze(spark, store)
    assert bronze.count() == bronze.select("id").distinct().count() == 250 * len(order)


def test_a_late_column_survives(spark, source, store):
    lake.append_increment(source.filter("id <= 400").drop("pm25"), store)
    lake.append_increment(source, store)
    bronze = lake.read_bronze(spark, store)
    assert bronze.count() == 1000 and bronze.filter("pm25 IS NOT NULL").count() >= 500


def test_an_empty_source_is_read_quietly(spark, source, store):
    assert lake.append_increment(source.filter("id < 0"), store) == 0
    assert lake.read_bronze(spark, store).count() == 0


def test_gaps_are_kept_scored_and_filled(spark, source, store):
    jobs.initial(source, store, method="range_keep", as_of="2024-01-31")
    silver = lake.read_snapshot(spark, store.silver)
    assert silver.filter("data_quality_score < 100").count() > 0
    assert silver.filter("temperature IS NULL OR humidity IS NULL").count() == 0


def test_whole_names_below_the_root_are_logs(spark, tmp_path):
    rows = spark.range(2)
    for folder in ("biological", "run_log", "part one"):
        rows.write.parquet(f"{tmp_path}/catalog lake/{folder}")
    tree = files.parquet_tree(spark, f"{tmp_path}/catalog lake", schema=rows.schema, name_glob="*.parquet")
    assert tree.transform(files.data_files_only, f"{tmp_path}/catalog lake").count() == 4


def test_rows_without_a_time_fill_up_the_newest(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, None)], "id int, inserted_at int")
    assert [r.id for r in latest.newest_full_rows(df, 2).collect()] == [1, 3]


def test_initial_then_incremental(spark, source, store):
    lake.initial_load(source.filter("id <= 600"), store, page_size=100)
    lake.append_increment(source, store)
    bronze = lake.read_bronze(spark, store)
    assert bronze.count() == 1000
    assert bronze.filter("batch_id LIKE 'initial_batch_%'").select("batch_id").distinct().count() == 6


def test_full_job_writes_every_layer(spark, source, store):
    path = jobs.full(source, store, as_of="2024-01-31", at=datetime(2024, 2, 1))
    assert path.endswith("export_ts=20240201_000000")
    silver = jobs.silver_of(spark, store)
    assert silver.filter("temperature IS NULL OR humidity IS NULL OR pressure IS NULL").count() == 0
    wide = lake.read_snapshot(spark, store.gold_table(jobs.WIDE))
    assert wide.first().total_readings == silver.count()
    log = audit.read(spark, f"{store.audit}/silver").first()
    assert log.records_processed == silver.count() and log.status == "completed"
    gold_log = audit.read(spark, f"{store.audit}/gold").first()
    assert gold_log.output_files == [jobs.WIDE, jobs.SENSORS, jobs.LONG]
    assert gold_log.sensors_analyzed == gold_log.total_sensors
    names = ("kpis", "readings", "sensor_statistics", "log")
    jobs.export_tables(spark, store, names)
    counts = {n: spark.read.option("header", True).csv(f"{store.exports}/csv/{n}").count() for n in names}
    assert counts == {"kpis": 1, "readings": silver.count(), "sensor_statistics": gold_log.total_sensors, "log": 1}
    long_kpis = export.latest_version(spark, f"{store.exports}/kpis")
    assert set(long_kpis.columns) == set(schemas.KPI_LONG.fieldNames())


def test_newest_batches_limit_the_job(spark, source, store):
    lake.append_increment(source.filter("id <= 400"), store, at=F.lit(datetime(2024, 2, 1)))
    lake.append_increment(source, store, at=F.lit(datetime(2024, 2, 2)))
    silver = jobs.bronze_to_silver(spark, store, "range", newest_batches=1)
    assert silver.agg(F.min("id")).first()[0] > 400


def test_unknown_method(spark, source, store):
    lake.append_increment(source, store)
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(spark, store, "magic")


def test_exports_keep_history(spark, seed, tmp_path):
    root = str(tmp_path / "exports")
    export.versioned(kpis.general(seed.limit(1)), root, datetime(2024, 1, 1))
    export.versioned(kpis.general(seed), root, datetime(2024, 1, 2))
    assert spark.read.parquet(root).select("export_ts").distinct().count() == 2
    newest = {r.kpi_name: r.kpi_value for r in export.latest_version(spark, root).collect()}
    assert newest["total_readings"] == 5.0


def test_text_exports_keep_microseconds(spark, sf_dir, tmp_path, as_rows):
    df = readings(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    export.to_csv(df, f"{tmp_path}/csv")
    export.to_json(df, f"{tmp_path}/json")
    assert as_rows(spark.read.schema(df.schema).option("header", True).csv(f"{tmp_path}/csv")) == as_rows(df)
    assert as_rows(spark.read.schema(df.schema).json(f"{tmp_path}/json").select(*df.columns)) == as_rows(df)


def test_timeline_replays_an_epoch(spark, sf_dir, tmp_path):
    path = str(tmp_path / "timeline")
    df = streamed(spark, sf_dir)
    for _ in range(2):
        timeline.write_epoch(df, path, "s", 0)
    timeline.write_epoch(df.filter("id < 10"), path, "s", 1)
    assert timeline.read(spark, path).count() == df.count() + 10


def test_timeline_prunes_months(spark, sf_dir, tmp_path, plan):
    path = str(tmp_path / "timeline")
    timeline.backfill(streamed(spark, sf_dir), path)
    shape = plan(timeline.read(spark, path).filter(F.col(timeline.MONTH) == "202401"))
    assert f"PartitionFilters: [isnotnull({timeline.MONTH}" in shape


def test_absent_path_and_other_errors(spark, tmp_path):
    empty = files.parquet_or_empty(spark, f"{tmp_path}/none", schemas.KPI_LONG)
    assert empty.count() == 0 and empty.schema == schemas.KPI_LONG


def test_schema_report(spark, seed):
    got = [(r.column_name, r.data_type, r.is_nullable) for r in report.columns(seed).orderBy("ordinal_position").collect()]
    assert got[0] == ("sensor_id", "VARCHAR", "YES") and got[1] == ("temperature", "DOUBLE", "YES")
    assert report.sample(seed, "sensor_id").count() == 3


def test_database_ranges():
    assert database.range_options(1, 2500, 1000, 32)["numPartitions"] == "3"
    assert database.range_options(1, 10**9, 1000, 32) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": str(10**9 + 1), "numPartitions": "32",
    }
    assert database.range_options(0, 0, 1000, 32)["numPartitions"] == "1"


AT = datetime(2024, 1, 2, 3, 4, 5, 6)


def test_polls_are_the_databases_work():
    text = database.poll_query("jdbc:postgresql://h/db", "public.readings", AT, 7, 100)
    bound = """"timestamp" >= TIMESTAMP '2024-01-02 03:04:05.000006' AND ("timestamp" > TIMESTAMP '2024-01-02 03:04:05.000006' OR "id" > 7)"""
    assert text == f"""SELECT * FROM "public"."readings" WHERE {bound} ORDER BY "timestamp", "id" LIMIT 100"""
    assert database.poll_query("jdbc:sqlserver://h", "t", AT, limit=5).startswith("SELECT TOP 5 * FROM [t] WHERE [timestamp] > ")
    assert database.poll_query("jdbc:oracle:thin:@h", "t", AT, limit=5).endswith(' ORDER BY "timestamp", "id" FETCH FIRST 5 ROWS ONLY')
    assert database.poll_query("jdbc:mysql://h/db", "t", AT).count("`timestamp`") == 2
    assert database.count_and_max_query("jdbc:mysql://h", "a`b") == "SELECT COUNT(*) AS total, COALESCE(MAX(`id`), 0) AS max_id FROM `a``b`"
    assert database.id_extent_query("jdbc:h2:mem", "t", 5) == 'SELECT MIN("id") AS first_id, MAX("id") AS last_id FROM "t" WHERE "id" > 5'


@pytest.mark.parametrize("mark_id", [None, 500])
def test_poll_text_gives_the_rows_of_the_page(spark, sf_dir, mark_id):
    """The text is run by an SQL engine in this process, on the same rows."""
    duckdb = pytest.importorskip("duckdb")
    rows = readings(spark, sf_dir).select("id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
    mark = rows.filter("id = 500").first().timestamp
    con = duckdb.connect()
    con.register("given", rows.toPandas())
    con.execute("CREATE TABLE readings AS SELECT * FROM given")
    got = con.execute(database.poll_query("jdbc:duckdb:", "readings", mark, mark_id, 20)).fetchall()
    want = latest.page_after(rows, F.lit(mark), mark_id, 20).collect()
    assert [g[0] for g in got] == [w.id for w in want] and len(got) == 20
    total, highest = con.execute(database.count_and_max_query("jdbc:duckdb:", "readings")).fetchone()
    assert (total, highest) == tuple(rows.transform(database.count_and_max_id).first())


def test_count_and_max_of_nothing(source):
    row = source.filter("false").transform(database.count_and_max_id).first()
    assert (row.total, row.max_id) == (0, 0)


def test_topic_options():
    options = topics.kafka_options("broker:9092", "readings", max_per_trigger=100)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "100"
    assert topic_sink.kafka_options("broker:9092", "readings")["topic"] == "readings"


def test_failed_write_leaves_the_old_snapshot(spark, tmp_path):
    path = f"{tmp_path}/snapshot"
    lake.write_snapshot(spark.range(3), path)
    lake.write_snapshot(spark.range(5), path)
    broken = spark.range(9).withColumn("id", F.expr("if(id = 7, raise_error('lost'), id)").cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        lake.write_snapshot(broken, path)
    assert lake.read_snapshot(spark, path).count() == 5
    lake.write_snapshot(spark.range(2), path)
    assert lake.read_snapshot(spark, path).count() == 2

"""Tables stored by day, the catalog's inventory, Spark's event log and refresh listener, and counts from footers."""

import json
import os
from datetime import datetime, timedelta

import pytest
from conftest import NOON, SF_DIR
from pyspark.sql import functions as F

from lineside.operators import checks, serve
from lineside.operators import journal as inspect
from lineside.plans import catalog
from lineside.session import shared_dir
from lineside.sources import eventlog, stored, tables
from lineside.streaming import watch

ROW = "k string, at timestamp_ntz, v int"


@pytest.fixture
def database(spark):
    base = shared_dir(spark, "db")
    name = "t_" + base.rsplit("-", 1)[1]
    stored.open_database(spark, name, base)
    return name


def logged(folder):
    for name in os.listdir(folder):
        if not name.endswith(".crc"):
            with open(f"{folder}/{name}") as f:
                yield from map(json.loads, f)


def records_read(folder):
    ends = [e for e in logged(folder) if e["Event"] == "SparkListenerTaskEnd"]
    return sum(e["Task Metrics"]["Input Metrics"]["Records Read"] for e in ends)


def by_day(spark, database, days=10, rows=100):
    data = [(f"{d}-{i}", NOON + timedelta(days=d), i) for d in range(days) for i in range(rows)]
    stored.publish(spark.createDataFrame(data, ROW), f"{database}.t", at="at")
    return f"{database}.t"


def test_a_refresh_reads_and_writes_only_the_days_it_touches(spark, database):
    table = by_day(spark, database)
    one = spark.createDataFrame([("3-7", NOON + timedelta(days=3), 7)], ROW).withColumn(stored.DAY, stored.day_of("at"))
    days = stored.days_touched(one)
    assert days == ["2026-01-04"]
    folder = shared_dir(spark, "log")
    with eventlog.recorded(spark, folder):
        assert stored.read_days(spark, table, days).count() == 100
    assert records_read(folder) == 100  # of 1,000

    def files_of():
        return dict(sorted(map(tuple, spark.table(table).select(stored.DAY, F.input_file_name()).distinct().collect())))

    files = files_of()
    stored.merge_days(table, "k", one, one.withColumn("v", F.lit(-1)))
    after = files_of()
    assert [d for d in files if files[d] != after[d]] == ["2026-01-04"]
    assert spark.table(table).where("v = -1").count() == 1 and spark.table(table).count() == 1000


def test_a_row_that_moves_leaves_its_day_and_an_emptied_day_goes(spark, database):
    data = [("a", NOON, 1), ("b", NOON + timedelta(days=1), 2), ("n", None, 3)]
    stored.publish(spark.createDataFrame(data, ROW), f"{database}.t", at="at")
    before = spark.table(f"{database}.t").where("k = 'a'")
    after = spark.createDataFrame([("a", NOON + timedelta(days=1), 9)], ROW).withColumn(stored.DAY, stored.day_of("at"))
    stored.merge_days(f"{database}.t", "k", before, after)
    assert "DAY=2026-01-01" not in os.listdir(spark.catalog.getDatabase(database).locationUri.removeprefix("file:") + "/t")
    rows = {(r.k, r.v, r.DAY) for r in spark.table(f"{database}.t").collect()}
    assert rows == {("a", 9, "2026-01-02"), ("b", 2, "2026-01-02"), ("n", 3, stored.NO_DAY)}


def test_a_gate_on_stored_state_gives_the_full_recompute(spark):
    name, gate = catalog.refresh_base(spark, SF_DIR)
    columns = ["LINE", "BUCKET", "UNITS", "SCRAP_UNITS", "AVG_BOOTH_HUMIDITY"]
    got = {tuple(r) for r in catalog.refresh_stored(spark, name, gate).withColumn(
        "AVG_BOOTH_HUMIDITY", F.round("AVG_BOOTH_HUMIDITY", 6)).select(*columns).collect()}
    want = {tuple(r) for r in catalog.QUERIES["yield_by_line_hour"](spark, SF_DIR).withColumn(
        "AVG_BOOTH_HUMIDITY", F.round("AVG_BOOTH_HUMIDITY", 6)).select(*columns).collect()}
    assert got == want


def test_a_refresh_of_one_day_reads_one_day_of_stored_state(spark):
    name, gate = catalog.refresh_base(spark, SF_DIR)
    held = spark.table(f"{name}.YIELD_BY_LINE")
    day = held.groupBy(stored.DAY).agg(F.count("*").alias("n")).orderBy(stored.DAY).first()
    parts = spark.table(f"{name}.HEALTH_PARTS").where(F.col(stored.DAY) == day[0]).count()
    row = held.where(F.col(stored.DAY) == day[0]).first()
    change, folder, log = (shared_dir(spark, n) for n in ("change", "gate", "log"))
    spark.read.parquet(f"{gate}/images").limit(0).unionByName(spark.createDataFrame(
        [("k", row.LINE, "FAIL", row.BUCKET, "X", 1, 1)],
        "INSPECTION_ID string, LINE string, STATUS string, EVENT_TS timestamp_ntz, DEFECT_CODE string, IS_SCRAP int, _sign int"
    )).write.parquet(f"{folder}/images")
    spark.read.parquet(f"{gate}/readings").limit(0).write.parquet(f"{folder}/readings")
    with eventlog.recorded(spark, log):
        catalog.refresh_stored(spark, name, folder)
    # The day's yield once; its readings to be added to and, after that, to be joined; and the gate's few own rows.
    assert records_read(log) <= day.n + 2 * parts + 20
    after = spark.table(f"{name}.YIELD_BY_LINE").where((F.col("LINE") == row.LINE) & (F.col("BUCKET") == row.BUCKET)).first()
    assert (after.UNITS, after.SCRAP_UNITS) == (row.UNITS + 1, row.SCRAP_UNITS + 1)


def test_inventory_comes_from_the_catalog_without_reading_a_table(spark, database):
    by_day(spark, database, days=2)
    spark.sql(f"COMMENT ON TABLE {database}.t IS 'what it is'")
    spark.sql(f"CREATE VIEW {database}.w AS SELECT * FROM {database}.t")
    assert {(r.object_name, r.object_type, r.row_count) for r in stored.catalog_objects(spark, {"RAW": database}).collect()} == {
        ("T", "table", None), ("W", "view", None)}
    stored.count_rows(spark, f"{database}.t")
    folder = shared_dir(spark, "log")
    with eventlog.recorded(spark, folder):
        rows = {r.object_name: r for r in stored.catalog_objects(spark, {"RAW": database}).collect()}
    assert records_read(folder) == 0
    assert (rows["T"].row_count, rows["T"].what_it_is, rows["T"].schema_name) == (200, "what it is", "RAW")


def test_an_objects_own_comment_goes_before_the_expected_one(spark):
    built = spark.createDataFrame([("RAW", "STATION_TELEMETRY", 5, "mine"), ("RAW", "QUALITY_INSPECTIONS", 7, None)],
                                  "schema_name string, object_name string, row_count long, what_it_is string")
    rows = {r.object_name: (r.status, r.what_it_is) for r in checks.pipeline_inventory(spark, built).collect()}
    assert rows["STATION_TELEMETRY"] == ("built", "mine")
    assert rows["QUALITY_INSPECTIONS"] == ("built", "current state, kept by the merge")


def test_the_total_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 2 AS odd").write.parquet(path)
    df = tables.open_table_counts(spark, path, F.col("odd") == 1)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert "PushedAggregation: [COUNT(*)]" in text
    assert tuple(df.first()) == (1000, 500)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's session is as before


def test_statements_are_what_the_event_log_says(spark, tmp_path):
    folder = str(tmp_path / "log")
    with eventlog.recorded(spark, folder) as log:
        with eventlog.tagged(spark, "CDC_MERGE", operation="m1", strategy="full"):
            spark.range(37).write.parquet(str(tmp_path / "a"))
        spark.range(5).write.parquet(str(tmp_path / "b"))
        with pytest.raises(Exception), eventlog.tagged(spark, "CDC_MERGE", operation="m2", strategy="full"):
            spark.range(3).select(F.raise_error(F.lit("no")).alias("x")).write.parquet(str(tmp_path / "c"))
    spark.range(99).write.parquet(str(tmp_path / "d"))  # after the block: not in the log
    history = eventlog.statements(spark, log)
    rows = {(json.loads(r.query_tag)["operation"] if r.query_tag else None, r.rows_produced, r.failed) for r in history.collect()}
    assert {("m1", 37, False), (None, 5, False), ("m2", 0, True)} <= rows and not any(n == 99 for _, n, _ in rows)
    # Elapsed times are those between the start and the end in the file itself.
    times = {}
    for e in logged(folder):
        if e["Event"].endswith(("SQLExecutionStart", "SQLExecutionEnd")):
            times.setdefault(e["executionId"], []).append(e["time"])
    assert sorted(t[1] - t[0] for t in times.values()) == sorted(r.elapsed_ms for r in history.collect())
    audit = inspect.merge_audit(history, "CDC_MERGE").collect()
    assert {(r.connector_operation, r.merge_strategy, r.query_type) for r in audit} == {
        ("m1", "full", "MERGE"), ("m2", "full", "MERGE")}


def test_listener_keeps_batches_and_failures(spark, tmp_path):
    at = datetime(2026, 1, 1)
    source = str(tmp_path / "in")
    listener = watch.RefreshListener(spark, str(tmp_path / "log"))
    spark.streams.addListener(listener)

    def run(name, broken=False):
        rows = spark.readStream.schema(ROW).parquet(source)

        def put(batch, batch_id):
            if broken:
                raise RuntimeError("it broke")
            batch.write.mode("append").parquet(str(tmp_path / name))

        query = (watch.watched(rows, "at").writeStream.queryName(name).foreachBatch(put)
                 .option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start())
        return listener.drained(query)

    try:
        spark.createDataFrame([("a", at, 1)], ROW).write.mode("append").parquet(source)
        assert run("good") and run("bad")
        spark.createDataFrame([("b", at + timedelta(hours=2), 1)], ROW).write.mode("append").parquet(source)
        assert run("good") and not run("bad", broken=True)
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    listener.flush()  # nothing new, nothing written
    log = listener.read()
    assert log.count() == 4 and log.where("state = 'FAILED'").first().reason
    report = {r["name"]: (r.succeeded, r.failed, r.newest_data, r.lag_secs) for r in watch.refresh_report(log, at + timedelta(hours=3)).collect()}
    assert report == {"good": (2, 0, at + timedelta(hours=2), 3600), "bad": (1, 1, at, 3 * 3600)}
    assert serve.gold_lag(log, at + timedelta(hours=3), ["good", "bad"]).first().lag_secs == 3 * 3600


def test_report_of_a_table_that_never_succeeded(spark):
    log = spark.createDataFrame([("x", "r", None, None, "FAILED", None, None, None, "no")], watch.REFRESHES)
    assert tuple(watch.refresh_report(log, NOON).first()) == ("x", 0, 1, None, None)

"""Streams must leave what the batch forms compute, in any number of batches and through crashes."""

from datetime import datetime, timedelta

import pytest
from conftest import NOON, SF_DIR, as_set
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.operators import cdc, checks, refine
from lineside.plans import catalog, feeds
from lineside.session import held, shared_dir, sized_for
from lineside.streaming import landing, merging, pipeline, rollup
from lineside.streaming.parts import PartedTable, RunLog, day_part


@pytest.fixture
def events(spark):
    return feeds.events(spark, SF_DIR)


@pytest.fixture
def base(spark):
    return shared_dir(spark, "test")


def arriving(spark, base):
    return spark.readStream.schema(feeds.EVENTS).parquet(f"{base}/events")


def run_pipeline(spark, base, rekey=True):
    rows = arriving(spark, base)
    plant = pipeline.Plant.at(spark, f"{base}/plant", parts=4)
    query = pipeline.pipeline_stream(
        feeds.journal_of(rows, rekey), feeds.telemetry_of(rows), plant, f"{base}/checkpoint", keep=2)
    query.awaitTermination()
    return plant


def model(events, steps, rekey=True):
    """The destination after merging the same steps one by one."""
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    width = (high - low) // steps + 1
    batches = [
        (feeds.journal_of(events.where(F.col("event_id").between(low + i * width, low + (i + 1) * width - 1)), rekey),
         NOON) for i in range(steps)]
    return cdc.merge_batches(cdc.empty_target(batches[0][0]), batches)


def business(df):
    return df.select(*S.SOURCE_COLUMNS, "_deleted")


def check_plant(events, plant, steps):
    held = model(events, steps)
    live, health = refine.active(held), refine.station_health(feeds.telemetry_of(events))
    assert as_set(business(plant.inspections.read())) == as_set(business(held))
    assert as_set(plant.station_health()) == as_set(health)
    assert as_set(plant.defects.read()) == as_set(refine.defect_counts(live))
    assert as_set(plant.yields.read()) == as_set(refine.yield_by_line(live, health))


def test_pipeline_equals_the_batch_model_and_logs_every_refresh(spark, events, base):
    for _ in landing.land_in_steps(events, f"{base}/events", "event_id", 4):
        plant = run_pipeline(spark, base)
    check_plant(events, plant, 4)
    start, end = datetime(2024, 1, 5, 6), datetime(2024, 1, 7, 18)
    recent = plant.between(plant.yields, start, end)
    assert as_set(recent) == as_set(plant.yields.read().where(F.col("BUCKET").between(F.lit(start), F.lit(end))))
    assert 0 < len(recent.inputFiles()) < len(plant.yields.read().inputFiles())
    log = plant.log.read()
    assert {r["name"]: r["refreshes"] for r in checks.refresh_status(log).collect()} == {
        "QUALITY_INSPECTIONS": 4, "STATION_HEALTH": 4, "YIELD_BY_LINE_5MIN": 4, "DEFECT_COUNTS_5MIN": 4}
    last = log.where("action = 'MERGE'").orderBy(F.desc("batch_id")).first()
    assert last.merges == 4 and last.rows_total == log.agg(F.sum("rows_affected")).first()[0]


@pytest.mark.parametrize("table", ["inspections", "health", "yield", "defects"])
@pytest.mark.parametrize("moment", ["before commit", "after commit"])
def test_pipeline_survives_a_crash_around_any_commit(spark, events, base, monkeypatch, table, moment):
    crashes = []
    replace = PartedTable.replace

    def failing(self, rows, touched, batch):
        if self.path.endswith(table) and batch == 1 and not crashes:
            crashes.append(batch)
            if moment == "after commit":
                replace(self, rows, touched, batch)
            else:
                rows.write.mode("overwrite").parquet(f"{self.path}/data/v={batch}/_part=0")
            raise RuntimeError("executor lost")
        return replace(self, rows, touched, batch)

    monkeypatch.setattr(PartedTable, "replace", failing)
    for _ in landing.land_in_steps(events, f"{base}/events", "event_id", 2):
        try:
            plant = run_pipeline(spark, base)
        except StreamingQueryException:
            plant = run_pipeline(spark, base)
    assert crashes == [1]
    check_plant(events, plant, 2)


def test_merge_stream_skips_an_empty_gate(spark, events, base, journal):
    path = f"{base}/journal"

    def gate():
        store = merging.destination(spark, f"{base}/store", parts=2)
        log = RunLog(spark, f"{base}/runs")
        rows = spark.readStream.schema(S.JOURNAL).parquet(path)
        merging.merge_stream(rows, store, f"{base}/checkpoint", log).awaitTermination()
        return store.read(), log.read()

    journal(("a", S.INSERT, 1, 1, {}), ("b", S.INSERT, 1, 2, {})).write.parquet(path)
    gate()
    journal().write.mode("append").parquet(path)
    held, log = gate()
    assert held.count() == 2 and log.count() == 1
    journal(("a", "SchemaChangedRows", 2, 1, {})).write.mode("append").parquet(path)
    assert gate()[1].count() == 1
    journal(("b", S.DELETE, 3, 1, {}), ("c", S.DELETE, 3, 2, {})).write.mode("append").parquet(path)
    held, log = gate()
    assert {(r[S.KEY], r["_deleted"], r["STATUS"]) for r in held.collect()} == {
        ("a", False, "PASS"), ("b", True, "PASS"), ("c", True, None)}
    assert [(r.rows_affected, r.merges, r.rows_total) for r in log.orderBy("batch_id").collect()] == [
        (2, 1, 2), (2, 2, 4)]


def test_a_group_that_loses_its_last_row_leaves_the_gold_tables(spark, base, journal, frame):
    plant = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
    none = frame(S.TELEMETRY)
    early, late = datetime(2026, 1, 1), datetime(2026, 1, 2)
    pipeline.refresh_batch(plant, journal(
        ("a", S.INSERT, 1, 1, {"EVENT_TS": early}), ("b", S.INSERT, 1, 2, {"EVENT_TS": late})), none, 0)
    pipeline.refresh_batch(plant, journal(("a", S.UPDATE, 2, 1, {"EVENT_TS": late})), none, 1)
    assert [(r.BUCKET, r.UNITS) for r in plant.yields.read().collect()] == [(late, 2)]
    pipeline.refresh_batch(plant, journal(("a", S.DELETE, 3, 1, {}), ("b", S.DELETE, 3, 2, {})), none, 2)
    assert plant.yields.read().count() == 0 and plant.defects.read().count() == 0
    again = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
    assert again.yields.committed(2) and again.yields.read().count() == 0
    assert again.inspections.read().where("_deleted").count() == 2


def test_expire_drops_old_versions_and_keeps_the_before_image(spark, base, journal, frame):
    plant = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
    for n in range(4):
        pipeline.refresh_batch(plant, journal(("a", S.INSERT, n, 1, {}), (f"k{n}", S.INSERT, n, 2, {})),
                               frame(S.TELEMETRY), n)
    now, before = as_set(plant.inspections.read()), as_set(plant.inspections.read(before=3))
    assert plant.expire() > 0 and plant.expire() == 0
    again = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
    assert as_set(again.inspections.read()) == now and as_set(again.inspections.read(before=3)) == before
    assert again.inspections.batches() == [2, 3]
    pipeline.refresh_batch(again, journal(("a", S.DELETE, 9, 1, {})), frame(S.TELEMETRY), 4)
    assert again.yields.read().first().UNITS == 4


def test_late_humidity_restates_a_closed_bucket(spark, base, journal, frame):
    plant = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
    reading = {"STATION_ID": "s", "LINE": "PAINT", "METRIC": S.HUMIDITY, "EVENT_TS": NOON}
    pipeline.refresh_batch(
        plant, journal(("a", S.INSERT, 1, 1, {})), frame(S.TELEMETRY, {**reading, "VALUE": 40.0}), 0)
    pipeline.refresh_batch(plant, journal(), frame(S.TELEMETRY, {**reading, "VALUE": 70.0}), 1)
    row = plant.yields.read().first()
    assert (row.UNITS, row.AVG_BOOTH_HUMIDITY) == (1, 55.0)


def test_consume_once_through_a_crash(spark, events, base, monkeypatch):
    feeds.journal_of(events).write.parquet(f"{base}/journal")
    done = []

    def start():
        rows = spark.readStream.schema(S.JOURNAL).parquet(f"{base}/journal")
        query = landing.consume_once(rows, f"{base}/out", f"{base}/checkpoint")
        query.awaitTermination()

    from pyspark.sql.readwriter import DataFrameWriter
    write = DataFrameWriter.parquet

    def failing(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if "/out/" in path and not done:
            done.append(path)
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(StreamingQueryException):
        start()
    start()
    assert landing.read_consumed(spark, f"{base}/out", S.JOURNAL).count() == events.count()


def test_stateful_rollup_and_watermark(spark, base, frame):
    """Without a limit a late row restates its bucket, with one it is dropped."""
    def rows(*minutes):
        return frame(S.TELEMETRY, *[
            {"STATION_ID": "s", "LINE": "PAINT", "METRIC": "m", "VALUE": 1.0, "EVENT_TS": NOON + timedelta(minutes=m)}
            for m in minutes])

    def run(folder, limit):
        path, out = f"{base}/{folder}/in", rollup.health_store(spark, f"{base}/{folder}/health")
        for minutes in ([0, 60], [120], [1]):
            rows(*minutes).write.mode("append").parquet(path)
            updates = rollup.health_updates(spark.readStream.schema(S.TELEMETRY).parquet(path), late_limit=limit)
            rollup.upsert_stream(updates, out, refine.HEALTH_KEYS, f"{base}/{folder}/checkpoint").awaitTermination()
        return {r.BUCKET: r.READINGS for r in out.read().collect()}

    assert run("open", None)[NOON] == 2
    assert run("limited", "10 minutes")[NOON] == 1


def test_land_appends_each_file_once(spark, events, base):
    for _ in landing.land_in_steps(events, f"{base}/events", "event_id", 2):
        landing.land(feeds.telemetry_of(arriving(spark, base)), f"{base}/landed", f"{base}/checkpoint").awaitTermination()
    assert as_set(spark.read.schema(S.TELEMETRY).parquet(f"{base}/landed")) == as_set(feeds.telemetry_of(events))


def test_stream_progress(spark, events, base):
    for _ in landing.land_in_steps(events, f"{base}/events", "event_id", 1):
        query = landing.land(feeds.telemetry_of(arriving(spark, base)), f"{base}/landed", f"{base}/checkpoint")
        query.awaitTermination()
    rows = checks.stream_progress(query).where("rows_read > 0").collect()
    assert sum(r.rows_read for r in rows) == events.count()
    assert all(r.started_at and r.elapsed_ms is not None for r in rows)


def test_session_sizes(spark):
    conf = sized_for(100 << 40)
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(400 << 10)
    assert sized_for(1)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert path != shared_dir(spark, "x")
    assert root is None or path.startswith(root)


def test_refused_events_leave_neither_image(journal, spark, base):
    store = merging.destination(spark, f"{base}/guarded", guard=True)
    merging.merge_batch(store, journal(("a", S.INSERT, 5, 5, {S.KEY: "a"}), ("b", S.INSERT, 5, 6, {S.KEY: "b"})), 0).release()
    merged = merging.merge_batch(store, journal(
        ("a", S.UPDATE, 4, 4, {S.KEY: "a"}), ("b", S.UPDATE, 6, 6, {S.KEY: "b2"}), ("c", S.INSERT, 6, 7, {S.KEY: "c"})), 1)
    assert {r[S.KEY] for r in merged.before.collect()} == {"b"}
    assert {r[S.KEY] for r in merged.after.collect()} == {"b2", "c"}
    merged.release()


def test_rows_without_a_position_land_in_the_last_step(spark, base):
    rows = spark.range(10).selectExpr("CASE WHEN id < 8 THEN id END AS position", "id")
    assert list(landing.land_in_steps(rows, f"{base}/steps", "position", 3)) == [0, 1, 2]
    assert spark.read.parquet(f"{base}/steps").select("id").distinct().count() == 10
    assert {r.id for r in spark.read.parquet(f"{base}/steps/step=002").where("position IS NULL").collect()} == {8, 9}


def test_a_second_checkpoint_on_the_same_tables_keeps_both_streams(spark, base, journal, frame):
    """The second stream counts from 0 as the first did, before and after old versions are dropped."""
    def run(folder, rows, checkpoint):
        rows.write.mode("append").parquet(f"{base}/{folder}")
        plant = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
        pipeline.pipeline_stream(
            spark.readStream.schema(S.JOURNAL).parquet(f"{base}/{folder}"),
            spark.readStream.schema(S.TELEMETRY).parquet(f"{base}/readings"), plant, f"{base}/{checkpoint}").awaitTermination()
        return plant

    frame(S.TELEMETRY).write.parquet(f"{base}/readings")
    run("first", journal(("a", S.INSERT, 1, 1, {})), "c1")
    plant = run("second", journal(("b", S.INSERT, 2, 1, {})), "c2")
    assert {r[S.KEY] for r in plant.active().collect()} == {"a", "b"}
    plant.expire()
    run("first", journal(("c", S.INSERT, 3, 1, {})), "c1")
    plant = run("third", journal(("d", S.INSERT, 4, 1, {})), "c3")
    plant.expire()
    assert {r[S.KEY] for r in plant.active().collect()} == {"a", "b", "c", "d"}
    assert plant.yields.read().agg(F.sum("UNITS")).first()[0] == 4
    assert plant.log.read().where("action = 'MERGE'").agg(F.max("rows_total")).first()[0] == 4
    assert len({f.split("/v=")[1].split("/")[0] for f in plant.inspections.read().inputFiles()}) > 1


def test_a_second_checkpoint_consumes_beside_the_first(spark, base, journal):
    for name, key in (("c1", "a"), ("c2", "b")):
        journal((key, S.INSERT, 1, 1, {})).write.parquet(f"{base}/in-{name}")
        rows = spark.readStream.schema(S.JOURNAL).parquet(f"{base}/in-{name}")
        landing.consume_once(rows, f"{base}/out", f"{base}/{name}").awaitTermination()
    assert landing.read_consumed(spark, f"{base}/out", S.JOURNAL).count() == 2


def test_an_old_number_does_not_overwrite_a_live_folder(spark, base, journal):
    store = merging.destination(spark, f"{base}/store", parts=2)
    for n, key in enumerate("abcd"):
        merging.merge_batch(store, journal((key, S.INSERT, n, 1, {})), n).release()
    store.expire()
    with pytest.raises(ValueError, match="batch 0 after batch 3"):
        merging.merge_batch(store, journal(("e", S.INSERT, 9, 1, {})), 0)
    assert {r[S.KEY] for r in store.read().collect()} == {"a", "b", "c", "d"}


def test_expire_leaves_no_empty_version(spark, base, journal):
    store = merging.destination(spark, f"{base}/store", parts=1)
    for n in range(4):
        merging.merge_batch(store, journal(("a", S.INSERT, n, 1, {})), n).release()
    store.expire()
    versions = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{base}/store/data")
    assert {r.path.split("/v=")[1].split("/")[0] for r in versions.select("path").collect() if "/v=" in r.path} == {"2", "3"}


def test_a_failed_refresh_is_logged_with_its_reason(spark, base, journal, frame, monkeypatch):
    plant = pipeline.Plant.at(spark, f"{base}/plant", parts=2)
    events, replace = journal(("a", S.INSERT, 1, 1, {})), PartedTable.replace

    def failing(self, rows, touched, batch):
        if self.path.endswith("yield"):
            raise RuntimeError("disk full")
        return replace(self, rows, touched, batch)

    with monkeypatch.context() as patch:
        patch.setattr(PartedTable, "replace", failing)
        with pytest.raises(RuntimeError, match="disk full"):
            pipeline.refresh_batch(plant, events, frame(S.TELEMETRY), 0)
    failed = plant.log.read().where("state = 'FAILED'").collect()
    assert [(r.name, r.batch_id, r.reason) for r in failed] == [("YIELD_BY_LINE_5MIN", 0, "RuntimeError: disk full")]
    pipeline.refresh_batch(plant, events, frame(S.TELEMETRY), 0)
    states = {(r.name, r.state) for r in plant.log.read().collect()}
    assert {("YIELD_BY_LINE_5MIN", "FAILED"), ("YIELD_BY_LINE_5MIN", "SUCCEEDED")} <= states


def test_a_persisted_frame_has_only_the_partitions_it_fills(spark, events):
    """Else each of its nearly empty partitions writes a file for each partition of the next shuffle."""
    name = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(name)
    rows = held(refine.health_parts(feeds.telemetry_of(events)))
    try:
        assert rows.count() > 0 and rows.rdd.getNumPartitions() < int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get(name) == before
    finally:
        rows.unpersist()


def test_the_batch_persists_few_partitions(spark, base, journal):
    store = merging.destination(spark, f"{base}/store", parts=2)
    merged = merging.merge_batch(store, journal(("a", S.INSERT, 1, 1, {}), ("b", S.INSERT, 1, 2, {})), 0)
    assert merged.newest.rdd.getNumPartitions() == 1
    merged.release()


def test_a_long_history_has_a_bounded_number_of_parts(spark, events, base):
    """Years of events make no more parts, and so no more files, than a month does."""
    spread = events.withColumn("ts", F.col("ts") + F.make_dt_interval((F.col("event_id") * 5).cast("int")))
    spread.write.parquet(f"{base}/events.parquet")
    years = feeds.events(spark, base)
    assert years.select(F.col("ts").cast("date")).distinct().count() > 10 * catalog.SPANS
    plant = catalog._pipeline(spark, base, "long", steps=2)
    for table in (plant.health, plant.yields, plant.defects):
        assert 1 < len(table.snapshot()) <= catalog.SPANS + 1
    live, health = refine.active(model(years, 2, rekey=False)), refine.station_health(feeds.telemetry_of(years))
    assert as_set(plant.station_health()) == as_set(health)
    assert as_set(plant.defects.read()) == as_set(refine.defect_counts(live))
    assert as_set(plant.yields.read()) == as_set(refine.yield_by_line(live, health))
    days = years.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = days.a + (days.b - days.a) / 2
    whole, recent = plant.health.read(), plant.between(plant.health, middle, middle + timedelta(days=40))
    wanted = whole.where(F.col("BUCKET").between(F.lit(middle), F.lit(middle + timedelta(days=40))))
    assert as_set(recent) == as_set(wanted) and recent.count() > 0
    assert len(recent.inputFiles()) < len(whole.inputFiles())


def test_days_of_a_part_around_1970_and_without_a_time(spark):
    rows = spark.sql("SELECT CAST(t AS timestamp_ntz) AS BUCKET FROM VALUES "
                     "('1969-12-31 23:55:00'), ('1970-01-01 00:00:00'), ('1970-01-10 23:55:00'), ('1970-01-11 00:00:00'), (NULL) v(t)")
    named = rows.select("BUCKET", day_part("BUCKET", days=10)().alias("p")).collect()
    assert {str(r.BUCKET)[:10]: r.p for r in named} == {
        "1969-12-31": "1969-12-22", "1970-01-01": "1970-01-01", "1970-01-10": "1970-01-01", "1970-01-11": "1970-01-11",
        "None": "none"}


def test_the_stream_carries_only_what_a_layer_reads(spark, events):
    both = pipeline.tagged(feeds.journal_of(events), feeds.telemetry_of(events))
    assert not {"METADATA", "SEEN_AT"} & set(both.select("journal.*").columns)

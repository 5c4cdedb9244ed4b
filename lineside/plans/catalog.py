"""The registered queries: each takes a session and a data folder and returns a DataFrame.

All of them run on the whole ``events`` table. Those on streams replay it in a few steps through files in
the shared folder, and return what the streams left there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lineside import schemas as S
from lineside.functions import bucket
from lineside.functions.times import minutes
from lineside.operators import analyst, cdc, checks, metrics, refine, refresh, serve
from lineside.operators import journal as inspect
from lineside.plans import feeds
from lineside.plans.compared import AVERAGES, DECIMALS
from lineside.session import local_rows, shared_dir
from lineside.sources import eventlog, stored, tables
from lineside.streaming import landing, merging, pipeline, rollup, watch
from lineside.streaming.parts import PartedTable, RunLog, hash_part

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOUR, DAY = 60, 1440
STEPS = 3
KEY_SHAPE = r"^S-[0-9]+$"
MERGE_TAG = "CDC_MERGE"
SPANS = 64  # parts of a table stored by time


def query(build: Query) -> Query:
    """Register a query; averages are rounded as its SQL rounds them."""
    averages = AVERAGES.get(build.__name__)

    def compared(spark: SparkSession, d: str) -> DataFrame:
        return build(spark, d).withColumns({c: F.round(c, DECIMALS) for c in averages})

    QUERIES[build.__name__] = compared if averages else build
    return build


# --- shared inputs --------------------------------------------------------------------------------

# What the aggregates read of an inspection; the scan and the fold carry nothing else.
_YIELD = ("LINE", "STATUS", "EVENT_TS")
_NARROW = (*_YIELD, "DEFECT_CODE")


def _state(spark: SparkSession, d: str, columns=S.SOURCE_COLUMNS) -> DataFrame:
    feed = feeds.journal(spark, d)
    return cdc.settled(feed, feeds.seen_by(feed), columns=columns)


def _live(spark: SparkSession, d: str, columns=_NARROW) -> DataFrame:
    return refine.active(_state(spark, d, columns))


def _health(spark: SparkSession, d: str, width: int = 5) -> DataFrame:
    return refine.station_health(feeds.telemetry(spark, d), width)


def _yield(spark: SparkSession, d: str, width: int = 5) -> DataFrame:
    return refine.yield_by_line(_live(spark, d, _YIELD), _health(spark, d, width), width)


def _defects(spark: SparkSession, d: str, width: int = 5) -> DataFrame:
    return refine.defect_counts(_live(spark, d), width)


def _frames(spark: SparkSession, d: str, width: int = 5) -> dict[str, DataFrame]:
    live, health = _live(spark, d), _health(spark, d, width)
    return {"yield": refine.yield_by_line(live, health, width), "defects": refine.defect_counts(live, width),
            "stations": health}


def _now(spark: SparkSession, d: str) -> Column:
    return feeds.newest(feeds.events(spark, d), "ts")


def _two_merges(spark: SparkSession, d: str, rekey: bool = False) -> tuple[DataFrame, DataFrame]:
    """The destination after the first and after the second half of the feed."""
    first, second = feeds.halves(feeds.journal(spark, d, rekey))
    held = cdc.settled(first, feeds.seen_by(first))
    return held, cdc.merge(held, second, feeds.seen_by(second))


def _replay(
    spark: SparkSession, d: str, name: str, start: Callable[[DataFrame, str], StreamingQuery], steps: int = STEPS
) -> str:
    """Land the events in steps and drain the stream after each; returns the folder it all went to."""
    base = shared_dir(spark, name)
    for _ in landing.land_in_steps(feeds.events(spark, d), f"{base}/events", "event_id", steps):
        arriving = spark.readStream.schema(feeds.EVENTS).parquet(f"{base}/events")
        start(arriving, base).awaitTermination()
    return base


def _days_per_part(spark: SparkSession, d: str) -> int:
    """Days in a part, so that a table by time has about ``SPANS`` parts however long the feed is."""
    days = feeds.events(spark, d).agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0]
    return (days or 0) // SPANS + 1


# --- sources and sinks ----------------------------------------------------------------------------

@query
def journal_read(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark, 'journal')}/data"
    feeds.journal(spark, d).write.parquet(path)
    return tables.read_journal(spark, path)


@query
def telemetry_read(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark, 'telemetry')}/data"
    feeds.telemetry(spark, d).write.parquet(path)
    return tables.read_telemetry(spark, path)


@query
def telemetry_append_stream(spark: SparkSession, d: str) -> DataFrame:
    base = _replay(spark, d, "telemetry-land", lambda rows, base: landing.land(
        feeds.telemetry_of(rows), f"{base}/landed", f"{base}/checkpoint"))
    return tables.read_telemetry(spark, f"{base}/landed")


@query
def journal_append_stream(spark: SparkSession, d: str) -> DataFrame:
    base = _replay(spark, d, "journal-land", lambda rows, base: landing.land(
        feeds.journal_of(rows), f"{base}/landed", f"{base}/checkpoint"))
    return tables.read_journal(spark, f"{base}/landed")


@query
def journal_consume_once(spark: SparkSession, d: str) -> DataFrame:
    base = _replay(spark, d, "consume", lambda rows, base: landing.consume_once(
        feeds.journal_of(rows), f"{base}/consumed", f"{base}/checkpoint"))
    consumed = landing.read_consumed(spark, f"{base}/consumed", S.JOURNAL)
    return consumed.groupBy("EVENT_TYPE").agg(
        F.count("*").alias("CONSUMED"), F.min(S.LEAST).alias("FIRST_POSITION"), F.max(S.LEAST).alias("LAST_POSITION"))


@query
def committed_offset(spark: SparkSession, d: str) -> DataFrame:
    change = feeds.journal(spark, d).select(F.lit("cdc_journal_1").alias("channel"), F.col(S.LEAST).alias("at"))
    readings = feeds.events(spark, d).select(F.lit("telemetry_1").alias("channel"), F.col("event_id").alias("at"))
    return serve.committed_offset(change.unionByName(readings), "channel", "at")


def _published_yield(spark: SparkSession, d: str) -> str:
    path = f"{shared_dir(spark, 'published')}/yield"
    _yield(spark, d).write.parquet(path)
    return path


@query
def open_table_read(spark: SparkSession, d: str) -> DataFrame:
    return tables.open_table(spark, _published_yield(spark, d), ["LINE", "BUCKET", "UNITS", "FIRST_PASS_YIELD_PCT"],
                             F.col("LINE") == "PAINT")


@query
def open_table_counts(spark: SparkSession, d: str) -> DataFrame:
    return tables.open_table_counts(spark, _published_yield(spark, d), F.col("LINE") == "PAINT")


@query
def export_json_lines(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark, 'export')}/journal"
    tables.export_json_lines(feeds.journal(spark, d), path)
    return spark.read.text(path)


@query
def export_operations(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark, 'export')}/operations"
    tables.export_json_lines(tables.as_operations(feeds.inspections(feeds.events(spark, d)), "OP"), path)
    return spark.read.text(path)


@query
def latest_row_wins(spark: SparkSession, d: str) -> DataFrame:
    return serve.latest_row_wins(feeds.control(spark, d), ["OWNER"])


@query
def latest_mode(spark: SparkSession, d: str) -> DataFrame:
    return serve.latest_row_wins(feeds.control(spark, d))


@query
def seed_if_empty(spark: SparkSession, d: str) -> DataFrame:
    first, second = feeds.halves(feeds.journal(spark, d))
    held = cdc.settled(first, feeds.seen_by(first)).select(S.KEY, "LINE", "STATUS", "EVENT_TS")
    new = cdc.settled(second, feeds.seen_by(second)).select(S.KEY, "LINE", "STATUS", "EVENT_TS")
    return serve.insert_if_absent(held, new, [S.KEY])


# --- change data ----------------------------------------------------------------------------------

@query
def cdc_encode(spark: SparkSession, d: str) -> DataFrame:
    return feeds.journal(spark, d, rekey=True)


@query
def cdc_event_filter(spark: SparkSession, d: str) -> DataFrame:
    """The feed with a schema-change marker beside every delete; the markers must go."""
    feed = feeds.journal(spark, d)
    markers = feed.where(F.col("EVENT_TYPE") == S.DELETE).withColumn("EVENT_TYPE", F.lit("SchemaChangedRows"))
    return cdc.data_events(feed.unionByName(markers)).select(S.PK, "EVENT_TYPE", S.MOST, S.LEAST)


@query
def cdc_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return cdc.latest_per_key(feeds.journal(spark, d))


@query
def cdc_latest_per_key_stream(spark: SparkSession, d: str) -> DataFrame:
    names = ["EVENT_TYPE", "PAYLOAD__STATUS", "PAYLOAD__EVENT_TS"]
    schema = T.StructType([f for n in (S.PK, *names, *S.POSITION) for f in S.JOURNAL.fields if f.name == n])

    def start(rows: DataFrame, base: str) -> StreamingQuery:
        store = PartedTable(spark, f"{base}/latest", schema, hash_part(S.PK, parts=8))
        newest = cdc.latest_per_key(feeds.journal_of(rows), columns=names)
        return rollup.upsert_stream(newest, store, [S.PK], f"{base}/checkpoint")

    base = _replay(spark, d, "latest", start)
    return PartedTable(spark, f"{base}/latest", schema, hash_part(S.PK, parts=8)).read()


@query
def cdc_merge_apply(spark: SparkSession, d: str) -> DataFrame:
    return _two_merges(spark, d)[1]


@query
def cdc_soft_delete(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the first batch that the second one deleted: flagged, payload kept."""
    return _two_merges(spark, d)[1].where("_deleted AND _updated_at > _inserted_at")


@query
def cdc_tombstone(spark: SparkSession, d: str) -> DataFrame:
    """Rows that a delete of an unseen key left: a key and nothing else."""
    return _two_merges(spark, d)[1].where(F.col("_deleted") & F.col("STATUS").isNull())


@query
def cdc_revive(spark: SparkSession, d: str) -> DataFrame:
    """Keys that were deleted after the first batch and live after the second."""
    held, merged = _two_merges(spark, d)
    return merged.where("NOT _deleted").join(held.where("_deleted").select(S.KEY), S.KEY, "left_semi").select(
        *merged.columns)


@query
def cdc_key_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return _two_merges(spark, d, rekey=True)[1]


@query
def cdc_key_split(spark: SparkSession, d: str) -> DataFrame:
    """The same feed with a key change as a delete of the old key and an insert of the new one."""
    feed = cdc.split_key_changes(feeds.journal(spark, d, rekey=True))
    first, second = feeds.halves(feed)
    return cdc.merge(cdc.settled(first, feeds.seen_by(first)), second, feeds.seen_by(second))


@query
def cdc_position_guard(spark: SparkSession, d: str) -> DataFrame:
    """The second half first: with the guard, older events that arrive later change no row."""
    early, late = feeds.halves(feeds.journal(spark, d))
    schema = T.StructType(S.INSPECTIONS.fields + S.fields(_most=S.LONG, _least=S.LONG).fields)
    held = cdc.merge(local_rows(spark, [], schema), late, feeds.seen_by(late), guard=True)
    return cdc.merge(held, early, feeds.seen_by(late), guard=True).select(S.KEY, "STATUS", "_deleted", "_least")


@query
def cdc_merge_stream(spark: SparkSession, d: str) -> DataFrame:
    """Live rows of the stored destination after the stream; they do not depend on the batches."""
    base = _replay(spark, d, "merge", lambda rows, base: merging.merge_stream(
        feeds.journal_of(rows), merging.destination(spark, f"{base}/inspections"), f"{base}/checkpoint"))
    return refine.active(merging.destination(spark, f"{base}/inspections").read())


@query
def merge_log(spark: SparkSession, d: str) -> DataFrame:
    base = _replay(spark, d, "merge-log", lambda rows, base: merging.merge_stream(
        feeds.journal_of(rows), merging.destination(spark, f"{base}/inspections"), f"{base}/checkpoint",
        RunLog(spark, f"{base}/runs")))
    return RunLog(spark, f"{base}/runs").read().select("batch_id", "rows_affected", "merges", "rows_total")


@query
def snapshot_then_journal(spark: SparkSession, d: str) -> DataFrame:
    """A bulk load of the first half's live rows, then the journal of the rest."""
    first, second = feeds.halves(feeds.journal(spark, d))
    loaded = cdc.settled(first, feeds.seen_by(first)).where("NOT _deleted")
    return cdc.merge(loaded, second, feeds.seen_by(second))


@query
def journal_prune(spark: SparkSession, d: str) -> DataFrame:
    """What is left of the journal once its first half is merged and dropped."""
    feed = feeds.journal(spark, d)
    merged = feeds.halves(feed)[0].agg(F.max(S.LEAST)).scalar()
    return tables.prune_journal(feed, merged).select(S.PK, "EVENT_TYPE", S.MOST, S.LEAST)


@query
def direct_apply(spark: SparkSession, d: str) -> DataFrame:
    first, second = feeds.halves(feeds.journal(spark, d))
    held = cdc.settled(first, feeds.seen_by(first))
    cut = feeds.cut_at(feeds.journal(spark, d))
    rows = feeds.inspections(feeds.events(spark, d)).where(F.col("MOST") > cut)
    return cdc.direct_apply(held, rows, "OP", ["MOST", "LEAST"], feeds.seen_by(second))


@query
def journal_tail(spark: SparkSession, d: str) -> DataFrame:
    return inspect.journal_tail(feeds.journal(spark, d))


@query
def journal_metadata(spark: SparkSession, d: str) -> DataFrame:
    return inspect.journal_metadata(feeds.journal(spark, d))


@query
def event_mix(spark: SparkSession, d: str) -> DataFrame:
    return inspect.event_mix(feeds.journal(spark, d))


@query
def merge_backlog(spark: SparkSession, d: str) -> DataFrame:
    feed = feeds.journal(spark, d)
    first = feeds.halves(feed)[0]
    merged = first.agg(F.max(F.struct(*S.POSITION))).scalar()
    return inspect.merge_backlog(feed, cdc.settled(first, feeds.seen_by(first)), merged)


@query
def deleted_rows(spark: SparkSession, d: str) -> DataFrame:
    return inspect.deleted_rows(_two_merges(spark, d)[1])


@query
def rewritten_rows(spark: SparkSession, d: str) -> DataFrame:
    return inspect.rewritten_rows(_two_merges(spark, d)[1])


@query
def merge_audit(spark: SparkSession, d: str) -> DataFrame:
    return inspect.merge_audit(feeds.statement_history(spark, d), MERGE_TAG)


@query
def merge_audit_run(spark: SparkSession, d: str) -> DataFrame:
    """Merges that run here and now, found again in Spark's event log by their tag; another statement stands between them."""
    base = shared_dir(spark, "audit")
    events = feeds.events(spark, d)
    with eventlog.recorded(spark, f"{base}/log") as log:
        for step in landing.land_in_steps(events, f"{base}/events", "event_id", STEPS):
            landed = spark.read.schema(feeds.EVENTS).option("basePath", f"{base}/events").parquet(f"{base}/events/step=*")
            feed = feeds.journal_of(landed.where(F.col("step") == step))
            newest = cdc.newest_rows(feed)
            before = feeds.journal_of(landed.where(F.col("step") < step))
            held = cdc.settled(before, feeds.seen_by(before))
            now = feeds.seen_by(feed)
            merged = cdc.apply_newest(held, newest, now).where(F.col("_updated_at") == now)
            with eventlog.tagged(spark, MERGE_TAG, operation=f"cdc.merge.{step}", strategy="full_values"):
                merged.write.parquet(f"{base}/changed/step={step}")
    audit = inspect.merge_audit(eventlog.statements(spark, log), MERGE_TAG)
    return audit.select(
        "query_type", "rows_affected", "connector_operation", "merge_strategy", (F.col("merge_seconds") >= 0).alias("timed"))


# --- derived tables -------------------------------------------------------------------------------

@query
def inspections_active(spark: SparkSession, d: str) -> DataFrame:
    return refine.active(_state(spark, d))


@query
def station_health(spark: SparkSession, d: str) -> DataFrame:
    return _health(spark, d)


@query
def station_health_stream(spark: SparkSession, d: str) -> DataFrame:
    days = _days_per_part(spark, d)
    base = _replay(spark, d, "health", lambda rows, base: rollup.health_stream(
        feeds.telemetry_of(rows), rollup.health_store(spark, f"{base}/health", days_per_part=days), f"{base}/checkpoint"))
    return refine.health_table(rollup.health_store(spark, f"{base}/health", days_per_part=days).read())


@query
def station_health_stateful(spark: SparkSession, d: str) -> DataFrame:
    """The same rollup by a stateful aggregation in update mode."""
    days = _days_per_part(spark, d)

    def start(rows: DataFrame, base: str) -> StreamingQuery:
        store = rollup.health_store(spark, f"{base}/health", days_per_part=days)
        updates = rollup.health_updates(feeds.telemetry_of(rows))
        return rollup.upsert_stream(updates, store, refine.HEALTH_KEYS, f"{base}/checkpoint")

    base = _replay(spark, d, "health-state", start, steps=2)
    return refine.health_table(rollup.health_store(spark, f"{base}/health", days_per_part=days).read())


@query
def yield_by_line(spark: SparkSession, d: str) -> DataFrame:
    return _yield(spark, d)


@query
def yield_by_line_hour(spark: SparkSession, d: str) -> DataFrame:
    return _yield(spark, d, HOUR)


@query
def defect_counts(spark: SparkSession, d: str) -> DataFrame:
    return _defects(spark, d)


@query
def defect_counts_day(spark: SparkSession, d: str) -> DataFrame:
    return _defects(spark, d, DAY)


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Live rows after the first half and after the whole feed, with what the aggregates need."""
    first, second = feeds.halves(feeds.journal(spark, d))
    columns = (S.KEY, *_NARROW)
    held = cdc.settled(first, feeds.seen_by(first), columns=columns)
    merged = cdc.merge(held, second, feeds.seen_by(second), columns=columns)
    return refine.active(held), refine.active(merged)


GATE = 122  # events of the last gate


def _gate_cut(spark: SparkSession, d: str) -> Column:
    return feeds.newest(feeds.events(spark, d), "event_id") - GATE


def _changed(live: DataFrame, feed: DataFrame) -> DataFrame:
    """Signed images of the live rows that a gate's events change: the held rows of its keys, and what they become."""
    columns = (S.KEY, *_NARROW)
    newest = cdc.newest_rows(feed, columns=columns)
    before = live.join(newest.select(F.col(S.PK).alias(S.KEY)), S.KEY, "left_semi")
    after = refine.active(cdc.settled(feed, F.lit(None).cast("timestamp_ntz"), columns=columns))
    return refresh.signed(before, after.select(*live.columns))


def refresh_base(spark: SparkSession, d: str) -> tuple[str, str]:
    """What is stored before the last gate is refreshed: a database with hourly readings and yield by day, and the folder with
    the gate's changed rows and new readings, as its merge leaves them."""
    base = shared_dir(spark, "plant")
    name = "plant_" + base.rsplit("-", 1)[1]
    stored.open_database(spark, name, f"{base}/tables")
    events, cut = feeds.events(spark, d), _gate_cut(spark, d)
    old, arrived = events.where(F.col("event_id") <= cut), events.where(F.col("event_id") > cut)
    feed = feeds.journal_of(old)
    live = refine.active(cdc.settled(feed, feeds.seen_by(feed), columns=(S.KEY, *_NARROW)))
    parts = refine.health_parts(feeds.telemetry_of(old), HOUR)
    stored.publish(parts, f"{name}.HEALTH_PARTS", "readings rolled up, as sums and counts", at="BUCKET")
    gold = refine.yield_by_line(live, refine.health_table(parts), HOUR)
    stored.publish(gold, f"{name}.YIELD_BY_LINE", "yield joined with humidity", at="BUCKET")
    _changed(live, feeds.journal_of(arrived)).write.parquet(f"{base}/gate/images")
    feeds.telemetry_of(arrived).write.parquet(f"{base}/gate/readings")
    return name, f"{base}/gate"


def refresh_stored(spark: SparkSession, name: str, gate: str) -> DataFrame:
    """Bring the stored yield up to date with one gate: days without a changed row or a new reading are neither read nor written.

    Units and scrap take the signed counts of the changed rows, readings add up; the tables they came from are not read.
    """
    parts, gold = f"{name}.HEALTH_PARTS", f"{name}.YIELD_BY_LINE"
    delta = refine.yield_parts(spark.read.parquet(f"{gate}/images"), HOUR).withColumn(stored.DAY, stored.day_of("BUCKET"))
    added = refine.health_parts(tables.read_telemetry(spark, f"{gate}/readings"), HOUR).withColumn(stored.DAY, stored.day_of("BUCKET"))
    days = stored.days_touched(delta, added)
    health = refine.add_health(stored.read_days(spark, parts, days).unionByName(added)).withColumn(stored.DAY, stored.day_of("BUCKET"))
    stored.replace_days(health, parts)
    sums = ["UNITS", "SCRAP_UNITS"]
    held = refresh.add_parts(stored.read_days(spark, gold, days), delta, ["LINE", "BUCKET"], sums, "UNITS")
    fresh = refine.yield_table(held, refine.health_table(stored.read_days(spark, parts, days)))
    stored.replace_days(fresh.withColumn(stored.DAY, stored.day_of("BUCKET")), gold, days)
    return spark.table(gold).drop(stored.DAY)


@query
def incremental_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Yield stored by day for all but the last gate, then brought up to date by that gate."""
    return refresh_stored(spark, *refresh_base(spark, d))


@query
def incremental_refresh_groups(spark: SparkSession, d: str) -> DataFrame:
    """Yield of the first half, brought up to date by recomputing the changed groups only."""
    old, new = _versions(spark, d)
    groups = {"LINE": F.col("LINE"), "BUCKET": bucket("EVENT_TS", HOUR)}
    touched = refresh.changed_groups(refresh.changes(old, new, S.KEY), groups)
    health = _health(spark, d, HOUR)
    gold = refine.yield_by_line(old, health, HOUR)
    return refresh.refresh(gold, new, touched, groups, lambda rows: refine.yield_by_line(rows, health, HOUR))


@query
def incremental_refresh_delta(spark: SparkSession, d: str) -> DataFrame:
    """Defect counts of the first half plus the signed images of the changed rows."""
    old, new = _versions(spark, d)
    rows = refresh.changes(old, new, S.KEY)
    held = refine.defect_parts(old, HOUR)
    return refine.defect_table(
        refresh.add_parts(held, refine.defect_parts(rows, HOUR), refine.DEFECT_KEYS, ["N"], "N"))


@query
def restated_buckets(spark: SparkSession, d: str) -> DataFrame:
    old, new = _versions(spark, d)
    tables_ = [refine.yield_by_line(rows, _health(spark, d, DAY), DAY) for rows in (old, new)]
    return refresh.restated(*tables_, ["LINE", "BUCKET"], ["UNITS", "SCRAP_UNITS", "FIRST_PASS_YIELD_PCT"])


GATE_WIDTH = 1_000_000  # log positions of one gate


def _gates(spark: SparkSession, d: str) -> DataFrame:
    return refresh.gate_values(feeds.journal(spark, d), F.floor(F.col(S.MOST) / GATE_WIDTH), HOUR)


@query
def gate_values(spark: SparkSession, d: str) -> DataFrame:
    """Units and scrap of each bucket after every gate that changed it."""
    return _gates(spark, d)


@query
def restatements(spark: SparkSession, d: str) -> DataFrame:
    return refresh.restatements(_gates(spark, d))


def _pipeline(spark: SparkSession, d: str, name: str, steps: int = STEPS) -> pipeline.Plant:
    plants: dict[str, pipeline.Plant] = {}
    days = _days_per_part(spark, d)

    def start(rows: DataFrame, base: str) -> StreamingQuery:
        plant = plants.setdefault("plant", pipeline.Plant.at(spark, f"{base}/plant", days_per_part=days))
        return pipeline.pipeline_stream(
            feeds.journal_of(rows), feeds.telemetry_of(rows), plant, f"{base}/checkpoint")

    _replay(spark, d, name, start, steps)
    return plants["plant"]


@query
def pipeline_stream(spark: SparkSession, d: str) -> DataFrame:
    return _pipeline(spark, d, "pipeline").yields.read()


@query
def pipeline_stream_defects(spark: SparkSession, d: str) -> DataFrame:
    return _pipeline(spark, d, "pipeline-defects", steps=2).defects.read()


@query
def top_defect_per_bucket(spark: SparkSession, d: str) -> DataFrame:
    return refine.top_value(_defects(spark, d))


# --- serving --------------------------------------------------------------------------------------

@query
def recent_yield(spark: SparkSession, d: str) -> DataFrame:
    return serve.recent_yield(_yield(spark, d))


@query
def top_defects(spark: SparkSession, d: str) -> DataFrame:
    return serve.top_defects(_defects(spark, d), _now(spark, d), look_back=DAY)


@query
def top_defects_day(spark: SparkSession, d: str) -> DataFrame:
    return serve.top_defects(_defects(spark, d), _now(spark, d), look_back=DAY, n=None)


@query
def yield_series(spark: SparkSession, d: str) -> DataFrame:
    return serve.yield_series(_yield(spark, d), _now(spark, d))


@query
def yield_series_day(spark: SparkSession, d: str) -> DataFrame:
    return serve.yield_series(_yield(spark, d), _now(spark, d), look_back=DAY)


@query
def kpi_latest(spark: SparkSession, d: str) -> DataFrame:
    return serve.kpi_latest(serve.yield_series(_yield(spark, d), _now(spark, d)))


@query
def series_long(spark: SparkSession, d: str) -> DataFrame:
    return serve.series_long(serve.yield_series(_yield(spark, d), _now(spark, d), look_back=DAY))


@query
def gold_lag(spark: SparkSession, d: str) -> DataFrame:
    return serve.gold_lag(feeds.refresh_events(spark, d), _now(spark, d), ["YIELD_BY_LINE_5MIN", "DEFECT_COUNTS_5MIN"])


def _refresh_log(spark: SparkSession, d: str) -> DataFrame:
    """Two gold streams over three steps; the second one fails on the last step, where its rows break a check."""
    base = shared_dir(spark, "refreshes")
    events = feeds.events(spark, d)
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    last_step = low + (STEPS - 1) * ((high - low) // STEPS + 1) if low is not None else 0
    listener = watch.RefreshListener(spark, f"{base}/log")
    spark.streams.addListener(listener)

    def stream(name: str, rows: DataFrame) -> StreamingQuery:
        def put(batch: DataFrame, batch_id: int) -> None:
            gold = batch.groupBy("LINE", bucket("EVENT_TS", HOUR).alias("BUCKET")).agg(F.count("*").alias("N"))
            gold.write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")

        return (watch.watched(rows, "EVENT_TS").writeStream.queryName(name).foreachBatch(put)
                .option("checkpointLocation", f"{base}/checkpoint-{name}").trigger(availableNow=True).start())

    try:
        for _ in landing.land_in_steps(events, f"{base}/events", "event_id", STEPS):
            arriving = spark.readStream.schema(feeds.EVENTS).parquet(f"{base}/events")
            broken = F.when(F.col("event_id") >= last_step, F.raise_error(F.lit("reading out of range")).cast("double"))
            rows = feeds.inspections(arriving).select("LINE", "EVENT_TS")
            checked = feeds.inspections(arriving.withColumn("value", F.coalesce(broken, "value")).where("value IS NOT NULL"))
            for name, source in (("YIELD_BY_LINE_5MIN", rows), ("DEFECT_COUNTS_5MIN", checked.select("LINE", "EVENT_TS"))):
                listener.drained(stream(name, source))
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    return listener.read()


@query
def refresh_report(spark: SparkSession, d: str) -> DataFrame:
    """Refreshes, failures and lag of two gold streams that run here, from what Spark's listener was told."""
    return watch.refresh_report(_refresh_log(spark, d), _now(spark, d))


@query
def gold_lag_run(spark: SparkSession, d: str) -> DataFrame:
    return serve.gold_lag(_refresh_log(spark, d), _now(spark, d), ["YIELD_BY_LINE_5MIN", "DEFECT_COUNTS_5MIN"])


@query
def metric_query(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of three tables by two hub dimensions, named by their synonyms."""
    return metrics.metric_query(
        metrics.PLANT, _frames(spark, d, HOUR), ["production line", "when"],
        ["volume", "number of defects", "average sensor value", "peak reading"],
        where={"stage": lambda c: c != "WELD"})


@query
def metrics_all(spark: SparkSession, d: str) -> DataFrame:
    return metrics.metric_query(metrics.PLANT, _frames(spark, d), ["line"], list(metrics.PLANT.metrics))


@query
def metrics_by_station(spark: SparkSession, d: str) -> DataFrame:
    return metrics.metric_query(
        metrics.PLANT, _frames(spark, d), ["machine", "sensor"], ["average reading", "peak reading"])


@query
def weighted_yield(spark: SparkSession, d: str) -> DataFrame:
    """The weighted metric beside the mean of bucket percentages, which it must not be."""
    gold = _yield(spark, d, HOUR)
    weighted = metrics.metric_query(
        metrics.PLANT, {"yield": gold}, ["line"], ["avg_yield_pct", "total_units", "total_scrap"])
    naive = gold.groupBy(F.col("LINE").alias("line")).agg(
        F.avg(F.col("FIRST_PASS_YIELD_PCT").cast("double")).alias("mean_of_pct"))
    return weighted.join(naive, "line")


@query
def q1_yield_by_line(spark: SparkSession, d: str) -> DataFrame:
    return metrics.yield_by_line_question({"yield": _yield(spark, d)})


@query
def q2_defect_drivers(spark: SparkSession, d: str) -> DataFrame:
    return metrics.defect_drivers_question(_frames(spark, d))


@query
def q3_yield_vs_humidity(spark: SparkSession, d: str) -> DataFrame:
    return metrics.yield_humidity_question({"yield": _yield(spark, d)})


# --- analyst questions ----------------------------------------------------------------------------

@query
def latest_buckets(spark: SparkSession, d: str) -> DataFrame:
    return analyst.latest_buckets(_yield(spark, d), _now(spark, d))


@query
def line_health(spark: SparkSession, d: str) -> DataFrame:
    return analyst.line_health(analyst.latest_buckets(_yield(spark, d, DAY), _now(spark, d), width=DAY))


@query
def humidity_alerts(spark: SparkSession, d: str) -> DataFrame:
    return analyst.humidity_alerts(_yield(spark, d))


@query
def defect_share(spark: SparkSession, d: str) -> DataFrame:
    return analyst.defect_share(_defects(spark, d))


@query
def cause_order(spark: SparkSession, d: str) -> DataFrame:
    frames = _frames(spark, d, HOUR)
    return analyst.cause_order(frames["yield"], frames["defects"])


@query
def incidents(spark: SparkSession, d: str) -> DataFrame:
    frames = _frames(spark, d)
    return analyst.incidents(frames["yield"], frames["defects"])


@query
def yield_compare_nearest(spark: SparkSession, d: str) -> DataFrame:
    return analyst.yield_compare_nearest(_yield(spark, d), back=20, tolerance=120)


@query
def yield_compare(spark: SparkSession, d: str) -> DataFrame:
    return analyst.yield_compare(_yield(spark, d), back=20)


@query
def yield_compare_day(spark: SparkSession, d: str) -> DataFrame:
    return analyst.yield_compare(_yield(spark, d, HOUR), back=DAY)


@query
def control_compare(spark: SparkSession, d: str) -> DataFrame:
    return analyst.control_compare(_yield(spark, d), _now(spark, d) - minutes(10 * DAY))


# --- checks ---------------------------------------------------------------------------------------

JOURNAL_TABLE = "QUALITY_INSPECTIONS_JOURNAL_1787700000_1"  # fixed value: a journal's name as its connector makes it


@query
def pipeline_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Tables and a view are put into the catalog, counted by their statistics, and found there again."""
    base = shared_dir(spark, "inventory")
    shown = {name: f"{name.lower()}_{base.rsplit('-', 1)[1]}" for name in ("RAW", "ANALYTICS")}
    for name in shown.values():
        stored.open_database(spark, name, f"{base}/{name}")
    raw, analytics = shown.values()
    frames = {
        f"{raw}.QUALITY_INSPECTIONS": (_state(spark, d, (S.KEY,)), ""),
        f"{raw}.{JOURNAL_TABLE}": (feeds.journal(spark, d), ""),
        f"{raw}.STATION_TELEMETRY": (feeds.telemetry(spark, d), "readings of all stations"),
        f"{analytics}.INSPECTIONS_ACTIVE": (_live(spark, d), ""),
        f"{analytics}.STATION_HEALTH": (_health(spark, d), ""),
        f"{analytics}.YIELD_BY_LINE_5MIN": (_yield(spark, d), ""),
    }
    for table, (frame, what_it_is) in frames.items():
        stored.publish(frame, table, what_it_is)
        stored.count_rows(spark, table)
    spark.sql(f"CREATE VIEW {analytics}.PLANT_FLOOR AS SELECT * FROM {analytics}.YIELD_BY_LINE_5MIN")
    return checks.pipeline_inventory(spark, stored.catalog_objects(spark, shown))


@query
def column_contract(spark: SparkSession, d: str) -> DataFrame:
    return checks.column_contract(spark, {
        "INSPECTIONS_ACTIVE": refine.active(_state(spark, d)),
        "STATION_HEALTH": _health(spark, d),
        "YIELD_BY_LINE_5MIN": _yield(spark, d),
        "DEFECT_COUNTS_5MIN": _defects(spark, d).withColumnRenamed("N", "HOW_MANY"),
    })


@query
def refresh_history(spark: SparkSession, d: str) -> DataFrame:
    return checks.refresh_history(_pipeline(spark, d, "history", steps=2).log.read())


@query
def refresh_status(spark: SparkSession, d: str) -> DataFrame:
    return checks.refresh_status(_pipeline(spark, d, "status", steps=2).log.read())


def _named(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    live, health = refine.active(_state(spark, d, (S.KEY, *_NARROW))), _health(spark, d)
    return {"INSPECTIONS_ACTIVE": live, "STATION_HEALTH": health,
            "YIELD_BY_LINE_5MIN": refine.yield_by_line(live, health), "DEFECT_COUNTS_5MIN": refine.defect_counts(live)}


@query
def grain_check(spark: SparkSession, d: str) -> DataFrame:
    """The declared grains, and one that is too coarse: station health without its line."""
    frames = _named(spark, d)
    frames["INSPECTIONS_BY_LINE"] = frames["INSPECTIONS_ACTIVE"]
    return checks.grain_check(frames, {**S.GRAINS, "INSPECTIONS_BY_LINE": ("LINE", "EVENT_TS")})


def _links(spark: SparkSession, d: str) -> dict:
    frames = _frames(spark, d)
    return {name: (frames[r.many], frames[r.one], r.keys) for name, r in metrics.PLANT.relationships.items()}


@query
def reference_check(spark: SparkSession, d: str) -> DataFrame:
    return checks.reference_check(_links(spark, d))


@query
def domain_rules(spark: SparkSession, d: str) -> DataFrame:
    return (
        checks.broken_rules(feeds.journal(spark, d), checks.journal_rules(KEY_SHAPE))
        .unionByName(checks.broken_rules(_live(spark, d), checks.inspection_rules()))
        .unionByName(checks.broken_rules(feeds.telemetry(spark, d), checks.telemetry_rules()))
    )


@query
def preflight(spark: SparkSession, d: str) -> DataFrame:
    grains = checks.grain_check(_named(spark, d), S.GRAINS).agg(F.sum("REPEATED_KEYS")).scalar()
    lost = checks.reference_check(_links(spark, d))
    broken = checks.broken_rules(feeds.journal(spark, d), checks.journal_rules(KEY_SHAPE))
    return checks.preflight(spark, {
        "grains_unique": grains == 0,
        "defects_reach_yield": lost.where("RELATIONSHIP = 'defects_to_yield'").select("MISSING_KEYS").scalar() == 0,
        "stations_reach_yield": lost.where("RELATIONSHIP = 'stations_to_yield'").select("MISSING_KEYS").scalar() == 0,
        "journal_rules_hold": broken.agg(F.sum("BROKEN_ROWS")).scalar() == 0,
    })


@query
def table_growth(spark: SparkSession, d: str) -> DataFrame:
    feed = feeds.journal(spark, d)
    first = feeds.halves(feed)[0]
    earlier = checks.table_growth({
        "JOURNAL": (first, "SEEN_AT"),
        "QUALITY_INSPECTIONS": (cdc.settled(first, feeds.seen_by(first)), "EVENT_TS"),
    }, _now(spark, d))
    return checks.table_growth({
        "JOURNAL": (feed, "SEEN_AT"),
        "QUALITY_INSPECTIONS": (_state(spark, d), "EVENT_TS"),
        "STATION_TELEMETRY": (feeds.telemetry(spark, d), "EVENT_TS"),
    }, _now(spark, d), earlier)

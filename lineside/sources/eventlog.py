"""Spark's own event log as a table of statements: when each ran, how long, under which tag, and how many rows it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Events and their fields as Spark writes them, one JSON object a line.
EVENTS = """
Event string, executionId long, description string, time long, jobTags array<string>, errorMessage string,
`Stage IDs` array<long>, Properties map<string,string>, `Stage ID` long,
`Task End Reason` struct<Reason: string>, `Task Metrics` struct<`Output Metrics`: struct<`Records Written`: long>>
"""
STARTED = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
ENDED = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
JOB, TASK = "SparkListenerJobStart", "SparkListenerTaskEnd"
EXECUTION = "spark.sql.execution.id"
#: What a session puts before the tags given to it; its other tags are its own.
SESSION_TAG, GIVEN_TAG = "^spark-session-", "^spark-session-[0-9a-f-]{36}-thread-[0-9a-f-]{36}-"


@contextmanager
def recorded(spark: SparkSession, folder: str) -> Iterator[str]:
    """Spark's event log of what runs inside the block, in ``folder``; yields the path to read.

    For sessions that were started without ``spark.eventLog.enabled``: Spark's log writer is attached for the time of the block.
    """
    context = spark.sparkContext
    jvm, running = context._jvm, context._jsc.sc()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(path)
    conf = running.conf().clone()
    for name in ("compress", "rolling.enabled", "logStageExecutorMetrics"):
        conf = conf.set(f"spark.eventLog.{name}", "false")
    writer = jvm.org.apache.spark.scheduler.EventLoggingListener(
        f"statements-{uuid.uuid4().hex[:12]}", jvm.scala.Option.empty(), path.toUri(), conf, context._jsc.hadoopConfiguration())
    writer.start()
    running.addSparkListener(writer)
    try:
        yield folder
    finally:
        running.listenerBus().waitUntilEmpty()
        running.removeSparkListener(writer)
        writer.stop()


@contextmanager
def tagged(spark: SparkSession, name: str, **fields: str) -> Iterator[None]:
    """Statements inside the block carry a tag: its name, then its fields as ``field=value``, all split by semicolons."""
    tag = ";".join([name, *[f"{k}={v}" for k, v in fields.items()]])
    spark.addTag(tag)
    try:
        yield
    finally:
        spark.removeTag(tag)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", EVENTS).alias("e")).select("e.*")


def statements(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished statement and tag: start_time, elapsed_ms, rows_produced, failed, query_type, query_tag.

    ``query_tag`` is JSON with ``application``, the name of the tag, and its fields. A statement without a tag has one row with a
    NULL tag. Rows are those that its tasks wrote; the attempts of a task that failed are left out.
    """
    events = read_events(spark, path)
    given = F.filter(F.transform("jobTags", lambda t: F.regexp_replace(t, GIVEN_TAG, "")), lambda t: ~t.rlike(SESSION_TAG))
    started = events.where(F.col("Event") == STARTED).select(
        "executionId", F.col("time").alias("_from"), F.explode_outer(given).alias("_tag"))
    ended = events.where(F.col("Event") == ENDED).select(
        "executionId", F.col("time").alias("_to"), (F.coalesce("errorMessage", F.lit("")) != "").alias("failed"))
    stages = events.where(F.col("Event") == JOB).select(
        F.explode("Stage IDs").alias("Stage ID"), F.col("Properties")[EXECUTION].cast("long").alias("executionId")).distinct()
    wrote = events.where((F.col("Event") == TASK) & (F.col("Task End Reason.Reason") == "Success")).groupBy("Stage ID").agg(
        F.sum("Task Metrics.Output Metrics.Records Written").alias("n"))
    rows = stages.join(wrote, "Stage ID").groupBy("executionId").agg(F.sum("n").alias("rows_produced"))
    parts = F.split("_tag", ";")
    fields = F.expr("transform(slice(split(_tag, ';'), 2, 99), f -> struct(split(f, '=')[0] AS k, split(f, '=')[1] AS v))")
    tag = F.when(F.col("_tag").isNotNull(), F.to_json(F.map_concat(
        F.create_map(F.lit("application"), parts[0]), F.map_from_entries(fields))))
    return started.join(ended, "executionId").join(rows, "executionId", "left").select(
        F.timestamp_millis("_from").cast("timestamp_ntz").alias("start_time"),
        F.when(F.col("_tag").contains("MERGE"), "MERGE").otherwise("OTHER").alias("query_type"),
        F.coalesce("rows_produced", F.lit(0)).alias("rows_produced"),
        (F.col("_to") - F.col("_from")).alias("elapsed_ms"),
        "failed",
        F.lit(spark.sparkContext.appName).alias("warehouse_name"),
        tag.alias("query_tag"))

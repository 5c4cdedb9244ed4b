"""What the plans must look like, so that they hold on far larger data."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.operators import cdc, refine, refresh, serve
from lineside.plans import feeds
from lineside.plans.catalog import QUERIES
from lineside.sources import tables

STREAMING = {n for n in QUERIES if "stream" in n or n in {
    "journal_consume_once", "station_health_stateful", "merge_log", "refresh_history", "refresh_status"}}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """Both feeds and the gold table as files."""
    base = str(tmp_path_factory.mktemp("published"))
    feeds.journal(spark, SF_DIR).write.parquet(f"{base}/journal")
    feeds.telemetry(spark, SF_DIR).write.parquet(f"{base}/telemetry")
    QUERIES["yield_by_line"](spark, SF_DIR).write.parquet(f"{base}/yield")
    return base


def test_open_read_pushes_filter_and_columns_to_the_scan(spark, published):
    df = tables.open_table(spark, f"{published}/yield", ["LINE", "UNITS"], F.col("LINE") == "PAINT")
    assert "EqualTo(LINE,PAINT)" in plan(df)
    assert re.search(r"ReadSchema: struct<LINE:string,UNITS:int>", plan(df))


def test_yield_reads_only_the_columns_it_needs(spark, published):
    journal = tables.read_journal(spark, f"{published}/journal")
    live = refine.active(cdc.settled(journal, F.lit(None).cast("timestamp_ntz"), columns=("LINE", "STATUS", "EVENT_TS")))
    df = refine.yield_by_line(live, refine.station_health(tables.read_telemetry(spark, f"{published}/telemetry")))
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
    assert not any("OPERATOR" in r or "SKU" in r or "METADATA" in r for r in reads)
    assert "EqualTo(METRIC,booth_humidity)" in plan(df)
    assert "In(EVENT_TYPE" in plan(df)


def test_yield_aggregates_before_it_shuffles_and_joins_once(spark, published):
    journal = tables.read_journal(spark, f"{published}/journal")
    live = refine.active(cdc.settled(journal, F.lit(None).cast("timestamp_ntz"), columns=("LINE", "STATUS", "EVENT_TS")))
    text = plan(refine.yield_by_line(
        live, refine.station_health(tables.read_telemetry(spark, f"{published}/telemetry"))))
    assert "partial_max" in text and "partial_sum" in text
    assert len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", text)) == 1
    # One exchange per aggregate; the join adds none of its own beyond a broadcast.
    assert text.count("Exchange hashpartitioning") == 4


def test_without_broadcast_the_join_reuses_the_aggregates_partitioning(spark, published):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        journal = tables.read_journal(spark, f"{published}/journal")
        live = refine.active(cdc.settled(
            journal, F.lit(None).cast("timestamp_ntz"), columns=("LINE", "STATUS", "EVENT_TS")))
        text = plan(refine.yield_by_line(
            live, refine.station_health(tables.read_telemetry(spark, f"{published}/telemetry"))))
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_needs_no_global_sort(spark, published):
    gold = spark.read.parquet(f"{published}/yield")
    assert "TakeOrderedAndProject" in plan(serve.recent_yield(gold))


def test_small_merge_does_not_shuffle_the_target(spark, published):
    target = spark.read.schema(S.INSPECTIONS).parquet(f"{published}/journal")
    newest = cdc.newest_rows(tables.read_journal(spark, f"{published}/journal"))
    text = plan(cdc.apply_newest(target, newest, F.lit(None).cast("timestamp_ntz")))
    # The fold is small enough to be sent to the target; of the target only its keys are read a second time.
    assert "BroadcastHashJoin" in text and "FullOuter" not in text


def test_merge_and_refresh_read_only_what_they_need(spark, published):
    live = refine.active(cdc.settled(
        tables.read_journal(spark, f"{published}/journal"), F.lit(None).cast("timestamp_ntz"),
        columns=(S.KEY, "LINE", "STATUS", "EVENT_TS")))
    groups = {"LINE": F.col("LINE")}
    counts = refresh.refresh(
        refine.yield_parts(live), live, live.select("LINE").distinct(), groups,
        lambda rows: refine.yield_parts(rows))
    assert not any("SKU" in r or "DEFECT" in r for r in re.findall(r"ReadSchema: struct<([^>]*)>", plan(counts)))


def test_top_value_ranks_without_a_window(spark, published):
    counts = spark.read.schema("LINE string, BUCKET timestamp_ntz, DEFECT_CODE string, N int").parquet(
        f"{published}/yield")
    text = plan(refine.top_value(counts))
    assert "Window" not in text and "partial_min" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_windows_are_partitioned(spark):
    for name in set(QUERIES) - STREAMING:
        text = optimized(QUERIES[name](spark, SF_DIR))
        for line in text.splitlines():
            if re.match(r"[ :+-]*Window \[", line):
                assert re.search(r"\], \[[^\]]+\]", line), (name, line)

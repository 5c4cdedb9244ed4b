"""The two feeds, read out of the ``events`` table.

Every function is a projection, so that it serves a batch read and a stream read alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.operators import cdc

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Station and defect codes per line.
STATION_PREFIX = {"WELD": "ST-WELD", "PAINT": "ST-PAINT", "ASSEMBLY": "ST-ASSY"}
DEFECTS = {
    "WELD": ("WELD_POROSITY", "WELD_MISALIGN"),
    "PAINT": ("PAINT_RUN", "PAINT_ORANGE_PEEL"),
    "ASSEMBLY": ("ASSY_TORQUE", "ASSY_MISSING_PART"),
}
SKUS = ("FRAME-RD-54", "FRAME-RD-56", "FRAME-MTB-17", "FRAME-GRV-55")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _choose(index: str, values: Sequence[str]) -> str:
    """SQL for the value at an index."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), CAST({index} AS INT) + 1)"


def _by_line(line: str, values: Mapping[str, str]) -> str:
    """SQL for the value that belongs to a line."""
    return f"CASE {line} {' '.join(f'WHEN {name!r} THEN {value}' for name, value in values.items())} END"


def inspections(source: DataFrame, rekey: bool = False) -> DataFrame:
    """Source rows of the inspection table with their operation and log position.

    With ``rekey`` every fiftieth view event gives its row a new key.
    """
    moved = "event_type = 'view' AND event_id % 50 = 0" if rekey else "false"
    codes = {line: _choose("event_id % 2", pair) for line, pair in DEFECTS.items()}
    stations = {line: f"'{prefix}-01'" for line, prefix in STATION_PREFIX.items()}
    placed = source.selectExpr(
        "*",
        "concat('S-', user_id * 8 + event_id % 8) AS OLD_ID",
        f"{_choose('user_id % 3', S.LINES)} AS LINE",
        "(event_id - event_id % 10 + 10) * 1000 AS MOST",
    )
    return placed.selectExpr(
        "OLD_ID",
        f"CASE WHEN {moved} THEN concat(OLD_ID, '-r', event_id) ELSE OLD_ID END AS INSPECTION_ID",
        "concat('F-', event_id) AS UNIT_ID",
        "LINE",
        f"{_choose('event_id % 4', SKUS)} AS SKU",
        "CASE WHEN value >= 100 THEN 'FAIL' ELSE 'PASS' END AS STATUS",
        f"CASE WHEN value >= 100 THEN {_by_line('LINE', codes)} END AS DEFECT_CODE",
        f"{_by_line('LINE', stations)} AS STATION_ID",
        "concat('OP-', lpad(CAST(event_id % 12 + 1 AS STRING), 2, '0')) AS OPERATOR_ID",
        "ts AS EVENT_TS",
        "ts AS UPDATED_TS",
        f"CASE WHEN event_type = 'error' THEN '{S.DELETE}' WHEN event_type IN ('signup', 'purchase') THEN "
        f"'{S.INSERT}' WHEN event_type IN ('view', 'click') THEN '{S.UPDATE}' END AS OP",
        "MOST",
        "MOST + event_id % 10 + 1 AS LEAST",
    )


def journal_of(source: DataFrame, rekey: bool = False) -> DataFrame:
    return cdc.encode(inspections(source, rekey), "OP", "MOST", "LEAST", "EVENT_TS", old_key="OLD_ID")


def telemetry_of(source: DataFrame) -> DataFrame:
    line = _choose("event_id % 4", ("WELD", "PAINT", "PAINT", "ASSEMBLY"))
    prefixes = {name: f"'{prefix}'" for name, prefix in STATION_PREFIX.items()}
    return source.selectExpr("*", f"{line} AS LINE").selectExpr(
        f"concat({_by_line('LINE', prefixes)}, '-0', user_id % 2 + 1) AS STATION_ID",
        "LINE",
        f"{_choose('event_id % 4', S.METRICS)} AS METRIC",
        "value AS VALUE",
        "ts AS EVENT_TS",
    )


def journal(spark: SparkSession, sf_dir: str, rekey: bool = False) -> DataFrame:
    return journal_of(events(spark, sf_dir), rekey)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(events(spark, sf_dir))


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table: each user sets a mode with uneven spelling, some of them an empty one."""
    mode = F.when(F.col("event_type") == "click", "").otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
    return events(spark, sf_dir).select(
        F.col("user_id").alias("OWNER"), mode.alias("MODE"), F.col("ts").alias("UPDATED_AT"))


def statement_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement log; signups stand for the merges."""
    merges = F.col("event_type") == "signup"
    tag = F.to_json(F.struct(
        F.when(merges, "CDC_MERGE").otherwise("ADHOC").alias("application"),
        F.concat(F.lit("cdc."), F.col("event_type")).alias("operation"),
        F.lit("full_values").alias("strategy"),
    ))
    return events(spark, sf_dir).select(
        F.col("ts").alias("start_time"),
        F.when(merges, "MERGE").otherwise("SELECT").alias("query_type"),
        F.col("event_id").alias("rows_produced"),
        (F.col("value") * 100).cast("decimal(18,0)").cast("bigint").alias("elapsed_ms"),
        F.lit("WH").alias("warehouse_name"),
        tag.alias("query_tag"),
    )


def refresh_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh log of four tables with some failures."""
    return events(spark, sf_dir).select(
        F.expr(_choose("user_id % 4", tuple(S.GRAINS))).alias("name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("data_timestamp"),
    )


def cut_at(change_events: DataFrame) -> Column:
    """Log position halfway through the feed, as a scalar."""
    return change_events.agg(
        F.floor((F.min(S.MOST) + F.max(S.MOST)) / 2).alias("cut")).scalar()


def halves(change_events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The feed as two batches in log order."""
    cut = cut_at(change_events)
    return change_events.where(F.col(S.MOST) <= cut), change_events.where(F.col(S.MOST) > cut)


def seen_by(change_events: DataFrame) -> Column:
    """Time of the newest event, as a scalar: when the batch may have been merged."""
    return change_events.agg(F.max("SEEN_AT")).scalar()


def newest(frame: DataFrame, column: str) -> Column:
    return frame.agg(F.max(column)).scalar()

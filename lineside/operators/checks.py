"""Checks on the tables: inventory, contract, grain, references, domains, freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lineside import schemas as S
from lineside.functions.times import Stamp, seconds_between
from lineside.operators.refresh import same
from lineside.session import local_rows

# The objects of the pipeline, in the order they are built.
EXPECTED = (
    (1, "Part 1", "RAW", "QUALITY_INSPECTIONS", "table", "current state, kept by the merge"),
    (2, "Part 1", "RAW", "STATION_TELEMETRY", "table", "sensor readings as they arrive"),
    (9, "Part 1", "RAW", "SIMULATOR_CONTROL", "table", "control modes of the feeds"),
    (3, "Part 1", "RAW", "QUALITY_INSPECTIONS_JOURNAL", "journal", "change events"),
    (4, "Part 3", "ANALYTICS", "INSPECTIONS_ACTIVE", "derived", "live inspections"),
    (5, "Part 3", "ANALYTICS", "STATION_HEALTH", "derived", "readings rolled up per 5 minutes"),
    (6, "Part 3", "ANALYTICS", "YIELD_BY_LINE_5MIN", "derived", "yield joined with humidity"),
    (7, "Part 3", "ANALYTICS", "DEFECT_COUNTS_5MIN", "derived", "counts per defect code"),
    (8, "Part 4", "ANALYTICS", "PLANT_FLOOR", "metric view", "what questions are asked of"),
)
EXPECTED_COLUMNS = S.fields(
    seq=S.INT, part=S.STRING, schema_name=S.STRING, object_name=S.STRING, kind=S.STRING, what_it_is=S.STRING)


def built_objects(frames: Mapping[tuple[str, str], DataFrame | None]) -> DataFrame:
    """(schema, name, rows) of what exists; an entry without a frame has no row count."""
    some = next(f for f in frames.values() if f is not None)
    return reduce(DataFrame.unionByName, [
        (frame.agg(F.count("*").alias("row_count")) if frame is not None
         else some.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("row_count")))
        .select(F.lit(schema).alias("schema_name"), F.lit(name).alias("object_name"), "row_count")
        for (schema, name), frame in frames.items()
    ])


def _found(expected: str, built: str) -> Column:
    """Same schema and name; a journal, whose name ends in what its connector chose, by the start of its name."""
    name = F.col(f"{built}.object_name")
    by_name = (name == F.col(f"{expected}.object_name")) | (
        (F.col(f"{expected}.kind") == "journal") & name.startswith(F.col(f"{expected}.object_name")))
    return (F.col(f"{built}.schema_name") == F.col(f"{expected}.schema_name")) & by_name


def pipeline_inventory(spark: SparkSession, built: DataFrame, expected: Sequence[tuple] = EXPECTED) -> DataFrame:
    """Expected objects, whether they exist, how many rows they have and what they are.

    ``built`` has schema_name, object_name and row_count; a comment on the object itself (``what_it_is``), if there is one, goes before
    the expected one.
    """
    wanted = local_rows(spark, expected, EXPECTED_COLUMNS).alias("e")
    if "what_it_is" not in built.columns:
        built = built.withColumn("what_it_is", F.lit(None).cast("string"))
    return wanted.join(built.alias("b"), _found("e", "b"), "left").select(
        "e.seq", "e.part", "e.object_name", "e.kind",
        F.when(F.col("b.object_name").isNotNull(), "built").otherwise("-- NOT YET --").alias("status"),
        F.col("b.row_count").alias("approx_rows"),
        F.coalesce("b.what_it_is", "e.what_it_is").alias("what_it_is"),
    ).orderBy("seq")


def column_contract(
    spark: SparkSession, frames: Mapping[str, DataFrame], contract: Sequence[tuple] = S.CONTRACT
) -> DataFrame:
    """Declared columns against the actual ones, failures first, with the NULL count of each column.

    The NULLs of a table's contract columns are counted in one scan of the table.
    """
    wanted = local_rows(spark, contract, S.fields(object_name=S.STRING, column_name=S.STRING, expected_type=S.STRING))
    actual = [(t, f.name, S.type_family(f.dataType)) for t, frame in frames.items() for f in frame.schema]
    found = local_rows(spark, actual, S.fields(object_name=S.STRING, column_name=S.STRING, actual_type=S.STRING))
    nulls = []
    for table, frame in frames.items():
        present = [c for t, c, _ in contract if t == table and c in frame.columns]
        if present:
            counted = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
            nulls.append(counted.unpivot([], present, "column_name", "null_rows").select(
                F.lit(table).alias("object_name"), "column_name", "null_rows"))
    by = ["object_name", "column_name"]
    verdict = (
        F.when(F.col("actual_type").isNull(), "-- MISSING COLUMN --")
        .when(F.col("actual_type") != F.col("expected_type"), "-- WRONG TYPE --")
        .otherwise("ok")
    )
    return (
        wanted.join(found, by, "left").join(reduce(DataFrame.unionByName, nulls), by, "left")
        .select(*by, "expected_type", F.coalesce("actual_type", F.lit("-- absent --")).alias("actual_type"),
                verdict.alias("verdict"), "null_rows")
        .orderBy(F.when(F.col("verdict") == "ok", 1).otherwise(0), *by)
    )


def duplicates(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return frame.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def grain_check(frames: Mapping[str, DataFrame], grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows, distinct keys and repeated keys of each table under its declared grain."""
    def one(table: str) -> DataFrame:
        groups = frames[table].groupBy(*grains[table]).agg(F.count("*").alias("_n"))
        return groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("ROWS"),
            F.count("*").alias("KEYS"),
            F.count_if(F.col("_n") > 1).alias("REPEATED_KEYS"),
        ).select(F.lit(table).alias("TABLE_NAME"), "*")

    return reduce(DataFrame.unionByName, [one(t) for t in grains])


def reference_check(links: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """Per relationship, the rows and distinct keys of the many side that the one side lacks."""
    def one(name: str) -> DataFrame:
        many, single, keys = links[name]
        per_key = many.groupBy(*keys).agg(F.count("*").alias("_n"))
        lost = per_key.alias("m").join(single.select(*keys).alias("o"), same("m", "o", keys), "left_anti")
        return lost.agg(
            F.count("*").alias("MISSING_KEYS"), F.coalesce(F.sum("_n"), F.lit(0)).alias("MISSING_ROWS"),
        ).select(F.lit(name).alias("RELATIONSHIP"), "*")

    return reduce(DataFrame.unionByName, [one(n) for n in links])


def broken_rules(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows checked and rows that break each rule, in one pass; an undecided rule counts as broken."""
    counted = frame.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~F.coalesce(holds, F.lit(False))).alias(name) for name, holds in rules.items()])
    return counted.unpivot(["_rows"], list(rules), "RULE", "BROKEN_ROWS").select(
        "RULE", F.col("_rows").alias("CHECKED_ROWS"), "BROKEN_ROWS")


def journal_rules(key_shape: str = r"^S-[0-9a-f]{12}$") -> dict[str, Column]:
    """Rules of a change event."""
    payload = [F.col(S.payload(c)) for c in S.SOURCE_COLUMNS]
    is_delete = F.col("EVENT_TYPE") == S.DELETE
    empty = F.coalesce(*[p.cast("string") for p in payload]).isNull()
    return {
        "key_shape": F.col(S.PK).rlike(key_shape),
        "event_type": F.col("EVENT_TYPE").isin(*S.DATA_EVENTS),
        "positions_present": F.col(S.MOST).isNotNull() & F.col(S.LEAST).isNotNull(),
        "payload_empty_iff_delete": is_delete == empty,
    }


def inspection_rules() -> dict[str, Column]:
    """Rules of a live inspection."""
    return {
        "line_domain": F.col("LINE").isin(*S.LINES),
        "status_domain": F.col("STATUS").isin(*S.STATUSES),
        "code_empty_iff_pass": (F.col("STATUS") == "PASS") == F.col("DEFECT_CODE").isNull(),
    }


def telemetry_rules() -> dict[str, Column]:
    """Rules of a sensor reading."""
    return {
        "telemetry_line_domain": F.col("LINE").isin(*S.LINES),
        "metric_domain": F.col("METRIC").isin(*S.METRICS),
        "value_finite": F.col("VALUE").isNotNull() & ~F.isnan("VALUE") & (F.abs("VALUE") != float("inf")),
    }


def preflight(spark: SparkSession, checks: Mapping[str, Column]) -> DataFrame:
    """Named checks and a final row ``ALL`` that is true only if each of them is.

    A check is a scalar boolean column; NULL counts as failed.
    """
    rows = spark.range(1).select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    every = reduce(lambda a, b: a & b, [F.col(f"`{n}`") for n in checks])
    return rows.withColumn("ALL", every).unpivot([], [*checks, "ALL"], "CHECK_NAME", "OK")


def require(verdicts: DataFrame) -> DataFrame:
    """Stop on a failed preflight; the report has one row per named check."""
    failed = [r["CHECK_NAME"] for r in verdicts.where(~F.col("OK") & (F.col("CHECK_NAME") != "ALL")).collect()]
    if failed:
        raise RuntimeError(f"preflight failed: {', '.join(failed)}")
    return verdicts


def table_growth(
    frames: Mapping[str, tuple[DataFrame, str]], as_of: Stamp, earlier: DataFrame | None = None
) -> DataFrame:
    """Rows, newest time and age in seconds per table; with earlier counts, how much each has grown."""
    rows = reduce(DataFrame.unionByName, [
        frame.agg(F.count("*").alias("ROWS"), F.max(at).alias("NEWEST")).select(
            F.lit(name).alias("TABLE_NAME"), "*")
        for name, (frame, at) in frames.items()
    ])
    out = rows.withColumn("AGE_SECS", seconds_between(F.col("NEWEST"), as_of))
    if earlier is None:
        return out
    held = earlier.select("TABLE_NAME", F.col("ROWS").alias("EARLIER_ROWS"))
    grown = F.col("ROWS") - F.coalesce("EARLIER_ROWS", F.lit(0))
    return out.join(held, "TABLE_NAME", "left").withColumn("GROWN", grown).withColumn("IS_CLIMBING", grown > 0)


def refresh_history(log: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` refreshes."""
    return log.orderBy(F.desc("started_at"), F.desc("name")).limit(n).select(
        "name", "started_at", "action", "state", "rows_inserted", "rows_deleted")


def refresh_status(log: DataFrame) -> DataFrame:
    """Newest mode of each table and why it fell back to a full refresh, if it did."""
    newest = F.max_by(F.struct("mode", "state", "reason"), F.struct("started_at", "batch_id")).alias("_n")
    return log.groupBy("name").agg(newest, F.count("*").alias("refreshes")).select(
        "name",
        F.col("_n.mode").alias("refresh_mode"),
        F.col("_n.state").alias("last_state"),
        F.nullif(F.col("_n.reason"), F.lit("")).alias("downgrade_reason"),
        "refreshes",
    ).orderBy("name")


def stream_progress(query: StreamingQuery) -> DataFrame:
    """What the query itself reports of its last batches: the engine keeps at most a hundred."""
    rows = [
        (p.batchId, p.name, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution")) for p in query.recentProgress]
    schema = S.fields(batch_id=S.LONG, name=S.STRING, started_at=S.STRING, rows_read=S.LONG, elapsed_ms=S.LONG)
    return local_rows(SparkSession.active(), rows, schema).withColumn(
        "started_at", F.to_timestamp_ntz("started_at", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))

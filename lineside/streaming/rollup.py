"""Streaming forms of the keyed aggregates.

Two ways to the same figures: additive parts merged into a stored table, whose state is the table itself
and so is bounded by nothing but disk; and a stateful aggregation in update mode, whose state sits in the
state store and grows with the groups unless a watermark, which drops late rows, bounds it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lineside import schemas as S
from lineside.operators import refine
from lineside.session import held
from lineside.streaming.landing import DRAIN
from lineside.streaming.parts import Numbers, PartedTable, day_part

HEALTH_PARTS = S.fields(
    STATION_ID=S.STRING, LINE=S.STRING, METRIC=S.STRING, BUCKET=S.NTZ, READINGS=S.LONG, VALUES_N=S.LONG,
    VALUE_SUM=S.DOUBLE, MAX_VALUE=S.DOUBLE)


def health_store(spark: SparkSession, path: str, parts_per_day: int = 1, days_per_part: int = 1) -> PartedTable:
    return PartedTable(spark, path, HEALTH_PARTS, day_part("BUCKET", "LINE", parts=parts_per_day, days=days_per_part))


def add_readings(store: PartedTable, telemetry: DataFrame, batch: int, width: int = 5) -> tuple[set[str], int, int]:
    """Add one batch of readings to the stored parts; returns the touched parts and the row counts."""
    change = held(refine.health_parts(telemetry, width))
    try:
        touched = store.parts_of(change)
        if not touched or store.committed(batch):
            return touched, 0, 0
        added = refine.add_health(store.read(touched, before=batch).unionByName(change))
        return touched, *store.replace(added, touched, batch)
    finally:
        change.unpersist()


def health_stream(
    telemetry: DataFrame, store: PartedTable, checkpoint: str, width: int = 5, trigger: dict = DRAIN
) -> StreamingQuery:
    """Station health kept up to date by adding each batch's parts."""
    numbers = Numbers(store.spark, f"{store.path}/numbers")

    def add(readings: DataFrame, batch_id: int) -> None:
        number = numbers.of(readings, batch_id)
        if number is not None:
            add_readings(store, readings, number, width)

    return (telemetry.writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint).queryName("health").trigger(**trigger).start())


def health_updates(telemetry: DataFrame, width: int = 5, late_limit: str | None = None) -> DataFrame:
    """The rollup as a stateful aggregation.

    Without a limit late rows restate their bucket and the state keeps every group. With one, state older
    than the limit is dropped, and so are rows that come later than that or have no time. A watermark
    wants an instant, so the time is read in the session zone, which must be UTC, and back again.
    """
    if late_limit is None:
        return refine.health_parts(telemetry, width)
    limited = telemetry.withColumn("EVENT_TS", F.col("EVENT_TS").cast("timestamp")).withWatermark("EVENT_TS", late_limit)
    parts = refine.health_parts(limited, width, F.window("EVENT_TS", f"{width} minutes"))
    return parts.withColumn("BUCKET", F.col("BUCKET.start").cast("timestamp_ntz"))


def upsert(store: PartedTable, rows: DataFrame, keys: Sequence[str], batch: int) -> None:
    """Replace the stored rows of the given keys."""
    rows = held(rows)
    try:
        touched = store.parts_of(rows)
        if not touched or store.committed(batch):
            return
        names = store.schema.names
        old = store.read(touched, before=batch).select(F.lit(0).alias("_new"), F.struct(*names).alias("_row"), *keys)
        fresh = rows.select(F.lit(1).alias("_new"), F.struct(*names).alias("_row"), *keys)
        newest = old.unionByName(fresh).groupBy(*keys).agg(F.max_by("_row", "_new").alias("_row"))
        store.replace(newest.select("_row.*"), touched, batch)
    finally:
        rows.unpersist()


def upsert_stream(
    rows: DataFrame, store: PartedTable, keys: Sequence[str], checkpoint: str, trigger: dict = DRAIN
) -> StreamingQuery:
    """Keep the newest row per key of an updating aggregate."""
    numbers = Numbers(store.spark, f"{store.path}/numbers")

    def put(batch: DataFrame, batch_id: int) -> None:
        number = numbers.of(batch, batch_id)
        if number is not None:
            upsert(store, batch, keys, number)

    return (rows.writeStream.outputMode("update")
            .foreachBatch(put)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())

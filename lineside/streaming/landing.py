"""Append-only landing of feeds, and consuming each landed row once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lineside.streaming.parts import stream_id

DRAIN = {"availableNow": True}


def gate(seconds: int) -> dict:
    """Trigger that starts a batch every ``seconds``, on the multiples of that interval."""
    return {"processingTime": f"{seconds} seconds"}


def land(rows: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Append a stream to a parquet folder; the sink's own log makes each batch count once."""
    return (rows.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def consume_once(rows: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Write each batch under its stream and number.

    A batch that is run again after a crash overwrites its folder, so every landed row counts once
    although ``foreachBatch`` may call twice. A new checkpoint is a new stream and overwrites nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{path}/stream={stream_id(batch)}/batch={batch_id}")

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def read_consumed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/stream=*/batch=*")


def land_in_steps(rows: DataFrame, path: str, position: str, steps: int):
    """Land a batch table in a few steps, in order of ``position``; yields after each step.

    Gives a replayed feed the arrival order of a live one. Rows without a position come in the last step.
    """
    low, high = rows.agg(F.min(position), F.max(position)).first()
    low, high = (0, 0) if low is None else (low, high)
    width = (high - low) // steps + 1
    for i in range(steps):
        start = low + i * width
        here = (F.col(position) >= start) & (F.col(position) < start + width)
        (rows.where(here | F.col(position).isNull() if i == steps - 1 else here)
         .write.mode("overwrite").parquet(f"{path}/step={i:03d}"))
        yield i

"""The whole pipeline at one lag: both feeds in, every layer refreshed in order, by changed group."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lineside import schemas as S
from lineside.functions.times import stamp
from lineside.operators import refine
from lineside.operators.refresh import add_parts, signed
from lineside.session import held, local_rows
from lineside.streaming.landing import DRAIN
from lineside.streaming.merging import Merged, destination, merge_batch
from lineside.streaming.parts import Numbers, PartedTable, RunLog, day_part, utc_now
from lineside.streaming.rollup import add_readings, health_store

YIELD = S.fields(
    LINE=S.STRING, BUCKET=S.NTZ, UNITS=S.INT, SCRAP_UNITS=S.INT,
    FIRST_PASS_YIELD_PCT=T.DecimalType(5, 2), AVG_BOOTH_HUMIDITY=S.DOUBLE)
MERGED = T.StructType([f for f in S.JOURNAL.fields if f.name not in ("SEEN_AT", "METADATA")])
DEFECTS = S.fields(LINE=S.STRING, BUCKET=S.NTZ, DEFECT_CODE=S.STRING, N=S.INT)


@dataclass
class Plant:
    """The stored tables of one pipeline."""

    inspections: PartedTable
    health: PartedTable
    yields: PartedTable
    defects: PartedTable
    log: RunLog
    numbers: Numbers
    days_per_part: int = 1

    @classmethod
    def at(
        cls, spark: SparkSession, path: str, parts: int = 16, parts_per_day: int = 1, days_per_part: int = 1
    ) -> Plant:
        """Tables below ``path``. The three bucketed tables share their parts, so a refresh of one day's
        yield reads that day's humidity and nothing else. Each part is a file at least, so a long history of
        small days wants several ``days_per_part``. All of them are fixed for the life of the tables."""
        day = day_part("BUCKET", "LINE", parts=parts_per_day, days=days_per_part)
        return cls(
            destination(spark, f"{path}/inspections", parts),
            health_store(spark, f"{path}/health", parts_per_day, days_per_part),
            PartedTable(spark, f"{path}/yield", YIELD, day),
            PartedTable(spark, f"{path}/defects", DEFECTS, day),
            RunLog(spark, f"{path}/runs"),
            Numbers(spark, f"{path}/numbers"),
            days_per_part,
        )

    def active(self) -> DataFrame:
        return refine.active(self.inspections.read())

    def station_health(self) -> DataFrame:
        return refine.health_table(self.health.read())

    def expire(self, keep: int = 2) -> int:
        """Drop old versions of every stored table, and old batch numbers."""
        self.numbers.expire()
        return sum(t.expire(keep) for t in (self.inspections, self.health, self.yields, self.defects))

    def between(self, table: PartedTable, start: datetime, end: datetime) -> DataFrame:
        """Rows of a bucketed table from ``start`` to ``end``; a look-back opens the files of its days only."""
        earliest = max(1, start.toordinal() - self.days_per_part + 1)  # first day of a part that reaches to ``start``
        first, last = date.fromordinal(earliest).isoformat(), end.date().isoformat()
        days = [p for p in table.snapshot() if first <= p[:10] <= last]
        return table.read(days).where(F.col("BUCKET").between(stamp(start), stamp(end)))

    def frames(self) -> dict[str, DataFrame]:
        """The three tables of the metric layer."""
        return {"yield": self.yields.read(), "defects": self.defects.read(), "stations": self.station_health()}


def _both(spark: SparkSession, first: Callable, second: Callable) -> tuple:
    """Run two independent layers at the same time, as jobs of the caller's query; an error in either fails the batch."""
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(f)) for f in (first, second)]
        return jobs[0].result(), jobs[1].result()


def _entry(name: str, started: datetime, counts: tuple[int, int]) -> dict:
    return {
        "name": name, "action": "INCREMENTAL", "started_at": started, "rows_inserted": counts[0],
        "rows_deleted": counts[1], "seconds": (utc_now() - started).total_seconds()}


def refresh_batch(plant: Plant, events: DataFrame, telemetry: DataFrame, batch: int, width: int = 5) -> None:
    """Bring every layer up to this batch, upstream first.

    Each layer commits on its own and is skipped when the batch runs again, so a crash between two layers
    is mended by the next attempt. Yield and defects add the signed before- and after-images of the
    changed rows; the destination is not read again.
    """
    entries: list[dict] = []

    def health() -> set[str]:
        started = utc_now()
        with plant.log.watch("STATION_HEALTH", "INCREMENTAL", batch):
            days, written, replaced = add_readings(plant.health, telemetry, batch, width)
        if days:
            entries.append(_entry("STATION_HEALTH", started, (written, replaced)))
        return days

    def inspections() -> Merged | None:
        with plant.log.watch("QUALITY_INSPECTIONS", "MERGE", batch):
            return merge_batch(plant.inspections, events, batch)

    humid, merged = _both(events.sparkSession, health, inspections)
    if merged:
        entries.append(merged.entry)
        rows = held(signed(refine.active(merged.before), refine.active(merged.after)))
    else:
        empty = refine.active(local_rows(events.sparkSession, [], S.INSPECTIONS))
        rows = signed(empty, empty)
    try:
        counts = refine.defect_parts(rows, width)
        days = plant.defects.parts_of(counts)

        def defects() -> None:
            started = utc_now()
            if days and not plant.defects.committed(batch):
                with plant.log.watch("DEFECT_COUNTS_5MIN", "INCREMENTAL", batch):
                    old = plant.defects.read(days, before=batch)
                    table = refine.defect_table(add_parts(old, counts, refine.DEFECT_KEYS, ["N"], "N"))
                    entries.append(_entry("DEFECT_COUNTS_5MIN", started, plant.defects.replace(table, days, batch)))

        def yields() -> None:
            started = utc_now()
            touched = days | humid
            if touched and not plant.yields.committed(batch):
                with plant.log.watch("YIELD_BY_LINE_5MIN", "INCREMENTAL", batch):
                    old = plant.yields.read(touched, before=batch)
                    parts = add_parts(
                        old, refine.yield_parts(rows, width), refine.YIELD_KEYS, ["UNITS", "SCRAP_UNITS"], "UNITS")
                    table = refine.yield_table(parts, refine.health_table(plant.health.read(touched)))
                    entries.append(_entry("YIELD_BY_LINE_5MIN", started, plant.yields.replace(table, touched, batch)))

        _both(events.sparkSession, defects, yields)
    finally:
        rows.unpersist()
        if merged:
            merged.release()
    if entries:
        plant.log.write(batch, sorted(entries, key=lambda e: e["started_at"]))


def tagged(journal: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Both feeds as one stream, so that one batch carries what either has new, without what no layer reads."""
    def side(frame: DataFrame, name: str) -> DataFrame:
        columns = []
        for tag, schema in (("journal", MERGED), ("telemetry", S.TELEMETRY)):
            whole = F.struct(*schema.names) if tag == name else F.lit(None).cast(_nullable(schema))
            columns.append(whole.alias(tag))
        return frame.select(F.lit(name).alias("feed"), *columns)

    return side(journal, "journal").unionByName(side(telemetry, "telemetry"))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def pipeline_stream(
    journal: DataFrame,
    telemetry: DataFrame,
    plant: Plant,
    checkpoint: str,
    width: int = 5,
    trigger: dict = DRAIN,
    keep: int | None = None,
) -> StreamingQuery:
    """Run the pipeline over two streams; ``trigger=gate(60)`` gives a target lag of a minute.

    With ``keep`` each batch also drops the versions that only commits before the newest ``keep`` need.
    """
    def refresh(batch: DataFrame, batch_id: int) -> None:
        events = batch.where(F.col("feed") == "journal").select("journal.*")
        readings = batch.where(F.col("feed") == "telemetry").select("telemetry.*")
        number = plant.numbers.of(batch, batch_id)
        if number is None:
            return
        refresh_batch(plant, events, readings, number, width)
        if keep:
            plant.expire(keep)

    return (tagged(journal, telemetry).writeStream.foreachBatch(refresh)
            .option("checkpointLocation", checkpoint).queryName("pipeline").trigger(**trigger).start())

"""The change feed applied to a stored destination, one batch per gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lineside import schemas as S
from lineside.functions.times import stamp
from lineside.operators import cdc
from lineside.session import held
from lineside.streaming.landing import DRAIN
from lineside.streaming.parts import Numbers, PartedTable, RunLog, hash_part, utc_now


def destination(spark: SparkSession, path: str, parts: int = 16, guard: bool = False) -> PartedTable:
    """The mutable inspections table, spread by key.

    ``parts`` bounds what a small batch rewrites: choose it so that a part is a few hundred MB. It is
    fixed for the life of the table.
    """
    extra = S.fields(_most=S.LONG, _least=S.LONG).fields if guard else []
    schema = T.StructType([*S.INSPECTIONS.fields, *extra, *S.fields(_batch=S.LONG).fields])
    return PartedTable(spark, path, schema, hash_part(S.KEY, parts=parts))


@dataclass
class Merged:
    """What a batch did: rows as they were, rows as they are, and the figures for the log."""

    before: DataFrame
    after: DataFrame
    rows: int
    entry: dict
    newest: DataFrame

    def release(self) -> None:
        """Drop the cached batch once the images are no longer needed."""
        self.newest.unpersist()


def merge_batch(store: PartedTable, events: DataFrame, batch: int) -> Merged | None:
    """Merge one batch into the store; None if it holds no change.

    Run again for a batch that was committed already, it changes nothing and returns the same images, so
    that later layers can catch up.
    """
    started = utc_now()
    # Time and number travel as columns: as literals they would give every batch code of its own to compile.
    newest = held(cdc.newest_rows(events).withColumns({"_now": stamp(started), "_no": F.lit(batch)}))
    try:
        rows, touched = _touched(store, newest)
        if rows == 0:
            newest.unpersist()
            return None
        old = store.read(touched, before=batch)
        guarded = "_most" in store.schema.names
        written = replaced = 0
        if not store.committed(batch):
            merged = cdc.apply_newest(
                old, newest, F.col("_now"), guard=guarded, batch=F.col("_no"))
            written, replaced = store.replace(merged, touched, batch)
        # A row whose event the guard refuses has no after-image, so it must have no before-image.
        hit = newest.select(F.col(S.PK).alias(S.KEY), F.struct(S.MOST, S.LEAST).alias("_at"))
        before = old.join(hit, S.KEY)
        if guarded:
            before = before.where(F.col("_at") > F.struct(F.col("_most").alias(S.MOST), F.col("_least").alias(S.LEAST)))
        before = before.select(*store.schema.names)
        after = store.read(touched).where(F.col("_batch") == batch)
    except BaseException:
        newest.unpersist()
        raise
    entry = {
        "name": "QUALITY_INSPECTIONS", "action": "MERGE", "started_at": started, "rows_affected": rows,
        "rows_inserted": written - replaced, "rows_deleted": 0,
        "seconds": (utc_now() - started).total_seconds(),
    }
    return Merged(before, after, rows, entry, newest)


def _touched(store: PartedTable, newest: DataFrame) -> tuple[int, list[str]]:
    """Number of changed keys, and the parts of their old and new keys, since an update may move a row.

    One row per part comes back: at most as many as the table has parts.
    """
    keys = F.posexplode(F.array_distinct(F.array(F.col(S.PK), F.coalesce(S.payload(S.KEY), S.PK))))
    per_part = (
        newest.select(keys.alias("_place", S.KEY)).groupBy(store.part().alias("part"))
        .agg(F.count_if(F.col("_place") == 0).alias("keys")).collect())
    return sum(r["keys"] for r in per_part), [r["part"] for r in per_part]


def merge_stream(
    journal: DataFrame, store: PartedTable, checkpoint: str, log: RunLog | None = None, trigger: dict = DRAIN
) -> StreamingQuery:
    """Merge what arrived since the last gate; an empty gate is skipped and leaves no log row."""
    numbers = Numbers(store.spark, f"{store.path}/numbers")

    def apply(events: DataFrame, batch_id: int) -> None:
        number = numbers.of(events, batch_id)
        merged = None if number is None else merge_batch(store, events, number)
        if merged:
            merged.release()
            if log:
                log.write(number, [merged.entry])

    return (journal.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .queryName("merge").trigger(**trigger).start())

"""Folding a change feed into current state with soft deletes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineside import schemas as S
from lineside.functions.times import Stamp, stamp
from lineside.session import local_rows


def encode(
    rows: DataFrame,
    op: str,
    most: str,
    least: str,
    seen_at: Stamp,
    key: str = S.KEY,
    old_key: str | None = None,
    columns: Sequence[str] = S.SOURCE_COLUMNS,
) -> DataFrame:
    """Rows with an event type and a log position, as flat wire events.

    The primary key is the old key; a delete carries no payload.
    """
    return rows.withColumn("SEEN_AT", stamp(seen_at)).selectExpr(
        f"{old_key or key} AS PRIMARY_KEY__{key}",
        *[f"CASE WHEN {op} <> '{S.DELETE}' THEN {c} END AS {S.payload(c)}" for c in columns],
        f"CAST({least} AS BIGINT) AS {S.LEAST}",
        f"CAST({most} AS BIGINT) AS {S.MOST}",
        f"{op} AS EVENT_TYPE",
        "SEEN_AT",
        f"to_json(named_struct('offset_token', CAST({least} AS STRING))) AS METADATA",
    )


def data_events(events: DataFrame, types: Sequence[str] = S.DATA_EVENTS) -> DataFrame:
    """Drop markers that carry no row change."""
    return events.where(F.col("EVENT_TYPE").isin(*types))


def latest_per_key(
    events: DataFrame,
    key: str = S.PK,
    order: Sequence[str] = S.POSITION,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest data event of each key by log position.

    A ``max`` over a struct is a partial aggregate: each task hands on one row per key, so a key that
    holds a large share of the feed never gathers in one task. It serves batch and stream alike.
    ``columns`` narrows what is carried (and read).
    """
    names = list(columns or [c for c in events.columns if c not in (key, *order)])
    newest = F.max(F.struct(*order, *names)).alias("_newest")
    picked = data_events(events).groupBy(key).agg(newest).select(key, "_newest.*")
    return picked.select(key, *names, *order)


def empty_target(events: DataFrame, columns: Sequence[str] = S.SOURCE_COLUMNS) -> DataFrame:
    """A destination with no rows, for the first merge."""
    fields = [f for f in S.INSPECTIONS.fields if f.name in columns or f.name in S.BOOKKEEPING]
    return local_rows(events.sparkSession, [], T.StructType(fields))


def newest_rows(
    events: DataFrame, key: str = S.KEY, columns: Sequence[str] = S.SOURCE_COLUMNS
) -> DataFrame:
    """The newest event per key with the payload of ``columns`` only."""
    carried = [*[S.payload(c) for c in columns], "EVENT_TYPE"]
    return latest_per_key(events, f"PRIMARY_KEY__{key}", columns=carried)


def _inserted(source: DataFrame, as_of: Column, key: str, columns: Sequence[str]) -> DataFrame:
    """Source rows that met no target row: all become rows, a delete one that has only its key."""
    gone, pk = f"EVENT_TYPE = '{S.DELETE}'", f"PRIMARY_KEY__{key}"
    own_key = f"CASE WHEN {gone} THEN {pk} ELSE {S.payload(key)} END"
    return source.withColumn("_now", as_of).selectExpr(
        *[f"{own_key if c == key else S.payload(c)} AS {c}" for c in columns],
        "_now AS _inserted_at",
        "_now AS _updated_at",
        f"{gone} AS _deleted",
    )


def settled(
    events: DataFrame,
    as_of: Stamp,
    key: str = S.KEY,
    columns: Sequence[str] = S.SOURCE_COLUMNS,
) -> DataFrame:
    """State after one merge of ``events`` into an empty destination, without the join."""
    return _inserted(newest_rows(events, key, columns), stamp(as_of), key, columns)


def apply_newest(
    target: DataFrame,
    newest: DataFrame,
    as_of: Stamp,
    key: str = S.KEY,
    columns: Sequence[str] = S.SOURCE_COLUMNS,
    guard: bool = False,
    batch: int | Column | None = None,
) -> DataFrame:
    """Apply one event per key to a destination.

    Matched insert or update overwrites every column (the key too) and clears the deleted flag; matched
    delete only sets it; an unmatched event becomes a row. With ``guard`` the target carries the position
    of its last change (``_most``, ``_least``) and an older event is ignored. With ``batch`` it carries
    the number of the batch that last changed the row (``_batch``).

    Both sides have at most one row per key, so the joins are safe under key skew. Held rows meet their event and
    the events that meet none are added; Spark chooses from the sides' sizes whether the target is shuffled.
    """
    stamps = {"_s": F.lit(True), "_now": stamp(as_of), **({} if batch is None else {"_no": F.lit(batch)})}
    source = newest.withColumns(stamps)
    held = target.withColumn("_t", F.lit(True))
    pk = f"PRIMARY_KEY__{key}"
    on = F.col(key) == F.col(pk)
    unmet = source.join(target.select(F.col(key).alias("_found")), F.col(pk) == F.col("_found"), "left_anti")
    nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in held.schema.fields]
    joined = held.join(source, on, "left").unionByName(unmet.selectExpr(*nulls, "*"))

    applies = "_s IS NOT NULL"
    if guard:
        applies += (f" AND (_t IS NULL OR named_struct('m', {S.MOST}, 'l', {S.LEAST})"
                    " > named_struct('m', _most, 'l', _least))")
    gone = f"EVENT_TYPE = '{S.DELETE}'"

    def column(c: str) -> str:
        fresh = f"CASE WHEN {gone} THEN {pk} ELSE {S.payload(c)} END" if c == key else S.payload(c)
        return f"CASE WHEN {applies} AND NOT (_t IS NOT NULL AND {gone}) THEN {fresh} ELSE {c} END AS {c}"

    def kept(value: str, name: str) -> str:
        return f"CASE WHEN {applies} THEN {value} ELSE {name} END AS {name}"

    return joined.selectExpr(
        *[column(c) for c in columns],
        "CASE WHEN _t IS NULL THEN _now ELSE _inserted_at END AS _inserted_at",
        kept("_now", "_updated_at"),
        kept(gone, "_deleted"),
        *([kept(S.MOST, "_most"), kept(S.LEAST, "_least")] if guard else []),
        *([kept("CAST(_no AS BIGINT)", "_batch")] if batch is not None else []),
    )


def merge(
    target: DataFrame,
    events: DataFrame,
    as_of: Stamp,
    key: str = S.KEY,
    columns: Sequence[str] = S.SOURCE_COLUMNS,
    guard: bool = False,
) -> DataFrame:
    """Fold one batch of change events to the newest per key and apply it to a destination."""
    return apply_newest(target, newest_rows(events, key, columns), as_of, key, columns, guard)


def merge_into_table(newest: DataFrame, table: str, as_of: Stamp, key: str = S.KEY,
                     columns: Sequence[str] = S.SOURCE_COLUMNS) -> None:
    """The same merge on a catalog table whose format changes rows in place; the format prunes and commits."""
    now, pk = stamp(as_of), F.col(f"s.PRIMARY_KEY__{key}")
    gone = F.col("s.EVENT_TYPE") == S.DELETE
    fresh = {c: F.col(f"s.{S.payload(c)}") for c in columns}
    (
        newest.alias("s").mergeInto(table, F.col(f"{table}.{key}") == pk)
        .whenMatched(~gone).update({**fresh, "_deleted": F.lit(False), "_updated_at": now})
        .whenMatched(gone).update({"_deleted": F.lit(True), "_updated_at": now})
        .whenNotMatched().insert({
            **fresh, key: F.when(gone, pk).otherwise(fresh[key]),
            "_inserted_at": now, "_updated_at": now, "_deleted": gone})
        .merge()
    )


def merge_batches(
    target: DataFrame, batches: Sequence[tuple[DataFrame, Stamp]], **options
) -> DataFrame:
    """Merge a few (events, as_of) batches one after the other; each sees what the one before left."""
    return reduce(lambda held, batch: merge(held, *batch, **options), batches, target)


def split_key_changes(events: DataFrame, key: str = S.KEY) -> DataFrame:
    """Turn an update that changes its key into a delete of the old key and an insert of the new one."""
    old, new = F.col(f"PRIMARY_KEY__{key}"), F.col(S.payload(key))
    moved = (F.col("EVENT_TYPE") == S.UPDATE) & (old != new)
    whole = F.struct(*events.columns)
    emptied = F.struct(*[
        (F.lit(None).cast(events.schema[c].dataType) if c.startswith("PAYLOAD__")
         else F.lit(S.DELETE) if c == "EVENT_TYPE" else F.col(c)).alias(c)
        for c in events.columns
    ])
    rekeyed = F.struct(*[
        (new if c == f"PRIMARY_KEY__{key}" else F.lit(S.INSERT) if c == "EVENT_TYPE" else F.col(c)).alias(c)
        for c in events.columns
    ])
    return events.select(
        F.explode(F.when(moved, F.array(emptied, rekeyed)).otherwise(F.array(whole))).alias("_e")
    ).select("_e.*")


def settle(rows: DataFrame, op: str, order: Sequence[str], width: int | None = None) -> DataFrame:
    """What a tick of source rows leaves per key: its last insert, a void after that, and the newest update in between.

    One shuffle by key: running maxima over a key's rows tell which insert and which void came last before an update. A void
    after the last insert is one that is newer than it, and an update counts if no void stands between its insert and itself.

    With ``width`` the tick is cut into stretches of so many positions of ``order[0]``. What a stretch leaves is one row per key, and
    stretches combine associatively in their order, so a key that holds much of a long tick is spread over tasks.
    """
    at, kind = F.struct(*order), F.col(op)
    base = F.struct(*[c for c in S.SOURCE_COLUMNS if c != S.KEY])
    patch = F.struct("STATUS", "DEFECT_CODE", "UPDATED_TS")
    keys = [S.KEY] if width is None else [S.KEY, "_stretch"]
    tick = rows.where(kind.isin(*S.DATA_EVENTS))
    if width is not None:
        tick = tick.withColumn("_stretch", F.floor(F.col(order[0]) / width))
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since, voided = (F.max(F.when(kind == k, at)).over(so_far) for k in (S.INSERT, S.DELETE))
    seen = tick.withColumns({"_since": since, "_voided": voided})
    live = F.col("_voided").isNull() | (F.col("_voided") < F.col("_since"))
    parts = seen.groupBy(*keys).agg(
        F.max(F.when(kind == S.INSERT, F.struct(at.alias("at"), base.alias("row")))).alias("_ins"),
        F.max(F.when(kind == S.DELETE, at)).alias("_void"),
        F.max(F.when((kind == S.UPDATE) & live, F.struct("_since", at.alias("at"), patch.alias("row")))).alias("_upd"),
    ).select(
        *keys, "_ins",
        F.when(F.col("_ins").isNull() | (F.col("_void") > F.col("_ins.at")), F.col("_void")).alias("_void"),
        F.when(F.col("_upd").isNotNull() & F.col("_upd._since").eqNullSafe(F.col("_ins.at")),
               F.struct("_upd.at", "_upd.row")).alias("_upd"))
    return parts if width is None else _joined_stretches(parts)


def _joined_stretches(parts: DataFrame) -> DataFrame:
    """Stretches of each key, one after the other: a later insert starts anew, a void closes what comes after it."""
    names = ["_ins", "_void", "_upd"]
    kinds = {n: parts.schema[n].dataType for n in names}
    nothing = F.struct(*[F.lit(None).cast(kinds[n]).alias(n) for n in names])

    def follow(held: Column, part: Column) -> Column:
        update = F.when(held["_void"].isNotNull(), held["_upd"]).otherwise(F.coalesce(part["_upd"], held["_upd"]))
        going_on = F.struct(
            held["_ins"].alias("_ins"), F.coalesce(held["_void"], part["_void"]).alias("_void"), update.alias("_upd"))
        return F.when(part["_ins"].isNotNull(), F.struct(*[part[n].alias(n) for n in names])).otherwise(going_on)

    stretches = F.array_sort(F.collect_list(F.struct("_stretch", *names)))
    return parts.groupBy(S.KEY).agg(F.aggregate(stretches, nothing, follow).alias("_left")).select(S.KEY, "_left.*")


def direct_apply(target: DataFrame, rows: DataFrame, op: str, order: Sequence[str], as_of: Stamp,
                 width: int | None = None) -> DataFrame:
    """Write source rows (event type in ``op``) to the destination without a journal.

    An insert writes the whole row. An update changes status, defect code and source time, of live rows
    only. A void flags the row. Updates and voids of absent keys do nothing.
    """
    now = stamp(as_of)
    tick = settle(rows, op, order, width).withColumnRenamed(S.KEY, "_key")
    joined = target.withColumn("_t", F.lit(True)).join(tick, F.col(S.KEY) == F.col("_key"), "full_outer")
    written, voided = F.col("_ins").isNotNull(), F.col("_void").isNotNull()
    joined = joined.where(F.col("_t").isNotNull() | written)
    patched = F.col("_upd").isNotNull() & (written | (F.col("_t").isNotNull() & ~F.col("_deleted")))
    touched = written | patched | (F.col("_t").isNotNull() & voided)

    def column(c: str) -> Column:
        if c == S.KEY:
            return F.coalesce(S.KEY, "_key").alias(c)
        value = F.when(written, F.col(f"_ins.row.{c}")).otherwise(F.col(c))
        if c in ("STATUS", "DEFECT_CODE", "UPDATED_TS"):
            value = F.when(patched, F.col(f"_upd.row.{c}")).otherwise(value)
        return value.alias(c)

    return joined.select(
        *[column(c) for c in S.SOURCE_COLUMNS],
        F.coalesce(F.col("_inserted_at"), now).alias("_inserted_at"),
        F.when(touched, now).otherwise(F.col("_updated_at")).alias("_updated_at"),
        F.when(written, voided).otherwise(F.col("_deleted") | voided).alias("_deleted"),
    )

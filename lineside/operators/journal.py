"""Looking into the journal, its merges and the destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside import schemas as S


def journal_tail(journal: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` change events by log position."""
    return journal.orderBy(F.desc(S.MOST), F.desc(S.LEAST)).limit(n).select(
        "EVENT_TYPE", S.PK, "PAYLOAD__STATUS", "PAYLOAD__DEFECT_CODE",
        F.col(S.MOST).alias("txn_lsn"), F.col(S.LEAST).alias("msg_lsn"), "SEEN_AT",
    )


def journal_metadata(journal: DataFrame) -> DataFrame:
    """What the metadata column holds and the field inside it.

    It is a JSON text kept as one string value: a path on the string as it stands finds nothing, on the
    parsed text it finds the token.
    """
    held = F.col("METADATA").cast("variant")
    parsed = F.try_parse_json(held.cast("string"))
    return journal.select(
        S.MOST, S.LEAST,
        F.col("METADATA").alias("raw_variant"),
        F.schema_of_variant(held).alias("what_it_really_is"),
        F.try_variant_get(held, "$.offset_token", "string").alias("unparsed_token"),
        F.try_variant_get(parsed, "$.offset_token", "string").alias("offset_token"),
    )


def event_mix(journal: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    return journal.groupBy("EVENT_TYPE").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "EVENT_TYPE")


def merge_backlog(journal: DataFrame, destination: DataFrame, merged_position: Column | tuple[int, int]) -> DataFrame:
    """Journal inserts against destination rows, and whether events past the last merge are waiting.

    ``merged_position`` is the (most, least) significant pair of the last merged event: events are ordered by both.
    """
    counts = journal.agg(
        F.count_if(F.col("EVENT_TYPE") == S.INSERT).alias("n"),
        F.max(F.struct(*S.POSITION)).alias("newest"),
    )
    if isinstance(merged_position, tuple):
        merged_position = F.struct(*[F.lit(p).cast("bigint").alias(n) for p, n in zip(merged_position, S.POSITION)])
    rows = destination.agg(F.count("*").alias("n"))
    return journal.sparkSession.range(1).select(
        counts.select("n").scalar().alias("journal_inserts"),
        rows.scalar().alias("destination_rows"),
        counts.select("newest").scalar().alias("_newest"),
        merged_position.alias("_merged"),
    ).select(
        "journal_inserts",
        "destination_rows",
        (F.col("journal_inserts") - F.col("destination_rows")).alias("awaiting_merge"),
        F.coalesce(F.col("_merged").isNull() & F.col("_newest").isNotNull() | (F.col("_newest") > F.col("_merged")), F.lit(False))
        .alias("stream_has_pending"),
    )


def deleted_rows(destination: DataFrame) -> DataFrame:
    """Rows that are voided but still in the table."""
    return destination.where("_deleted").select(
        S.KEY, "LINE", "STATUS", "DEFECT_CODE", "_deleted", "_inserted_at", "_updated_at")


def rewritten_rows(destination: DataFrame) -> DataFrame:
    """Live rows that were changed after they first landed."""
    return destination.where("_updated_at > _inserted_at AND NOT _deleted").select(
        S.KEY, "LINE", "STATUS", "DEFECT_CODE", "_inserted_at", "_updated_at")


def merge_audit(history: DataFrame, tag: str, n: int = 10) -> DataFrame:
    """The newest ``n`` statements whose tag contains ``tag``, with the fields the tag carries."""
    return (
        history.where(F.col("query_tag").contains(tag))
        .orderBy(F.desc("start_time"), F.desc("rows_produced"))
        .limit(n)
        .select(
            F.date_format("start_time", "HH:mm:ss").alias("fired_at"),
            "query_type",
            F.col("rows_produced").alias("rows_affected"),
            F.round(F.col("elapsed_ms").cast("decimal(18,0)") / 1000, 1).cast("decimal(18,1)").alias("merge_seconds"),
            "warehouse_name",
            F.get_json_object("query_tag", "$.operation").alias("connector_operation"),
            F.get_json_object("query_tag", "$.strategy").alias("merge_strategy"),
        )
    )

"""Typed sources and sinks over columnar files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineside import schemas as S


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The same files as an unbounded table; files are taken in order of arrival."""
    return spark.readStream.options(**options).schema(schema).parquet(path)


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.JOURNAL)


def stream_journal(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream_table(spark, path, S.JOURNAL, **options)


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.TELEMETRY)


def stream_telemetry(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream_table(spark, path, S.TELEMETRY, **options)


def open_table(spark: SparkSession, path: str, columns: Sequence[str], where: Column | str) -> DataFrame:
    """Read chosen columns and rows of a published table; both reach the file scan."""
    return spark.read.parquet(path).where(where).select(*columns)


def footers(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts over whole Parquet tables come from the files' footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(name, spark.conf.get(name))
    return session


def open_table_counts(spark: SparkSession, path: str, where: Column | str) -> DataFrame:
    """Rows in the table and rows that pass the filter.

    Two aggregates rather than one: the total is pushed down to the footers of the files, of which no row is read, and the other
    one prunes by the filter.
    """
    table = footers(spark).read.parquet(path)
    total = table.agg(F.count("*")).scalar()
    return table.where(where).agg(F.count("*").alias("filtered_rows")).select(
        total.alias("total_rows"), "filtered_rows")


def prune_journal(journal: DataFrame, merged_position: int | Column) -> DataFrame:
    """Journal rows that a merge has not applied yet; the rest may be dropped."""
    return journal.where(F.col(S.LEAST) > merged_position)


def export_json_lines(events: DataFrame, path: str) -> None:
    """One JSON object per line, NULL fields kept, times in milliseconds."""
    (events.write.mode("overwrite")
     .option("ignoreNullFields", "false")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS")
     .json(path))


def as_operations(rows: DataFrame, op: str, key: str = S.KEY) -> DataFrame:
    """Source rows in the ``op`` plus row shape; a delete carries its key only."""
    kind = (
        F.when(F.col(op) == S.INSERT, "INSERT").when(F.col(op) == S.UPDATE, "UPDATE").otherwise("DELETE(soft)")
    )
    return rows.select(
        kind.alias("op"),
        *[(F.col(c) if c == key else F.when(F.col(op) != S.DELETE, F.col(c))).alias(c) for c in S.SOURCE_COLUMNS],
    )

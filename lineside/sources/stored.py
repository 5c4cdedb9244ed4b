"""Tables of the session catalog: databases in a given folder, tables stored by day, what exists and how many rows it has.

A database has a location, so its tables lie where all executors reach them, and dropping a partition frees its files. Tables
stored by day are partitioned by ``DAY``, the day of a time column; rows without a time lie under ``NO_DAY``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.functions.times import Stamp, stamp
from lineside.session import local_rows

DAY = "DAY"
NO_DAY = "none"


def day_of(at: Stamp) -> Column:
    return F.coalesce(F.date_format(stamp(at), "yyyy-MM-dd"), F.lit(NO_DAY))


def open_database(spark: SparkSession, name: str, folder: str) -> None:
    """A database whose tables lie in ``folder``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder}'")


def publish(frame: DataFrame, table: str, what_it_is: str = "", at: Stamp | None = None) -> None:
    """Store ``frame`` as a catalog table, by day if ``at`` names its time.

    A large day is written by several tasks, small ones share a task: Spark rebalances by measured size.
    """
    rows = frame if at is None else frame.withColumn(DAY, day_of(at)).hint("rebalance", DAY)
    writer = rows.write.format("parquet").option("partitionOverwriteMode", "dynamic")
    (writer if at is None else writer.partitionBy(DAY)).saveAsTable(table)
    if what_it_is:
        note = what_it_is.replace("'", "''")
        frame.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{note}'")


def days_touched(*frames: DataFrame) -> list[str]:
    """The days of ``frames``: names of partitions, of which a table has one for each day of its history."""
    rows = reduce(DataFrame.unionByName, [f.select(DAY) for f in frames])
    return sorted(r[DAY] for r in rows.distinct().collect())


def read_days(spark: SparkSession, table: str, days: Sequence[str]) -> DataFrame:
    """Rows of the given days; no other partition is listed or read."""
    return spark.table(table).where(F.col(DAY).isin(list(days)))


def replace_days(rows: DataFrame, table: str, touched: Sequence[str] = ()) -> None:
    """Write the days of ``rows`` anew; those ``touched`` days that have no row any more are dropped.

    No other partition is read or written. ``rows`` may read the table: new files are put in place once all are written. Which of
    the touched days got a row is told by the write itself.
    """
    spark = rows.sparkSession
    fresh = rows.select(*spark.table(table).columns).hint("rebalance", DAY)
    written = Observation()
    numbers = {day: i for i, day in enumerate(touched)}
    if touched:
        number = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col(DAY)]
        fresh = fresh.observe(written, F.bitmap_construct_agg(F.bitmap_bit_position(number + 1)).alias("days"))
    fresh.write.mode("overwrite").insertInto(table)
    if touched:
        bits = written.get["days"] or b""
        gone = [day for day, i in numbers.items() if not (bits and bits[i // 8] >> i % 8 & 1)]
        if gone:
            parts = ", ".join(f"PARTITION ({DAY} = '{day}')" for day in gone)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def merge_days(table: str, key: str, before: DataFrame, after: DataFrame) -> None:
    """Replace rows of a table stored by day: ``before`` are the held rows that go, ``after`` what comes in their stead.

    Both carry ``DAY``.
    """
    days = days_touched(before, after)
    kept = read_days(after.sparkSession, table, days).join(before.select(key), key, "left_anti")
    replace_days(kept.unionByName(after), table, days)


# ---- what exists ----

INVENTORY = S.fields(schema_name=S.STRING, object_name=S.STRING, object_type=S.STRING, what_it_is=S.STRING, row_count=S.LONG)


def count_rows(spark: SparkSession, table: str) -> None:
    """Put the row count of a table into the catalog's statistics; files of a columnar table are counted by their footers."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def _counted(spark: SparkSession, table: str) -> int | None:
    """The row count in a table's statistics."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").select(
        F.regexp_extract("data_type", "([0-9]+) rows", 1).cast("string").alias("n")).first()
    return int(told["n"]) if told and told["n"] else None


def catalog_objects(spark: SparkSession, databases: dict[str, str]) -> DataFrame:
    """What the catalog lists in ``databases`` (names in the catalog by the names to show), with comments and counted rows.

    Counts come from statistics: no table is read. Views and tables without statistics have none.
    """
    rows = []
    for shown, database in databases.items():
        for t in spark.catalog.listTables(database):
            view = t.tableType in ("VIEW", "TEMPORARY")
            if not t.isTemporary:
                rows.append((shown, t.name.upper(), "view" if view else "table", t.description,
                             None if view else _counted(spark, f"`{database}`.`{t.name}`")))
    return local_rows(spark, rows, INVENTORY)

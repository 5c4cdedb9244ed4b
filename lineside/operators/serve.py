"""Queries that read the derived tables for a dashboard, and small control-table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.session import local_rows
from lineside.functions.times import Stamp, minutes, seconds_between, stamp


def lower_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[c.lower() for c in frame.columns])


def recent_yield(gold: DataFrame, n: int = 12) -> DataFrame:
    """The newest ``n`` line-buckets, humidity to one decimal."""
    return gold.orderBy(F.desc("BUCKET"), "LINE").limit(n).select(
        "LINE", "BUCKET", "UNITS", "SCRAP_UNITS", "FIRST_PASS_YIELD_PCT",
        F.round("AVG_BOOTH_HUMIDITY", 1).alias("HUMIDITY"),
    )


def top_defects(counts: DataFrame, as_of: Stamp, look_back: int = 15, n: int | None = 5) -> DataFrame:
    """Defect codes of the last ``look_back`` minutes by count; ``n=None`` keeps them all."""
    ranked = (
        counts.where((F.col("DEFECT_CODE") != S.NO_DEFECT) & (F.col("BUCKET") >= stamp(as_of) - minutes(look_back)))
        .groupBy("LINE", "DEFECT_CODE").agg(F.sum("N").alias("N"))
        .orderBy(F.desc("N"), "LINE", "DEFECT_CODE")
    )
    return ranked if n is None else ranked.limit(n)


def yield_series(gold: DataFrame, as_of: Stamp, look_back: int = 60) -> DataFrame:
    """Yield rows of the last ``look_back`` minutes in time order, percentage as a double."""
    rows = gold.where(F.col("BUCKET") >= stamp(as_of) - minutes(look_back)).select(
        "LINE", "BUCKET", "UNITS", "SCRAP_UNITS",
        F.col("FIRST_PASS_YIELD_PCT").cast("double").alias("FIRST_PASS_YIELD_PCT"),
        "AVG_BOOTH_HUMIDITY",
    )
    return lower_names(rows.orderBy("BUCKET", "LINE"))


def kpi_latest(series: DataFrame, lines: Sequence[str] = S.LINES, low: float = 85.0) -> DataFrame:
    """One row per line for the newest bucket of the series; a line without data still shows."""
    newest = series.agg(F.max("bucket")).scalar()
    latest = series.where(F.col("bucket") == newest).select("line", "first_pass_yield_pct", "units", "scrap_units")
    wanted = local_rows(series.sparkSession, [(line,) for line in lines], S.fields(line=S.STRING))
    return wanted.join(latest, "line", "left").select(
        "line",
        newest.alias("bucket"),
        F.round("first_pass_yield_pct", 1).alias("yield_pct"),
        "units", "scrap_units",
        (F.col("first_pass_yield_pct") < low).alias("is_low"),
    )


def series_long(series: DataFrame) -> DataFrame:
    """Yield per line and non-null humidity stacked on one time axis."""
    humidity = F.when(F.col("avg_booth_humidity").isNotNull(), F.struct(
        F.lit("booth_humidity").alias("series"), F.col("avg_booth_humidity").alias("value")))
    pair = F.array(
        F.struct(F.col("line").alias("series"), F.col("first_pass_yield_pct").alias("value")), humidity)
    return (series.select("bucket", F.explode(F.array_compact(pair)).alias("_p"))
            .select("bucket", "_p.series", "_p.value"))


def gold_lag(refreshes: DataFrame, as_of: Stamp, names: Sequence[str]) -> DataFrame:
    """Worst lag in seconds over the tables' newest successful refreshes; NULL if there is none."""
    latest = (
        refreshes.where((F.col("state") == "SUCCEEDED") & F.col("name").isin(*names))
        .groupBy("name").agg(F.max("data_timestamp").alias("data_ts"))
    )
    return latest.agg(F.max(seconds_between("data_ts", as_of)).alias("lag_secs"))


def latest_row_wins(table: DataFrame, keys: Sequence[str] = (), value: str = "MODE", at: str = "UPDATED_AT",
                    default: str = "STEADY") -> DataFrame:
    """The newest value per key (or of the whole table), trimmed and upper-cased; empty means the default."""
    newest = table.groupBy(*keys).agg(F.max_by(value, F.struct(at, value)).alias(value))
    text = F.coalesce(F.nullif(F.col(value), F.lit("")), F.lit(default))
    return newest.select(*keys, F.upper(F.trim(text)).alias(value))


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``existing`` plus the new rows whose key it lacks; without keys, only if it is empty.

    The keys of ``existing`` are cut down to those of ``new`` first: if ``new`` is small, that join
    broadcasts it, and the large table is neither shuffled nor sent around.
    """
    if keys:
        found = existing.select(*keys).join(new.select(*keys), list(keys), "left_semi").distinct()
        return existing.unionByName(new.join(found, list(keys), "left_anti").select(*new.columns))
    found = existing.limit(1).agg(F.count("*")).scalar()
    return existing.unionByName(new.where(found == 0))


def committed_offset(landed: DataFrame, channel: str, position: str) -> DataFrame:
    """Newest landed position and row count per channel."""
    return landed.groupBy(channel).agg(
        F.max(position).alias("offset_token"), F.count("*").alias("rows_landed"))

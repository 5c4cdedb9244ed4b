"""The derived tables: live inspections, station health, yield and defect counts.

Each aggregate is built from additive parts (counts, whole-number sums, maxima), so that the batch form,
the streaming form and the changed-group refresh add up to the same figures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.functions import bucket, percent

HEALTH_KEYS = S.GRAINS["STATION_HEALTH"]
YIELD_KEYS = S.GRAINS["YIELD_BY_LINE_5MIN"]
DEFECT_KEYS = S.GRAINS["DEFECT_COUNTS_5MIN"]


def active(destination: DataFrame) -> DataFrame:
    """Live rows with their business columns and a 0/1 scrap flag; a NULL deleted flag drops the row."""
    kept = [c for c in S.SOURCE_COLUMNS if c in destination.columns]
    scrap = F.when(F.col("STATUS") == "FAIL", 1).otherwise(0)
    return destination.where(~F.col("_deleted")).select(*kept, scrap.alias("IS_SCRAP"))


# --- station health -------------------------------------------------------------------------------

def health_parts(telemetry: DataFrame, width: int = 5, slices: Column | None = None) -> DataFrame:
    """Additive parts of the telemetry rollup, by bucket or by given time slices."""
    value = F.col("VALUE")
    slices = bucket("EVENT_TS", width) if slices is None else slices
    return telemetry.groupBy("STATION_ID", "LINE", "METRIC", slices.alias("BUCKET")).agg(
        F.count("*").alias("READINGS"),
        F.count(value).alias("VALUES_N"),
        F.sum(value).alias("VALUE_SUM"),
        F.max(value).alias("MAX_VALUE"),
    )


def add_health(parts: DataFrame) -> DataFrame:
    """Add up parts of the same group."""
    return parts.groupBy(*HEALTH_KEYS).agg(
        F.sum("READINGS").alias("READINGS"),
        F.sum("VALUES_N").alias("VALUES_N"),
        F.sum("VALUE_SUM").alias("VALUE_SUM"),
        F.max("MAX_VALUE").alias("MAX_VALUE"),
    )


def health_table(parts: DataFrame) -> DataFrame:
    """Parts as the published table: readings, average, maximum."""
    average = F.col("VALUE_SUM") / F.nullif(F.col("VALUES_N").cast("double"), F.lit(0.0))
    return parts.select(
        *HEALTH_KEYS, F.col("READINGS").cast("int").alias("READINGS"), average.alias("AVG_VALUE"), "MAX_VALUE")


def station_health(telemetry: DataFrame, width: int = 5) -> DataFrame:
    """Count, average and maximum per station, line, metric and bucket."""
    return health_table(health_parts(telemetry, width))


# --- yield ----------------------------------------------------------------------------------------

def yield_parts(rows: DataFrame, width: int = 5) -> DataFrame:
    """Units and scrap per line and bucket; with a ``_sign`` column the rows count for or against."""
    sign = F.col("_sign") if "_sign" in rows.columns else F.lit(1)
    return rows.groupBy("LINE", bucket("EVENT_TS", width).alias("BUCKET")).agg(
        F.sum(sign).cast("bigint").alias("UNITS"),
        F.sum(sign * F.col("IS_SCRAP")).cast("bigint").alias("SCRAP_UNITS"),
    )


def booth_humidity(health: DataFrame) -> DataFrame:
    """Mean humidity over the stations of a line, per bucket."""
    return health.where(F.col("METRIC") == S.HUMIDITY).groupBy("LINE", "BUCKET").agg(
        F.avg("AVG_VALUE").alias("AVG_BOOTH_HUMIDITY"))


def yield_table(parts: DataFrame, health: DataFrame) -> DataFrame:
    """Yield parts with their percentage and the humidity of the same line and bucket.

    Both sides are at (line, bucket) before they meet, so several stations do not multiply the units and
    the join needs no shuffle beyond those of the two aggregates.
    """
    units, scrap = F.col("UNITS"), F.col("SCRAP_UNITS")
    return parts.join(booth_humidity(health), ["LINE", "BUCKET"], "left").select(
        "LINE", "BUCKET",
        units.cast("int").alias("UNITS"),
        scrap.cast("int").alias("SCRAP_UNITS"),
        percent(units, scrap).alias("FIRST_PASS_YIELD_PCT"),
        "AVG_BOOTH_HUMIDITY",
    )


def yield_by_line(live: DataFrame, health: DataFrame, width: int = 5) -> DataFrame:
    """First-pass yield per line and bucket next to the booth humidity."""
    return yield_table(yield_parts(live, width), health)


# --- defects --------------------------------------------------------------------------------------

def defect_parts(rows: DataFrame, width: int = 5) -> DataFrame:
    """Scans per line, bucket and defect code; ``_sign`` as in ``yield_parts``."""
    sign = F.col("_sign") if "_sign" in rows.columns else F.lit(1)
    code = F.coalesce("DEFECT_CODE", F.lit(S.NO_DEFECT))
    return rows.groupBy("LINE", bucket("EVENT_TS", width).alias("BUCKET"), code.alias("DEFECT_CODE")).agg(
        F.sum(sign).cast("bigint").alias("N"))


def defect_table(parts: DataFrame) -> DataFrame:
    return parts.select(*DEFECT_KEYS, F.col("N").cast("int").alias("N"))


def defect_counts(live: DataFrame, width: int = 5) -> DataFrame:
    """Scans per line, bucket and defect code, a scan without a code under ``NONE``."""
    return defect_table(defect_parts(live, width))


def top_value(
    counts: DataFrame,
    group: Sequence[str] = ("LINE", "BUCKET"),
    value: str = "DEFECT_CODE",
    n: str = "N",
    exclude: str | None = None,
) -> DataFrame:
    """The most frequent value of each group, read from counts; ties go to the smaller value.

    The counts refresh by changed group, which a ``mode`` over the rows would not. The smallest
    (minus count, value) is a partial aggregate, so no group is gathered to be ranked.
    """
    rows = counts if exclude is None else counts.where(F.col(value) != exclude)
    first = F.min(F.struct((-F.col(n)).alias("_n"), F.col(value).alias("_v"), F.col(n).alias(n))).alias("_first")
    return rows.groupBy(*group).agg(first).select(*group, F.col("_first._v").alias(f"TOP_{value}"), f"_first.{n}")

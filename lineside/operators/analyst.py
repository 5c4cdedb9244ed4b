"""Plant-floor questions as queries: what is wrong now, since when, and what came first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.functions import percent, seconds_between, share_of
from lineside.functions.times import Stamp, epoch_seconds, minutes, stamp


def latest_buckets(gold: DataFrame, as_of: Stamp, n: int = 3, width: int = 5) -> DataFrame:
    """Rows of the newest ``n`` complete buckets, the same ones for every line.

    A bucket is complete when it ends at or before ``as_of``. The ``n`` buckets are a top-k, so the side
    that is broadcast has ``n`` rows.
    """
    complete = gold.where(F.col("BUCKET") + minutes(width) <= stamp(as_of))
    newest = complete.select("BUCKET").distinct().orderBy(F.desc("BUCKET")).limit(n)
    return complete.join(F.broadcast(newest), "BUCKET", "left_semi").select(*gold.columns)


def line_health(recent: DataFrame, healthy: float = 93.0, problem: float = 90.0, tile: float = 85.0) -> DataFrame:
    """State of each line from its units over the given buckets."""
    pct = F.col("YIELD_PCT")
    return recent.groupBy("LINE").agg(
        F.min("BUCKET").alias("FROM_BUCKET"),
        F.max("BUCKET").alias("TO_BUCKET"),
        F.sum("UNITS").alias("UNITS"),
        percent(F.sum("UNITS"), F.sum("SCRAP_UNITS")).alias("YIELD_PCT"),
    ).select(
        "*",
        F.when(pct > healthy, "healthy").when(pct < problem, "problem").when(pct.isNotNull(), "watch").alias("STATE"),
        (pct < tile).alias("IS_LOW"),
    )


def humidity_alerts(gold: DataFrame, limit: float = 60.0) -> DataFrame:
    """Buckets with a humidity reading and whether it is abnormal."""
    return gold.where(F.col("AVG_BOOTH_HUMIDITY").isNotNull()).select(
        "LINE", "BUCKET", "AVG_BOOTH_HUMIDITY", "FIRST_PASS_YIELD_PCT",
        F.when(F.col("AVG_BOOTH_HUMIDITY") > limit, "abnormal").otherwise("normal").alias("HUMIDITY_STATE"),
    )


def defect_share(counts: DataFrame) -> DataFrame:
    """Codes of each line by rank, with their share of the line's scrap."""
    codes = counts.where(F.col("DEFECT_CODE") != S.NO_DEFECT).groupBy("LINE", "DEFECT_CODE").agg(
        F.sum("N").alias("N"))
    line = Window.partitionBy("LINE")
    return codes.select(
        "LINE", "DEFECT_CODE", "N",
        share_of(F.col("N"), F.sum("N").over(line)).alias("SHARE_PCT"),
        F.rank().over(line.orderBy(F.desc("N"))).alias("RANK"),
    )


def cause_order(
    gold: DataFrame,
    counts: DataFrame,
    humidity_limit: float = 60.0,
    defect_limit: int = 1,
    yield_limit: float = 90.0,
) -> DataFrame:
    """First bucket per line in which humidity, defects and yield cross their limits, and the delays.

    ``ORDER_HOLDS`` when all three crossed and none came before its cause; at bucket grain they may share
    a bucket.
    """
    defects = counts.where(F.col("DEFECT_CODE") != S.NO_DEFECT).groupBy("LINE", "BUCKET").agg(
        F.sum("N").alias("DEFECTS"))

    def first(test: Column) -> Column:
        return F.min(F.when(test, F.col("BUCKET")))

    from_gold = gold.groupBy("LINE").agg(
        first(F.col("AVG_BOOTH_HUMIDITY") > humidity_limit).alias("HUMIDITY_AT"),
        first(F.col("FIRST_PASS_YIELD_PCT") < yield_limit).alias("YIELD_AT"),
    )
    from_counts = defects.groupBy("LINE").agg(first(F.col("DEFECTS") >= defect_limit).alias("DEFECTS_AT"))
    h, d, y = (F.col(c) for c in ("HUMIDITY_AT", "DEFECTS_AT", "YIELD_AT"))
    return from_gold.join(from_counts, "LINE", "left").select(
        "LINE", "HUMIDITY_AT", "DEFECTS_AT", "YIELD_AT",
        seconds_between(h, d).alias("DEFECTS_AFTER_SECS"),
        seconds_between(h, y).alias("YIELD_AFTER_SECS"),
        F.coalesce((h <= d) & (d <= y), F.lit(False)).alias("ORDER_HOLDS"),
    )


def yield_compare(gold: DataFrame, back: int = 20, at: Stamp | None = None) -> DataFrame:
    """Yield of a bucket against the one ``back`` minutes earlier on the same line.

    The earlier row is found by shifting its bucket, so both sides meet on equal keys.
    """
    now = gold if at is None else gold.where(F.col("BUCKET") == stamp(at))
    then = gold.select(
        "LINE", (F.col("BUCKET") + minutes(back)).alias("BUCKET"),
        F.col("UNITS").alias("THEN_UNITS"), F.col("FIRST_PASS_YIELD_PCT").alias("THEN_PCT"))
    return now.join(then, ["LINE", "BUCKET"], "left").select(
        "LINE", "BUCKET",
        F.col("UNITS").alias("NOW_UNITS"), F.col("FIRST_PASS_YIELD_PCT").alias("NOW_PCT"),
        "THEN_UNITS", "THEN_PCT",
        (F.col("FIRST_PASS_YIELD_PCT") - F.col("THEN_PCT")).alias("CHANGE_PCT"),
    )


def incidents(
    gold: DataFrame,
    counts: DataFrame,
    width: int = 5,
    quiet: int = 1,
    humidity_limit: float = 60.0,
    defect_limit: int = 1,
    yield_limit: float = 90.0,
) -> DataFrame:
    """Every incident of each line: when it began and ended, what crossed its limit first, and the delays.

    An incident is a run of buckets in which humidity, defects or yield are beyond their limits; more than ``quiet`` buckets without
    any of them end it. Only such buckets reach the window, which has a line's buckets in order. ``ORDER_HOLDS``
    as in ``cause_order``, within the incident.
    """
    defects = counts.where(F.col("DEFECT_CODE") != S.NO_DEFECT).groupBy("LINE", "BUCKET").agg(F.sum("N").alias("DEFECTS"))
    both = gold.select("LINE", "BUCKET", "AVG_BOOTH_HUMIDITY", "FIRST_PASS_YIELD_PCT").join(defects, ["LINE", "BUCKET"], "full_outer")
    signals = both.select(
        "LINE", "BUCKET",
        F.coalesce(F.col("AVG_BOOTH_HUMIDITY") > humidity_limit, F.lit(False)).alias("_h"),
        F.coalesce(F.col("DEFECTS") >= defect_limit, F.lit(False)).alias("_d"),
        F.coalesce(F.col("FIRST_PASS_YIELD_PCT") < yield_limit, F.lit(False)).alias("_y"),
    ).where("BUCKET IS NOT NULL AND (_h OR _d OR _y)")
    line = Window.partitionBy("LINE").orderBy("BUCKET")
    last = F.lag("BUCKET").over(line)
    begins = (last.isNull() | (last + minutes(width * (quiet + 1)) < F.col("BUCKET"))).cast("int")
    numbered = signals.withColumn("_begins", begins).withColumn("INCIDENT", F.sum("_begins").over(line))

    def first(flag: str) -> Column:
        return F.min(F.when(F.col(flag), F.col("BUCKET")))

    h, d, y = (F.col(c) for c in ("HUMIDITY_AT", "DEFECTS_AT", "YIELD_AT"))
    return numbered.groupBy("LINE", "INCIDENT").agg(
        F.min("BUCKET").alias("STARTED_AT"), (F.max("BUCKET") + minutes(width)).alias("ENDED_AT"), F.count("*").alias("BUCKETS"),
        first("_h").alias("HUMIDITY_AT"), first("_d").alias("DEFECTS_AT"), first("_y").alias("YIELD_AT"),
    ).select(
        "*",
        seconds_between(h, d).alias("DEFECTS_AFTER_SECS"),
        seconds_between(h, y).alias("YIELD_AFTER_SECS"),
        F.coalesce((h <= d) & (d <= y), F.lit(False)).alias("ORDER_HOLDS"),
    )


def yield_compare_nearest(gold: DataFrame, back: int = 20, tolerance: int = 60) -> DataFrame:
    """Yield of each bucket against the nearest one at least ``back`` and at most ``back + tolerance`` minutes earlier on its line.

    Every bucket is asked for once, ``back`` minutes after it, and the newest one at or before that time answers. Times are cut into
    stretches as long as the tolerance; a bucket stands in its own and the next, which covers all it may answer, so
    no task needs more than two stretches of a line. Rows without a bucket are compared with nothing.
    """
    span = max(tolerance, 1) * 60
    asked_at = F.col("BUCKET") + minutes(back)
    row = F.struct("BUCKET", "UNITS", "FIRST_PASS_YIELD_PCT")
    questions = gold.select("LINE", F.col("BUCKET").alias("_at"), F.lit(1).alias("_asks"), row.alias("_row"))
    answers = gold.where("BUCKET IS NOT NULL").select("LINE", asked_at.alias("_at"), F.lit(0).alias("_asks"), row.alias("_row"))
    stretch = F.floor(epoch_seconds(F.col("_at")) / span)
    placed = questions.withColumn("_stretch", stretch).unionByName(
        answers.withColumn("_stretch", F.explode(F.array(stretch, stretch + 1))))
    order = Window.partitionBy("LINE", "_stretch").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    then = F.last(F.when(F.col("_asks") == 0, F.col("_row")), ignorenulls=True).over(order)
    known = placed.withColumn("_then", then).where("_asks = 1")
    near = F.col("_then.BUCKET") + minutes(back + tolerance) >= F.col("_at")
    then = F.when(near, F.col("_then"))
    return known.withColumn("_then", then).select(
        "LINE", F.col("_row.BUCKET").alias("BUCKET"),
        F.col("_row.UNITS").alias("NOW_UNITS"), F.col("_row.FIRST_PASS_YIELD_PCT").alias("NOW_PCT"),
        F.col("_then.BUCKET").alias("THEN_BUCKET"), F.col("_then.UNITS").alias("THEN_UNITS"),
        F.col("_then.FIRST_PASS_YIELD_PCT").alias("THEN_PCT"),
        (F.col("_row.FIRST_PASS_YIELD_PCT") - F.col("_then.FIRST_PASS_YIELD_PCT")).alias("CHANGE_PCT"),
    )


def control_compare(gold: DataFrame, since: Stamp) -> DataFrame:
    """Drop in each line's yield from before to after ``since``, against the mean drop of the others.

    Weighted by units on both sides of the split.
    """
    before = F.col("BUCKET") < stamp(since)
    after = F.col("BUCKET") >= stamp(since)

    def side(test: Column) -> Column:
        return percent(F.sum(F.when(test, F.col("UNITS"))), F.sum(F.when(test, F.col("SCRAP_UNITS"))))

    drops = gold.groupBy("LINE").agg(side(before).alias("BEFORE_PCT"), side(after).alias("AFTER_PCT")).withColumn(
        "DROP_PCT", F.col("BEFORE_PCT") - F.col("AFTER_PCT"))
    # The totals are two numbers; each line then takes itself out of them.
    total = drops.agg(F.sum("DROP_PCT")).scalar()
    lines = drops.agg(F.count("DROP_PCT")).scalar()
    others = (total - F.col("DROP_PCT")).cast("double") / F.nullif((lines - 1).cast("double"), F.lit(0.0))
    return drops.select(
        "LINE", "BEFORE_PCT", "AFTER_PCT", "DROP_PCT",
        F.round(others, 4).alias("OTHERS_DROP_PCT"),
        F.round(F.col("DROP_PCT").cast("double") - others, 4).alias("EXCESS_DROP_PCT"),
    )

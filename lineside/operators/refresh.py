"""Keeping aggregates over a mutating table current by changed group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.functions import bucket
from lineside.operators.cdc import data_events


def same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of two aliases on ``keys``."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before-images counted against (``_sign`` -1), after-images counted for (1)."""
    return before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))


def changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Signed before- and after-images of the rows that differ between two versions of a table.

    The versions meet once and both images come out of the same pass.
    """
    def side(frame: DataFrame, sign: int, name: str) -> DataFrame:
        return frame.select(key, F.struct(*old.columns, F.lit(sign).alias("_sign")).alias(name))

    both = side(old, -1, "_old").join(side(new, 1, "_new"), key, "full_outer")
    same_row = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in old.columns if c != key]
    unchanged = reduce(lambda a, b: a & b, same_row, F.col("_old").isNotNull() & F.col("_new").isNotNull())
    images = F.explode(F.array_compact(F.array("_old", "_new"))).alias("_image")
    return both.where(~unchanged).select(images).select("_image.*")


def changed_groups(changed: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """Groups that changed rows left or entered."""
    return changed.select(*[c.alias(name) for name, c in groups.items()]).distinct()


def refresh(
    gold: DataFrame,
    source: DataFrame,
    touched: DataFrame,
    groups: dict[str, Column],
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Replace the touched groups of ``gold`` by ``build`` over the source rows of those groups.

    Works for any aggregate. A group that has lost its last row disappears. Rows outside the touched
    groups are filtered before ``build`` sees them; a group with a large share of them is split by Spark's skew join.
    """
    keys = list(groups)
    names = [f"_g_{k}" for k in keys]
    marked = source.select("*", *[groups[k].alias(n) for k, n in zip(keys, names)])
    wanted = touched.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    rows = marked.alias("m").join(wanted.alias("w"), same("m", "w", names), "left_semi").select(*source.columns)
    kept = gold.alias("g").join(touched.alias("t"), same("g", "t", keys), "left_anti")
    return kept.unionByName(build(rows))


def add_parts(held: DataFrame, change: DataFrame, keys: Sequence[str], sums: Sequence[str], alive: str) -> DataFrame:
    """Add signed changes to held counts and drop the groups that reach zero in ``alive``.

    Work follows the held groups and the changed rows; the table the counts came from is not read.
    """
    columns = [*keys, *sums]
    added = held.select(*columns).unionByName(change.select(*columns)).groupBy(*keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in sums])
    return added.where(F.col(alive) != 0)


def restated(old: DataFrame, new: DataFrame, grain: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Groups whose values differ between two versions, with both and what happened."""
    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*grain, F.struct(*values).alias(name))

    o, n = side(old, "_old").alias("o"), side(new, "_new").alias("n")
    joined = o.join(n, same("o", "n", grain), "full_outer")
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("restated")
    return joined.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        *[F.when(F.col("_new").isNotNull(), F.col(f"n.{g}")).otherwise(F.col(f"o.{g}")).alias(g) for g in grain],
        *[c for v in values for c in (F.col(f"_old.{v}").alias(f"OLD_{v}"), F.col(f"_new.{v}").alias(f"NEW_{v}"))],
        *[(F.col(f"_new.{v}") - F.col(f"_old.{v}")).alias(f"CHANGE_{v}") for v in values],
        kind.alias("CHANGE"),
    )


def gate_values(journal: DataFrame, gate: Column, width: int = 5) -> DataFrame:
    """Units and scrap of each line and bucket after every gate that changed them, straight from the journal.

    A key's newest event in a gate holds until its next one, so each version is counted in at its gate and out at the gate of the
    one after it. The signed counts of a gate add up, and their running sums are what folding the journal up to that gate
    gives, for all gates in one pass. Keys that are rewritten go through ``cdc.split_key_changes`` first. A key has one row per gate
    however many events it has, and a bucket one per gate.
    """
    carried = [S.payload(c) for c in ("LINE", "STATUS", "EVENT_TS")]
    newest = F.max(F.struct(*S.POSITION, "EVENT_TYPE", *carried)).alias("_newest")
    versions = data_events(journal).groupBy(S.PK, gate.alias("GATE")).agg(newest).select(S.PK, "GATE", "_newest.*")
    placed = versions.withColumn("BUCKET", bucket(S.payload("EVENT_TS"), width)).withColumn("_now", F.when(
        F.col("EVENT_TYPE") != S.DELETE, F.struct(
            F.col(S.payload("LINE")).alias("LINE"), "BUCKET",
            F.when(F.col(S.payload("STATUS")) == "FAIL", 1).otherwise(0).alias("SCRAP"))))
    held = placed.withColumn("_before", F.lag("_now").over(Window.partitionBy(S.PK).orderBy("GATE")))
    images = F.array(
        F.when(F.col("_before").isNotNull(), F.struct(F.lit(-1).alias("_sign"), F.col("_before").alias("_row"))),
        F.when(F.col("_now").isNotNull(), F.struct(F.lit(1).alias("_sign"), F.col("_now").alias("_row"))))
    changed = held.select("GATE", F.explode(F.array_compact(images)).alias("_i")).groupBy("_i._row.LINE", "_i._row.BUCKET", "GATE").agg(
        F.sum("_i._sign").alias("UNITS"), F.sum(F.col("_i._sign") * F.col("_i._row.SCRAP")).alias("SCRAP_UNITS"))
    so_far = Window.partitionBy("LINE", "BUCKET").orderBy("GATE").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changed.where("UNITS <> 0 OR SCRAP_UNITS <> 0").select(
        "LINE", "BUCKET", "GATE", F.sum("UNITS").over(so_far).alias("UNITS"), F.sum("SCRAP_UNITS").over(so_far).alias("SCRAP_UNITS"))


def restatements(values: DataFrame) -> DataFrame:
    """How often and when each bucket was restated: ``values`` are those of ``gate_values``.

    The first gate reports a bucket; every later one that changed it restates it. A bucket that lost its last unit has been removed.
    """
    def end(pick, column: str) -> Column:
        return pick(column, "GATE")

    return values.groupBy("LINE", "BUCKET").agg(
        F.min("GATE").alias("FIRST_GATE"), F.max("GATE").alias("LAST_GATE"), (F.count("*") - 1).alias("RESTATED"),
        end(F.min_by, "UNITS").alias("FIRST_UNITS"), end(F.max_by, "UNITS").alias("LAST_UNITS"),
        end(F.min_by, "SCRAP_UNITS").alias("FIRST_SCRAP_UNITS"), end(F.max_by, "SCRAP_UNITS").alias("LAST_SCRAP_UNITS"),
    ).withColumn("REMOVED", F.col("LAST_UNITS") == 0)

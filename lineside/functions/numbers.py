"""Ratios of whole numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def share_of(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` for whole numbers, rounded half up to two decimals; NULL on an empty whole."""
    whole = F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(part.cast("decimal(18,0)") * 100 / whole, 2).cast("decimal(5,2)")


def percent(units: Column, scrap: Column) -> Column:
    """First-pass yield in percent."""
    return share_of(units - scrap, units)

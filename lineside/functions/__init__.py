"""Column functions: JVM-side expressions only."""

from lineside.functions.numbers import percent, share_of
from lineside.functions.times import bucket, epoch_seconds, iso_millis, minutes, seconds_between

__all__ = [
    "bucket", "epoch_seconds", "iso_millis", "minutes", "percent", "seconds_between", "share_of",
]

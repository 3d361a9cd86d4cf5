"""Joins of totals and windows. Every one has an equality on the key, and on the window grid where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_running(left: DataFrame, right: DataFrame, key: str, guard: tuple[str, str, int] | None = None) -> DataFrame:
    """Totals of two streams by key; `guard` names a time of either side and the seconds that they may differ."""
    both = left.join(right, key)
    return both.where(F.abs(F.unix_seconds(guard[0]) - F.unix_seconds(guard[1])) <= guard[2]) if guard else both


def join_hop(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Windows of two streams that end together: on the grid a tolerance under one slide is equality."""
    return left.join(right, [*keys, "w_end"])


def align_running(running: DataFrame, hop: DataFrame, key: str, slide: int, which: str = "next") -> DataFrame:
    """Rows with the window that closes next behind them, or the one that closed last."""
    at = F.floor(F.unix_seconds("et") / slide) * slide + (slide if which == "next" else 0)
    return running.withColumn("w_end", at.cast("long")).join(hop, [key, "w_end"])


def join_range(left: DataFrame, right: DataFrame, key: str, before: int, after: int) -> DataFrame:
    """Left rows whose `ts` (epoch seconds) lies within [w_end - before, w_end + after] of a right row."""
    return left.join(right, key).where((F.col("ts") >= F.col("w_end") - before) & (F.col("ts") <= F.col("w_end") + after))


def join_bucket(left: DataFrame, right: DataFrame, keys: list[str], seconds: int = 2) -> DataFrame:
    """Rows of one key and bucket label whose times `et` differ by no more than these seconds; `et` is the left one's."""
    both = left.join(right.withColumnRenamed("et", "__et"), [*keys, "time_str"])
    return both.where(F.abs(F.unix_seconds("et") - F.unix_seconds("__et")) <= seconds).drop("__et")


def join_band(left: DataFrame, right: DataFrame, keys: list[str], before: int, after: int, times: tuple[str, str] = ("et", "et")) -> DataFrame:
    """Pairs of rows of equal keys of which the right one's time lies within [left - before, left + after] seconds; the right one's other columns get the prefix r_.

    Time is cut in buckets as long as the band: a right row goes to its own, a left row to the two or three that its band touches, and they meet by
    an equality of keys and bucket, so a key with many rows is work for many tasks and no pair is compared in two of them. Rows with a null key or time
    meet nothing; rows that repeat meet each for itself.
    """
    width = max(before + after, 1)
    names = {c: f"r_{c}" for c in right.columns if c not in keys}
    at, other = F.unix_seconds(times[0]), F.unix_seconds(f"r_{times[1]}")
    lo, hi = F.floor((at - before) / width), F.floor((at + after) / width)
    own = left.withColumn("__bucket", F.explode(F.sequence(lo, hi)))
    held = right.withColumnsRenamed(names).withColumn("__bucket", F.floor(other / width))
    both = own.join(held, [*keys, "__bucket"])
    return both.where((other >= at - before) & (other <= at + after)).drop("__bucket")

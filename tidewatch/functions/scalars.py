"""Column helpers: guarded ratios, conditional aggregates, window labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, sentinel: float = -999.0, mode: str = "exact") -> Column:
    """num / den as double, or the sentinel where den is zero. `integer` divides whole numbers before the cast."""
    value = num.cast("double") / den if mode == "exact" else F.floor(num / den).cast("double")
    return F.when(den == 0, F.lit(sentinel)).otherwise(value)


def count_where(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def distinct_if(value: Column, cond: Column, approx: bool = False) -> Column:
    """Distinct values among the rows that pass; null is a value of its own."""
    own = F.when(cond, value)
    n = F.approx_count_distinct(own) if approx else F.count_distinct(own)
    return n + F.max(F.when(cond & value.isNull(), 1).otherwise(0))


def avg_if(value: Column, cond: Column) -> Column:
    """Mean of the rows that pass; NaN if none does."""
    return F.coalesce(F.avg(F.when(cond, value)), F.lit(float("nan")))


def approved(code: Column) -> Column:
    return F.coalesce(code.try_cast("int") == 0, F.lit(False))


def bucket_label(ts: Column) -> Column:
    """The ten-second bucket of a time, as text."""
    return F.concat(F.substring(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), 1, 18), F.lit("0"))


def row_time(end: Column) -> Column:
    """A window's last millisecond, from its end in epoch seconds."""
    return F.timestamp_millis(end.cast("long") * 1000 - 1)


def upper(text: Column) -> Column:
    return F.upper(text)


def to_time(text: Column) -> Column:
    """Text as a time, cut to milliseconds; null where it is none."""
    return F.date_trunc("millisecond", F.try_to_timestamp(text))

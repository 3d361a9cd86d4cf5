"""Running totals and sliding windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, keys: list[str], measures: dict[str, Column], emit: str = "latest", order: list[str] | None = None) -> DataFrame:
    """Totals over all rows of a key: the last value, or with `every` the value after each row (rows carry their columns).

    For sums after each row of few keys see `cumulative`, which also deals the rows of one key out.
    """
    if emit == "latest":
        return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    w = Window.partitionBy(*keys).orderBy(*(order or ["et", "seq"])).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[m.over(w).alias(n) for n, m in measures.items()])


def cumulative(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], maxes: dict[str, Column] | None = None, seconds: int = 3600) -> DataFrame:
    """Sums and maxima over all rows of a key up to and with each row, in order of `et` and then `order`; rows carry their columns.

    Rows are dealt out by key and hour, so one key's rows don't meet in one task: the hours before count with their totals. A sum that
    no row has contributed to yet is null. Null keys are a key; rows without a time come before all others of their key.
    """
    maxes = maxes or {}
    own = {f"__{n}": c for n, c in (sums | maxes).items()}
    # structs are never null, and equal where their fields are null alike
    hour = F.struct(F.struct(*keys).alias("key"), F.floor(F.unix_seconds("et") / seconds).alias("b"))
    rows = df.withColumns(own | {"__at": hour})
    total = rows.groupBy("__at").agg(*[F.sum(f"__{n}").alias(f"__t_{n}") for n in sums], *[F.max(f"__{n}").alias(f"__t_{n}") for n in maxes])
    before = Window.partitionBy("__at.key").orderBy(F.col("__at.b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("__at", *[(F.sum if n in sums else F.max)(f"__t_{n}").over(before).alias(f"__p_{n}") for n in (*sums, *maxes)])
    within = Window.partitionBy("__at").orderBy("et", *order).rowsBetween(Window.unboundedPreceding, 0)

    def out(n: str) -> Column:
        if n in maxes:
            return F.greatest(F.max(f"__{n}").over(within), F.col(f"__p_{n}"))
        now = F.sum(f"__{n}").over(within)
        return F.when(now.isNull(), F.col(f"__p_{n}")).otherwise(now + F.coalesce(F.col(f"__p_{n}"), F.lit(0)))

    return rows.join(total, "__at").select(*[c for c in df.columns if c not in own], *[out(n).alias(n) for n in (*sums, *maxes)])


def _dealt(df: DataFrame, keys: list[str], leave: dict[str, Column], slide: int, values: dict[str, Column], sizes: dict[str, int]) -> DataFrame:
    """What enters the windows behind a pane and what leaves each size: keys, at, and a column of each value for each size."""
    events = [F.struct((F.col("pane") + slide).alias("at"), F.lit("").alias("out"))] + [F.struct((leave[s] + slide).alias("at"), F.lit(s).alias("out")) for s in sizes]
    rows = df.withColumn("e", F.explode(F.array(*events)))
    cols = [F.when(F.col("e.out") == "", c).when(F.col("e.out") == s, -c).alias(f"{n}_{s}") for n, c in values.items() for s in sizes]
    return rows.select(*keys, F.col("e.at").alias("at"), *cols)


def exact(df: DataFrame, sums: dict[str, Column]) -> tuple[dict[str, Column], dict[str, str]]:
    """Addends that can be taken off again without a rest: fractions as decimals of 15 places. And the types that their sums are cast back to."""
    types = dict(df.select(*[c.alias(n) for n, c in sums.items()]).dtypes) if sums else {}
    kinds = {n: "double" if t in ("double", "float") else "long" for n, t in types.items()}
    return {n: c.cast("decimal(36,15)" if kinds[n] == "double" else "long") for n, c in sums.items()}, kinds


def levels(points: DataFrame, keys: list[str], names: list[str], seconds: int = 86_400, until: bool = False) -> DataFrame:
    """Running sums of `names` at every point of a key: keys, day, at (seconds), names. Null keys are a key; null addends add nothing.

    Points are dealt out by key and day (of so many seconds): one key's points don't meet in one task, and the days before count with their
    totals. Points that may be many in one second of a key should be added up before. With `until`, a column says where the next point of
    the day, or the day, is; it is worked out where the rows lie. The result stays dealt out by key and day.
    """
    key = F.struct(*keys).alias("__key")  # never null, and equal where its fields are null alike
    dealt = points.select(key, F.floor(F.col("at") / seconds).alias("day"), "at", *names).repartition("__key", "day")
    steps = dealt.groupBy("__key", "day", "at").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    total = steps.groupBy("__key", "day").agg(*[F.sum(n).alias(n) for n in names])
    before = Window.partitionBy("__key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("__key", "day", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__p_{n}") for n in names])
    in_order = Window.partitionBy("__key", "day").orderBy("at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.sum(n).over(so_far) + F.col(f"__p_{n}")).alias(n) for n in names]
    following = [F.coalesce(F.lead("at").over(in_order), (F.col("day") + 1) * seconds).alias("until")] if until else []
    return steps.join(total, ["__key", "day"]).select(*[F.col("__key")[k].alias(k) for k in keys], "day", "at", *sums, *following)


def extremes(panes: DataFrame, asked: DataFrame, keys: list[str], slide: int, sizes: dict[str, int], merges: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """What can be merged but not taken off again (maxima, sketches), in the window of each size that ends at each asked point: keys, at, <name>_<size>.

    Time is cut in blocks as long as the window, so a window is the end of one block and the start of the next. Running merges from both ends of
    a block give both parts; each pane is merged twice for each size, whatever the ratio of size and slide, and blocks of one key are dealt out. Every
    size must be a whole number of slides. `merges` are aggregates that also merge what they returned; null merges nothing.
    """
    values, key = list(merges), F.struct(*keys).alias("__key")
    parts = [F.struct(F.lit(s).alias("size"), F.lit(z).cast("long").alias("z"), F.lit(end).alias("end")) for s, z in sizes.items() for end in (True, False)]
    part = F.explode(F.array(*parts)).alias("p")
    held = panes.select(key, part, F.col("pane").alias("t"), F.lit(None).cast("long").alias("at"), *values)
    # of the start of a block the last pane behind the end counts, of the end of one the first pane of the window
    ask = asked.select(key, "at", part).select("__key", "p", F.when(F.col("p.end"), F.col("at") - F.col("p.z")).otherwise(F.col("at") - slide).alias("t"), "at", *[F.lit(None).cast(panes.schema[v].dataType).alias(v) for v in values])
    rows = held.unionByName(ask).select("*", F.floor(F.col("t") / F.col("p.z")).alias("block"))
    w = Window.partitionBy("__key", "p", "block").orderBy(F.when(F.col("p.end"), -F.col("t")).otherwise(F.col("t")), F.col("at").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("__key", "p", "at", *[merges[v](F.col(v)).over(w).alias(v) for v in values]).where("at is not null")
    out = rows.groupBy("__key", "at").agg(*[merges[v](F.when(F.col("p.size") == s, F.col(v))).alias(f"{v}_{s}") for v in values for s in sizes])
    return out.select(*[F.col("__key")[k].alias(k) for k in keys], "at", *[f"{v}_{s}" for v in values for s in sizes])


def hop(
    df: DataFrame, keys: list[str], slide: int, sizes: dict[str, int], sums: dict[str, Column], sets: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None, mins: dict[str, Column] | None = None, sketches: dict[str, Column] | None = None,
) -> DataFrame:
    """Sliding windows of several sizes in one row per (keys, w_end): columns n_<size>, <sum>_<size>, <set>_<size> (distinct values), <max>_<size> and so on.

    Rows are first collapsed into panes of one slide. A pane is added where it enters the windows and taken off where it leaves those of each size;
    running sums over these points, dealt out by key and day, hold until the next point. So the work is that of the panes and of the result, whatever
    the ratio of size and slide. A value of a set enters with a pane and leaves with the size, or where it enters anew. Fractions
    are summed as decimals (15 places), so that what was added is taken off exactly. w_end is in epoch seconds; a row stands for each end at
    which the largest window holds something. A set counts null as one value where the expression wraps it (see `keyed`).

    Maxima, minima and `sketches` (estimates of distinct values within about two hundredths, by HyperLogLog; a sketch is bounded however many the
    values are) are merged by blocks at the same points (see `extremes`); they are null where a window holds no value, the estimates 0.
    """
    sets, maxes, mins, sketches = sets or {}, maxes or {}, mins or {}, sketches or {}
    longest = max(sizes.values())
    day = slide * -(-max(86_400, longest + slide) // slide)
    pane = (F.floor(F.unix_seconds("et") / slide) * slide).cast("long").alias("pane")
    own, kinds = exact(df, sums)
    panes = df.groupBy(*keys, pane).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in own.items()])
    points = _dealt(panes, keys, {s: F.col("pane") + z for s, z in sizes.items()}, slide, {n: F.col(n) for n in ("n", *sums)}, sizes)
    for name, value in sets.items():
        held = df.select(*keys, pane, value.alias("__v")).where("__v is not null").distinct()
        again = F.lead("pane").over(Window.partitionBy(*keys, "__v").orderBy("pane"))
        held = held.withColumn("again", again)
        leave = {s: F.least(F.col("pane") + z, F.coalesce("again", F.col("pane") + z)) for s, z in sizes.items()}
        held = _dealt(held, keys, leave, slide, {name: F.lit(1).cast("long")}, sizes)
        held = held.groupBy(*keys, "at").agg(*[F.sum(f"{name}_{s}").alias(f"{name}_{s}") for s in sizes])
        points = points.unionByName(held, allowMissingColumns=True)
    names = [f"{n}_{s}" for n in ("n", *sums, *sets) for s in sizes]
    # each day that something may last into begins with a point of its own
    both = points.withColumn("__at", F.explode(F.array("at", ((F.floor(F.col("at") / day) + 1) * day).cast("long"))))
    both = both.select(*keys, F.col("__at").alias("at"), *[F.when(F.col("at") == F.col("__at"), F.col(n)).alias(n) for n in names])
    big = max(sizes, key=sizes.__getitem__)
    level = levels(both, keys, names, day, until=True).where(F.col(f"n_{big}") > 0)
    ends = F.explode(F.sequence(F.col("at"), F.col("until") - slide, F.lit(slide).cast("long"))).alias("w_end")
    back = [F.col(f"{n}_{s}").cast(kinds.get(n, "long")).alias(f"{n}_{s}") for n in ("n", *sums, *sets) for s in sizes]
    merges = dict.fromkeys(maxes, F.max) | dict.fromkeys(mins, F.min) | dict.fromkeys(sketches, F.hll_union_agg)
    if merges:
        more = {n: F.max(c) for n, c in maxes.items()} | {n: F.min(c) for n, c in mins.items()} | {n: F.hll_sketch_agg(c) for n, c in sketches.items()}
        found = extremes(df.groupBy(*keys, pane).agg(*[c.alias(n) for n, c in more.items()]), level, keys, slide, sizes, merges)
        of = [f"{n}_{s}" for n in merges for s in sizes]
        found = found.select(F.struct(*keys).alias("__key"), F.col("at").alias("__at"), *of)
        level = level.withColumns({"__key": F.struct(*keys), "__at": F.col("at")}).join(found, ["__key", "__at"]).drop("__key", "__at")
        back += [(F.hll_sketch_estimate(n) if n.rpartition("_")[0] in sketches else F.col(n)).alias(n) for n in of]
        names = [*names, *of]
    return level.select(*keys, *back, ends).select(*keys, "w_end", *names)


def keyed(value: Column, cond: Column) -> Column:
    """A set member for rows that pass, null kept as a value of its own."""
    return F.when(cond, F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("null")))


def bucket_max(df: DataFrame, keys: list[str], bucket: Column, measures: list[str]) -> DataFrame:
    """The largest of running values for each key and bucket label."""
    return df.groupBy(*keys, bucket.alias("time_str")).agg(*[F.max(m).alias(m) for m in measures])

"""Window-function operators: lags by rows, trailing time frames, relationship counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.operators import frames
from tidewatch.operators.aggregates import cumulative, exact, levels

DAY = 86_400


def lag_rows(df: DataFrame, keys: list[str], order: list[str], value: str, n: int, default=None, name: str | None = None) -> DataFrame:
    """The value n rows earlier. With a default, it stands in for nulls and missing rows; without one the first value fills."""
    w = Window.partitionBy(*keys).orderBy(*order)
    if default is not None:
        own = F.lag(F.coalesce(F.col(value), F.lit(default).cast(df.schema[value].dataType)), n).over(w)
        out = F.coalesce(own, F.lit(default).cast(df.schema[value].dataType))
    else:
        first = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
        out = F.when(F.row_number().over(w) <= n, first).otherwise(F.lag(value, n).over(w))
    return df.withColumn(name or f"{value}_lag_{n}", out)


def lag_dealt(df: DataFrame, keys: list[str], order: list[str], value: str, n: int, default=None, name: str | None = None, seconds: int = 3600) -> DataFrame:
    """`lag_rows` for keys with more rows than one task should hold, in order of `et` and then `order`.

    Rows get numbers from counts that are dealt out by key and hour, and meet the row n numbers before by an equality of key and number; where the
    first value fills, only the n rows that need it meet it. Rows must be in one order: of rows that tie in it any may come first.
    """
    kind, out = df.schema[value].dataType, name or f"{value}_lag_{n}"
    rows = cumulative(df, keys, order, {"__n": F.lit(1).cast("long")}, seconds=seconds)
    at = lambda k: F.struct(*keys, k.alias("__n")).alias("__at")
    fill = None if default is None else F.lit(default).cast(kind)
    v = F.col(value) if default is None else F.coalesce(F.col(value), fill)
    earlier = rows.select(at(F.col("__n") + n), v.alias("__v"), F.lit(True).alias("__there"))
    both = rows.withColumn("__at", at(F.col("__n"))).join(earlier, "__at", "left")
    if default is not None:
        return both.select(*df.columns, F.coalesce("__v", fill).alias(out))
    first = rows.where("__n = 1").select(F.struct(*keys).alias("__key"), F.col(value).alias("__first"))
    early = both.where("__there is null").withColumn("__key", F.struct(*keys)).join(first, "__key").select(*df.columns, F.col("__first").alias(out))
    return both.where("__there").select(*df.columns, F.col("__v").alias(out)).unionByName(early)


def trailing(df: DataFrame, keys: list[str], horizons: dict[str, int], sums: dict[str, Column] | None = None, distinct: dict[str, str] | None = None, named: dict[str, str] | None = None) -> DataFrame:
    """Rows with columns <horizon>_<name>: sums over the last days (`horizons`: name, days) up to and with the row's second, by key.

    `sums` are the addends of each row. `distinct` counts the distinct values of a column; `named` counts the rows, of any key, whose column names
    this row's one key. A row is added at its second and taken off where each horizon ends; a value leaves with the horizon or where it comes anew.
    Running sums over these points are dealt out by key and day (see `levels`) and come back to the rows by key and second. So no frame is gone
    through again for each row, no sets are kept, and the rows of one frequent key are work for many tasks. Null keys are a key of their own, but
    named by nobody; a null addend or value adds nothing; fractions are summed as decimals of 15 places. Rows without a time count 0 and are
    counted by none.
    """
    return meet(df, keys, trailing_levels(df, keys, horizons, sums, distinct, named))


def trailing_levels(df: DataFrame, keys: list[str], horizons: dict[str, int], sums: dict[str, Column] | None = None, distinct: dict[str, str] | None = None, named: dict[str, str] | None = None) -> DataFrame:
    """What `trailing` finds at every second of a key: keys, at (epoch seconds), <horizon>_<name>."""
    sums, distinct, named = sums or {}, distinct or {}, named or {}
    own, kinds = exact(df, sums)
    timed = df.withColumn("__es", F.unix_seconds("et")).where("__es is not null")
    names = [f"{h}_{n}" for h in horizons for n in (*sums, *distinct, *named)]

    def points(held: DataFrame, values: dict[str, Column], leave: dict[str, Column]) -> DataFrame:
        events = [F.struct(F.col("__es").alias("at"), F.lit("").alias("out"))] + [F.struct(leave[h].alias("at"), F.lit(h).alias("out")) for h in horizons]
        cols = [F.when(F.col("__e.out") == "", c).when(F.col("__e.out") == h, -c).alias(f"{h}_{n}") for n, c in values.items() for h in horizons]
        return held.withColumn("__e", F.explode(F.array(*events))).select(*keys, F.col("__e.at").alias("at"), *cols)

    ends = {h: F.col("__es") + d * DAY + 1 for h, d in horizons.items()}
    # every row's second is a point, if only to be asked at
    asked = timed.groupBy(*keys, "__es").agg(F.count("*").alias("__rows"), *[F.sum(c).alias(f"__s_{n}") for n, c in own.items()])
    out = points(asked, {n: F.col(f"__s_{n}") for n in sums}, ends)
    for n, c in distinct.items():
        held = timed.select(*keys, F.col(c).alias("__v"), "__es").where("__v is not null").distinct()
        held = held.withColumn("__again", F.lead("__es").over(Window.partitionBy(*keys, "__v").orderBy("__es")))
        until = {h: F.least(e, F.coalesce("__again", e)) for h, e in ends.items()}
        held = points(held, {n: F.lit(1).cast("long")}, until).groupBy(*keys, "at").agg(*[F.sum(f"{h}_{n}").alias(f"{h}_{n}") for h in horizons])
        out = out.unionByName(held, allowMissingColumns=True)
    for n, c in named.items():
        held = timed.select(F.col(c).alias(keys[0]), "__es").where(F.col(keys[0]).isNotNull()).groupBy(keys[0], "__es").agg(F.count("*").alias("__rows"))
        out = out.unionByName(points(held, {n: F.col("__rows")}, ends), allowMissingColumns=True)
    cast = {f"{h}_{n}": t for h in horizons for n, t in kinds.items()}
    return levels(out, keys, names).select(*keys, "at", *[F.col(n).cast(cast.get(n, "long")).alias(n) for n in names])


def meet(df: DataFrame, keys: list[str], found: DataFrame) -> DataFrame:
    """Rows with the values that stand at their key and second, 0 where none do."""
    names = [c for c in found.columns if c not in (*keys, "at")]
    found = found.select(F.struct(*keys).alias("__key"), F.col("at").alias("__at"), *[F.col(n).alias(f"__{n}") for n in names])
    rows = df.withColumns({"__key": F.struct(*keys), "__at": F.unix_seconds("et")})
    return rows.join(found, ["__key", "__at"], "left").select(*df.columns, *[F.coalesce(F.col(f"__{n}"), F.lit(0)).alias(n) for n in names])


def contact_counts(df: DataFrame, own: str, other: str, horizons: dict[str, int]) -> DataFrame:
    """For each row, how many rows of the last days name its `own` id as their `other` one; columns by name of horizon. A null id is named by nobody."""
    return trailing(df, [own], horizons, named={"named": other}).withColumnsRenamed({f"{h}_named": h for h in horizons})


def union_ids(df: DataFrame, own: str, other: str) -> DataFrame:
    """Own ids marked fake and others' marked real, one under the other."""
    cut = lambda c, flag: df.select("et", "APP_NO", F.col(c).alias("id"), F.lit(flag).alias("flag"))
    return cut(own, "fake").unionByName(cut(other, "real"))


def latest_per(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of each key that is the last in this order (nulls come first); every task keeps one of each key before anything is shuffled."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*[F.col(c).alias(f"o{k}") if isinstance(c, str) else c.alias(f"o{k}") for k, c in enumerate(order)])).alias("__last"))
    return last.select("__last.*")


_NAMES = {1: "one", 3: "three", 7: "seven"}


#: The keys that an application is counted by, and the contacts that it names: a kind, and one column or two.
KEYS = {"cert": ("CERT_NO", None), "mobile": ("MOBILE_NUM", None), "both": ("CERT_NO", "MOBILE_NUM"), "company": ("COMP_NAME", None), "address": ("STANDARD_ADDR", None)}
CONTACTS = {"cert": "SPOUSE_CERT_NO", "mobile": "SPOUSE_MOBILE_NO"}
#: The counts of a kind that features are made of.
_COUNTS = {
    "cert_apply_num": ("cert", "n"), "cert_contact_num": ("cert", "named"), "mobile_contact_num": ("mobile", "named"), "both": ("both", "n"), "mobile": ("mobile", "n"),
    "cert_couple_num": ("cert", "couple"), "cert_couple_mobile_num": ("cert", "couple_mobile"), "company_apply_num": ("company", "n"), "address_apply_num": ("address", "n"),
}
_FEATURES = ("cert_apply_num", "cert_contact_num", "mobile_contact_num", "cert_or_mobile_num", "cert_couple_num", "cert_couple_mobile_num", "company_apply_num", "address_apply_num")


#: Rows of keys that a task of `velocity_features` gets, on average.
TASK_ROWS = 2_000_000


def horizon_names(horizons: tuple[int, ...]) -> dict[str, int]:
    return {f"{_NAMES.get(d, d)}_days": d for d in horizons}


def entries(mark: Callable[[str], Column] = F.lit) -> tuple[Column, Column]:
    """An application as each of its keys sees it (kind, a, b, own = 1, and the contacts that it names), and as the contacts that it names see it (own = 0).

    `mark` is what stands for a kind.
    """

    def entry(kind: str, a: str, b: str | None, own: int) -> Column:
        couple = [(F.col(c) if kind == "cert" and own else F.lit(None)).cast("string") for c in CONTACTS.values()]
        second = (F.col(b) if b else F.lit(None)).cast("string")
        return F.struct(mark(kind).alias("kind"), F.col(a).cast("string").alias("a"), second.alias("b"), F.lit(own).alias("own"), couple[0].alias("couple"), couple[1].alias("couple_mobile"))

    contacts = F.array(*[entry(k, c, None, 0) for k, c in CONTACTS.items()])
    return F.array(*[entry(k, a, b, 1) for k, (a, b) in KEYS.items()]), F.filter(contacts, lambda x: x["a"].isNotNull())


def gathered(names: dict[str, int], mark: Callable[[str], Column] = F.lit) -> list[Column]:
    """Aggregates of an application's rows by kind (columns <horizon>_<count>), one for each count of a feature."""
    return [F.max(F.when(F.col("kind") == mark(k), F.col(f"{d}_{n}"))).alias(f"{d}_{name}") for d in names for name, (k, n) in _COUNTS.items()]


def features(rows: DataFrame, names: dict[str, int]) -> DataFrame:
    """The features of applications from their gathered counts."""
    rows = rows.withColumns({f"{d}_cert_or_mobile_num": F.col(f"{d}_cert_apply_num") - F.col(f"{d}_both") + F.col(f"{d}_mobile") for d in names})
    return rows.select("APP_NO", "CERT_NO", *[f"{d}_{k}" for d in names for k in _FEATURES])


def velocity_features(df: DataFrame, horizons: tuple[int, ...] = (1, 3, 7), drop_null_keys: bool = True) -> DataFrame:
    """Eight counts over each trailing horizon for every application, on its own row: no join back multiplies rows.

    By identity, phone, employer, address; by identity or phone; how often named as a contact by id or phone; distinct spouses' ids and phones. Every
    row goes once to each of its keys, dealt out by spans of two of the longest horizons, and to the next span too if that may still count it. There
    the rows lie in order of seconds and one pass finds all counts (see `frames`): it holds a chunk of rows and the seconds of the longest horizon,
    however many rows a key has. The counts come together by application. Rows are counted first, so that tasks don't grow with them. Rows
    without a time count 0 and are counted by none.
    """
    if drop_null_keys:
        df = df.dropna(subset=["CERT_NO", "MOBILE_NUM", "COMP_NAME", "STANDARD_ADDR"])
    mark = lambda kind: F.lit(list(KEYS).index(kind)).cast("byte")
    names, (own, contacts) = horizon_names(horizons), entries(mark)
    longest, spark = max(horizons) * DAY, df.sparkSession
    span = 2 * longest
    keys = len(KEYS) + len(CONTACTS)
    tasks = max(spark.sparkContext.defaultParallelism, -(-keys * 3 * df.count() // (2 * TASK_ROWS)))
    timed = df.withColumns({"__row": F.monotonically_increasing_id(), "es": F.unix_seconds("et")}).withColumn("bucket", F.floor(F.col("es") / span))
    here, later = F.struct("bucket", F.col("__row").alias("row")), F.struct((F.col("bucket") + 1).alias("bucket"), F.lit(None).cast("long").alias("row"))
    spans = F.when(F.col("es") + longest >= (F.col("bucket") + 1) * span, F.array(here, later)).otherwise(F.array(here))
    rows = timed.withColumn("s", F.explode(spans)).select("APP_NO", "CERT_NO", "es", "s.*", F.explode(F.concat(own, contacts)).alias("x"))
    rows = rows.select("APP_NO", "CERT_NO", "es", "bucket", F.when(F.col("x.own") == 1, F.col("row")).alias("row"), "x.*")
    named = F.col("row").isNotNull() & (F.col("kind") == mark("cert"))  # the names of an application travel with one of its keys
    rows = rows.withColumns({c: F.when(named, F.col(c)) for c in ("APP_NO", "CERT_NO")} | {"h": F.xxhash64("kind", "a", "b", "bucket")})
    rows = rows.repartition(tasks, "h").sortWithinPartitions("h", "kind", "a", "b", "bucket", "es").drop("h")
    kept, counts = ["row", "kind", "APP_NO", "CERT_NO"], [f"{d}_{n}" for d in names for n in ("n", "named", "couple", "couple_mobile")]
    schema = StructType([*rows.select(*kept).schema.fields, *[StructField(c, LongType()) for c in counts]])
    found = rows.mapInArrow(frames.counting(list(horizons), span, kept, counts), schema)
    # dealt before they are grouped: an application's counts come from other tasks, so nothing could be put together sooner
    of = found.repartition(tasks, "row").groupBy("row")
    return features(of.agg(F.max("APP_NO").alias("APP_NO"), F.max("CERT_NO").alias("CERT_NO"), *gathered(names, mark)), names)

"""The monitors: totals so far, windows of several sizes, and comparisons with earlier windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import approved, ratio
from tidewatch.operators.aggregates import cumulative, hop, keyed, running_totals
from tidewatch.operators.joins import align_running, join_hop
from tidewatch.operators.over import lag_rows

KEY = "BUSINESS_TYPE_CD"
SIZES = {"1H": 3600, "2H": 7200, "6H": 21600}


def _flag(c: Column) -> Column:
    return F.when(c, 1).otherwise(0).cast("long")


def result_flags(black: int = 0) -> dict[str, Column]:
    """What each result counts towards. Windows count BLACK_LIST = 0, running totals 1."""
    ok = approved(F.col("CREDIT_CODE"))
    return {
        "ACC_C_CT": _flag(ok),
        "APP_C_WL_CCT": _flag(F.col("WHITE_LIST") == 1),
        "ACC_C_WL_CCT": _flag(ok & (F.col("WHITE_LIST") == 1)),
        "APP_C_UWL_CCT": _flag(F.col("WHITE_LIST") == 0),
        "ACC_C_UWL_CCT": _flag(ok & (F.col("WHITE_LIST") == 0)),
        "AF_ACC_C_CT": _flag(F.col("BLACK_LIST") == black),
    }


def running_results(results: DataFrame) -> DataFrame:
    return running_totals(results, [KEY], {n: F.sum(c) for n, c in result_flags(1).items()} | {"AVG_ACC_CCSCT": F.avg("CREDIT_SCORE_1"), "AVG_ACC_PCSCT": F.avg("APPLY_SCORE"), "r_ts": F.max("CREDIT_TIME")})


def running_applies(applies: DataFrame) -> DataFrame:
    return running_totals(applies, [KEY], {"APP_C_CT": F.count(F.lit(1)), "ts": F.max("APPLY_TIME")})


def rates(df: DataFrame, mode: str = "exact") -> DataFrame:
    """Pass rates of running totals."""
    pairs = {"PR_CT": ("ACC_C_CT", "APP_C_CT"), "PR_WL_CCT": ("ACC_C_WL_CCT", "APP_C_WL_CCT"), "PR_UWL_CCT": ("ACC_C_UWL_CCT", "APP_C_UWL_CCT"), "AF_PR_CT": ("AF_ACC_C_CT", "APP_C_CT")}
    return df.withColumns({n: F.round(ratio(F.col(a), F.col(b), mode=mode), 6) for n, (a, b) in pairs.items()})


TOTALS = ["APP_C_CT", "ACC_C_CT", "PR_CT", "APP_C_WL_CCT", "ACC_C_WL_CCT", "PR_WL_CCT", "APP_C_UWL_CCT", "ACC_C_UWL_CCT", "PR_UWL_CCT", "AF_ACC_C_CT", "AF_PR_CT"]


def running_product_rates(applies: DataFrame, results: DataFrame, mode: str = "exact") -> DataFrame:
    """Totals of both streams and their rates, for products that both hold."""
    return rates(running_applies(applies).join(running_results(results), KEY), mode).select(KEY, "ts", *TOTALS)


def running_events(applies: DataFrame, results: DataFrame, mode: str = "exact") -> DataFrame:
    """The same after every event of either stream: one tagged union, summed by hours and within them."""
    flags = result_flags(1)
    none = {n: F.lit(0).cast("long") for n in flags}
    a = applies.select(KEY, "et", "seq", F.lit(1).cast("long").alias("APP_C_CT"), F.lit(0).alias("r"), *[c.alias(n) for n, c in none.items()])
    b = results.select(KEY, "et", "seq", F.lit(0).cast("long").alias("APP_C_CT"), F.lit(1).alias("r"), *[c.alias(n) for n, c in flags.items()])
    both = a.unionByName(b).select(KEY, "et", "seq", *[F.col(n).cast("long").alias(f"own_{n}") for n in ("APP_C_CT", "r", *flags)])
    both = cumulative(both, [KEY], ["seq"], {n: F.col(f"own_{n}") for n in ("APP_C_CT", "r", *flags)})
    return rates(both.where("APP_C_CT > 0 and r > 0"), mode).select(KEY, "et", "seq", *TOTALS)


def apply_windows(applies: DataFrame, slide: int, sizes: dict[str, int]) -> DataFrame:
    return hop(applies, [KEY], slide, sizes, {})


def result_measures() -> tuple[dict[str, Column], dict[str, Column]]:
    """What windows sum of each result, and the sets whose distinct values they count."""
    ok = approved(F.col("CREDIT_CODE"))
    risky = ok & (F.coalesce("CREDIT_SCORE_1", F.lit(0.0)).cast("int") < 220) & (F.coalesce("CREDIT_LIMIT", F.lit(0.0)) > 40000)
    sums = result_flags(0) | {"CS": F.when(ok, F.col("CREDIT_SCORE_1")).otherwise(0.0), "PS": F.when(ok, F.col("APPLY_SCORE")).otherwise(0).cast("double")}
    return sums, {"ACC_C_CCT": keyed(F.col("CUST_ID"), ok), "OC": keyed(F.col("CUST_ID"), risky)}


def result_windows(results: DataFrame, slide: int, sizes: dict[str, int]) -> DataFrame:
    return hop(results, [KEY], slide, sizes, *result_measures())


WINDOWED = ["APP_C_CT", "ACC_C_CT", "PR_CT", "ACC_C_CCT", "AVG_AC_CCT", "APP_C_WL_CCT", "ACC_C_WL_CCT", "PR_WL_CCT", "APP_C_UWL_CCT", "ACC_C_UWL_CCT", "PR_UWL_CCT", "AF_ACC_C_CT", "AF_PR_CT", "AVG_ACC_CCSCT", "AVG_ACC_PCSCT", "RATE_OC"]


def windowed(applies: DataFrame, results: DataFrame, slide: int = 10, sizes: dict[str, int] = SIZES, mode: str = "exact") -> DataFrame:
    """The windows of all sizes that end together, where the smallest holds rows of both streams."""
    least = min(sizes, key=sizes.__getitem__)
    a = apply_windows(applies, slide, sizes).where(F.col(f"n_{least}") > 0)
    a = a.select(KEY, "w_end", *[F.col(f"n_{s}").alias(f"APP_C_CT_{s}") for s in sizes])
    r = result_windows(results, slide, sizes).where(F.col(f"n_{least}") > 0)
    return window_rates(join_hop(a, r, [KEY]), sizes, mode).select(KEY, "w_end", *[f"{n}_{s}" for n in WINDOWED for s in sizes])


def window_rates(both: DataFrame, sizes: dict[str, int], mode: str = "exact") -> DataFrame:
    """Rates and means of the sums of both streams' windows, for each size."""
    out = {}
    for s in sizes:
        c = lambda n, s=s: F.col(f"{n}_{s}")
        out |= {
            f"PR_CT_{s}": ratio(c("ACC_C_CT"), c("APP_C_CT"), mode=mode),
            f"AVG_AC_CCT_{s}": ratio(c("ACC_C_CCT"), c("APP_C_CT"), mode=mode),
            f"PR_WL_CCT_{s}": ratio(c("ACC_C_WL_CCT"), c("APP_C_WL_CCT"), mode=mode),
            f"PR_UWL_CCT_{s}": ratio(c("ACC_C_UWL_CCT"), c("APP_C_UWL_CCT"), mode=mode),
            f"AF_PR_CT_{s}": ratio(c("AF_ACC_C_CT"), c("APP_C_CT"), mode=mode),
            f"AVG_ACC_CCSCT_{s}": ratio(c("CS"), c("ACC_C_CT")),
            f"AVG_ACC_PCSCT_{s}": ratio(c("PS"), c("ACC_C_CT")),
            f"RATE_OC_{s}": ratio(c("OC"), c("ACC_C_CCT"), mode=mode),
        }
    return both.withColumns({n: F.round(c, 6) for n, c in out.items()})


def product_monitor(applies: DataFrame, results: DataFrame, slide: int = 10, which: str = "next", mode: str = "exact", sizes: dict[str, int] = SIZES, names: DataFrame | None = None) -> DataFrame:
    """Running totals after every event with the windows that close next (or closed last), and the product's name: 62 columns and the event.

    `names` (product, BUSINESS_TYPE_NAME) gives the products' names (the first of several by the alphabet); without it the one product that is known has one.
    """
    run = running_events(applies, results, mode)
    full = align_running(run, windowed(applies, results, slide, sizes, mode), KEY, slide, which)
    if names is None:
        name = F.when(F.col(KEY) == "P0", "product zero").alias("BUSINESS_TYPE_NAME")
    else:
        full, name = full.join(names.groupBy(KEY).agg(F.min("BUSINESS_TYPE_NAME").alias("BUSINESS_TYPE_NAME")), KEY, "left"), F.col("BUSINESS_TYPE_NAME")
    return full.select(KEY, name, F.unix_seconds("et").alias("DT"), "seq", *TOTALS, *[f"{n}_{s}" for n in WINDOWED for s in sizes])


#: Means over a window's results; nulls don't count.
AVERAGES = {
    "AVG_CS_1": "CREDIT_SCORE_1", "AVG_CS_2": "CREDIT_SCORE_2", "AVG_CS_3": "CREDIT_SCORE_3", "AVG_AFS_1": "ANTI_FRAUD_SCORE_1",
    "AVG_AFS_2": "ANTI_FRAUD_SCORE_2", "AVG_LIMIT": "CREDIT_LIMIT", "AVG_RATE": "INTEREST_RATE",
}


def period_measures() -> dict[str, Column]:
    """What windows sum of each result for the period monitor: approvals, and each mean's values and how many they are."""
    held = {n: F.when(F.col(c).isNotNull(), 1).otherwise(0).cast("long") for n, c in AVERAGES.items()}
    return {"success_num": _flag(approved(F.col("CREDIT_CODE")))} | {n: F.col(c) for n, c in AVERAGES.items()} | {f"with_{n}": c for n, c in held.items()}


def period_means(size: str) -> list[Column]:
    return [F.when(F.col(f"with_{n}_{size}") > 0, F.col(f"{n}_{size}") / F.col(f"with_{n}_{size}")).alias(n) for n in AVERAGES]


def hop_apply_series(applies: DataFrame, slide: int, size: int, day: int) -> DataFrame:
    a = apply_windows(applies, slide, {"H": size}).select(KEY, "w_end", F.col("n_H").alias("apply_num"))
    a = lag_rows(a, [KEY], ["w_end"], "apply_num", 1, 0, "last_num")
    return lag_rows(a, [KEY], ["w_end"], "apply_num", day, 0, "last_24_num")


def period_over_period(applies: DataFrame, results: DataFrame, slide: int = 10, size: int = 3600, day: int | None = None) -> DataFrame:
    """One-hour windows of both streams against the window before and the one a day of slides earlier, and the rates of their rates: 18 columns."""
    day = day or 86_400 // slide
    a = hop_apply_series(applies, slide, size, day)
    r = hop(results, [KEY], slide, {"H": size}, period_measures())
    r = r.select(KEY, "w_end", F.col("n_H").alias("return_num"), F.col("success_num_H").alias("success_num"), *period_means("H"))
    r = lag_rows(lag_rows(r, [KEY], ["w_end"], "success_num", 1, 0, "r_last"), [KEY], ["w_end"], "success_num", day, 0, "r_last_24")
    return period_rates(join_hop(a, r, [KEY]))


def period_rates(both: DataFrame) -> DataFrame:
    """The period monitor's columns of windows with their counts, means and what these counts were a window and a day before."""
    pr = F.col("success_num") / F.col("apply_num")

    def against(before: str, a_before: str) -> Column:
        guard = (F.col("apply_num") == 0) | (F.col(before) <= 0) | (F.col(a_before) <= 0)
        return F.when(guard, -999.0).otherwise(pr / (F.col(before) / F.col(a_before)))

    return both.select(
        F.col(KEY).alias("P_ID"),
        F.col("w_end").alias("DT"),
        F.hour(F.timestamp_seconds("w_end")).cast("long").alias("CH"),
        F.col("apply_num").alias("APP_C_PH"),
        F.col("return_num").alias("R_C_PH"),
        F.col("success_num").alias("ACC_C_PH"),
        F.round(ratio(F.col("apply_num"), F.col("last_num")), 6).alias("APP_P_H"),
        F.round(ratio(F.col("apply_num"), F.col("last_24_num")), 6).alias("APP_P_D"),
        F.round(ratio(F.col("success_num"), F.col("apply_num")), 6).alias("PR"),
        F.round(against("r_last", "last_num"), 6).alias("PR_P_H"),
        F.round(against("r_last_24", "last_24_num"), 6).alias("PR_P_D"),
        *[F.round(n, 6).alias(n) for n in AVERAGES],
    )


def two_stream_demo(applies: DataFrame, results: DataFrame, slide: int = 10) -> DataFrame:
    """Running counts of both streams with the one-hour counts of the window that closed last."""
    run = running_events(applies, results).select(KEY, "et", "seq", "APP_C_CT", "ACC_C_CT")
    w = windowed(applies, results, slide, {"1H": 3600}).select(KEY, "w_end", "APP_C_CT_1H", "ACC_C_CT_1H")
    return align_running(run, w, KEY, slide, "previous").select(KEY, F.unix_seconds("et").alias("DT"), "seq", "APP_C_CT", "ACC_C_CT", "APP_C_CT_1H", "ACC_C_CT_1H")



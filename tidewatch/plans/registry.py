"""The registered queries over the events table, and the SQL that they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scalars import approved, avg_if, bucket_label, count_where, distinct_if, ratio
from tidewatch.operators import aggregates, joins, over
from tidewatch.plans import monitor
from tidewatch.sources import credit

KEY, SLIDE = monitor.KEY, 600
#: The cadence that the monitors are meant for; every sliding-window query is registered with it too, under its name with _10s.
REFERENCE_SLIDE = 10
_SIZES = {"1H": 3600, "2H": 7200, "6H": 21600}

_BASE = """WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms, json_extract_string(props, '$.k')::INT AS k FROM events),
a AS (SELECT event_id AS seq, user_id::VARCHAR AS CUST_ID, 'P' || (user_id % 4) AS BUSINESS_TYPE_CD, ms AS APPLY_TIME, ms // 1000 AS es
      FROM e WHERE event_type IN ('view', 'click')),
r AS (SELECT event_id AS seq, user_id::VARCHAR AS CUST_ID, 'P' || (user_id % 4) AS BUSINESS_TYPE_CD, event_type <> 'error' AS ok,
      value AS CREDIT_SCORE_1, value / 2 AS CREDIT_SCORE_2, value + k AS CREDIT_SCORE_3, k::DOUBLE AS ANTI_FRAUD_SCORE_1,
      CASE WHEN k % 3 <> 0 THEN k * 2.0 END::DOUBLE AS ANTI_FRAUD_SCORE_2, value / 100 AS INTEREST_RATE, value * 300 AS CREDIT_LIMIT, k % 2 AS WHITE_LIST, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS BLACK_LIST, k AS APPLY_SCORE,
      ms AS CREDIT_TIME, ms // 1000 AS es FROM e WHERE event_type IN ('purchase', 'signup', 'error')),
l AS (SELECT event_id::VARCHAR AS APP_NO, event_id AS seq, user_id::VARCHAR AS CERT_NO, (user_id % 50)::VARCHAR AS MOBILE_NUM, event_type AS COMP_NAME,
      (user_id % 20)::VARCHAR AS STANDARD_ADDR, ((user_id * 7) % 150)::VARCHAR AS SPOUSE_CERT_NO, ((user_id * 7) % 50)::VARCHAR AS SPOUSE_MOBILE_NO,
      (k % 3)::VARCHAR AS CERT_TYPE, ms // 1000 AS es FROM e)"""
_TOTALS = """count(*) FILTER (ok) AS ACC_C_CT, count(*) FILTER (WHITE_LIST = 1) AS APP_C_WL_CCT, count(*) FILTER (ok AND WHITE_LIST = 1) AS ACC_C_WL_CCT,
count(*) FILTER (WHITE_LIST = 0) AS APP_C_UWL_CCT, count(*) FILTER (ok AND WHITE_LIST = 0) AS ACC_C_UWL_CCT"""


def _rate(a: str, b: str, name: str) -> str:
    return f"round(CASE WHEN {b} = 0 THEN -999.0 ELSE {a}::DOUBLE / {b} END, 6) AS {name}"


_RATES = ", ".join([_rate("ACC_C_CT", "APP_C_CT", "PR_CT"), _rate("ACC_C_WL_CCT", "APP_C_WL_CCT", "PR_WL_CCT"), _rate("ACC_C_UWL_CCT", "APP_C_UWL_CCT", "PR_UWL_CCT"), _rate("AF_ACC_C_CT", "APP_C_CT", "AF_PR_CT")])
_RUNNING = f""", ra AS (SELECT BUSINESS_TYPE_CD, count(*) AS APP_C_CT, max(APPLY_TIME) AS ts FROM a GROUP BY 1),
rr AS (SELECT BUSINESS_TYPE_CD, {_TOTALS}, count(*) FILTER (BLACK_LIST = 1) AS AF_ACC_C_CT, avg(CREDIT_SCORE_1) AS cs, avg(APPLY_SCORE) AS ps, max(CREDIT_TIME) AS r_ts FROM r GROUP BY 1)"""


def _dealt(table: str, name: str, size: int, slide: int) -> str:
    return f"{name} AS (SELECT *, es // {slide} * {slide} AS pane, unnest(range(es // {slide} * {slide} + {slide}, es // {slide} * {slide} + {size} + 1, {slide})) AS w_end FROM {table})"


def _windows(sizes: dict[str, int], slide: int) -> str:
    most = max(sizes.values())
    least = min(sizes, key=sizes.__getitem__)
    wa = ", ".join(f"count(*) FILTER (w_end <= pane + {n}) AS APP_C_CT_{s}" for s, n in sizes.items())
    wr = []
    for s, n in sizes.items():
        q = f"w_end <= pane + {n}"
        wr += [f"count(*) FILTER ({q}) AS n_{s}", f"count(*) FILTER ({q} AND ok) AS ACC_C_CT_{s}", f"count(*) FILTER ({q} AND WHITE_LIST = 1) AS APP_C_WL_CCT_{s}"]
        wr += [f"count(*) FILTER ({q} AND ok AND WHITE_LIST = 1) AS ACC_C_WL_CCT_{s}", f"count(*) FILTER ({q} AND WHITE_LIST = 0) AS APP_C_UWL_CCT_{s}"]
        wr += [f"count(*) FILTER ({q} AND ok AND WHITE_LIST = 0) AS ACC_C_UWL_CCT_{s}", f"count(*) FILTER ({q} AND BLACK_LIST = 0) AS AF_ACC_C_CT_{s}"]
        wr += [f"count(DISTINCT CUST_ID) FILTER ({q} AND ok) AS ACC_C_CCT_{s}"]
        wr += [f"count(DISTINCT CUST_ID) FILTER ({q} AND ok AND trunc(CREDIT_SCORE_1) < 220 AND CREDIT_LIMIT > 40000) AS OC_{s}"]
        wr += [f"sum(CASE WHEN ok THEN CREDIT_SCORE_1 ELSE 0 END) FILTER ({q}) AS CS_{s}", f"sum(CASE WHEN ok THEN APPLY_SCORE ELSE 0 END) FILTER ({q}) AS PS_{s}"]
    cols = []
    for s in sizes:
        cols += [f"{n}_{s}" for n in ("APP_C_CT", "ACC_C_CT", "ACC_C_CCT", "APP_C_WL_CCT", "ACC_C_WL_CCT", "APP_C_UWL_CCT", "ACC_C_UWL_CCT", "AF_ACC_C_CT")]
        pairs = {"PR_CT": ("ACC_C_CT", "APP_C_CT"), "AVG_AC_CCT": ("ACC_C_CCT", "APP_C_CT"), "PR_WL_CCT": ("ACC_C_WL_CCT", "APP_C_WL_CCT"), "PR_UWL_CCT": ("ACC_C_UWL_CCT", "APP_C_UWL_CCT"), "AF_PR_CT": ("AF_ACC_C_CT", "APP_C_CT"), "AVG_ACC_CCSCT": ("CS", "ACC_C_CT"), "AVG_ACC_PCSCT": ("PS", "ACC_C_CT"), "RATE_OC": ("OC", "ACC_C_CCT")}
        cols += [_rate(f"{a}_{s}", f"{b}_{s}", f"{n}_{s}") for n, (a, b) in pairs.items()]
    return f""", {_dealt("a", "da", most, slide)}, {_dealt("r", "dr", most, slide)},
ha AS (SELECT BUSINESS_TYPE_CD, w_end, {wa} FROM da GROUP BY 1, 2),
hr AS (SELECT BUSINESS_TYPE_CD, w_end, {", ".join(wr)} FROM dr GROUP BY 1, 2),
w AS (SELECT BUSINESS_TYPE_CD, w_end, {", ".join(cols)} FROM ha JOIN hr USING (BUSINESS_TYPE_CD, w_end) WHERE APP_C_CT_{least} > 0 AND n_{least} > 0)"""


_EVENTS = f""", u AS (SELECT BUSINESS_TYPE_CD, es, seq, 1 AS isa, false AS ok, NULL AS WHITE_LIST, NULL AS BLACK_LIST FROM a
  UNION ALL SELECT BUSINESS_TYPE_CD, es, seq, 0, ok, WHITE_LIST, BLACK_LIST FROM r),
ue0 AS (SELECT BUSINESS_TYPE_CD, es, seq, sum(isa) OVER q AS APP_C_CT, sum(1 - isa) OVER q AS rs, sum((isa = 0 AND ok)::INT) OVER q AS ACC_C_CT,
  coalesce(sum((WHITE_LIST = 1)::INT) OVER q, 0) AS APP_C_WL_CCT, coalesce(sum((ok AND WHITE_LIST = 1)::INT) OVER q, 0) AS ACC_C_WL_CCT,
  coalesce(sum((WHITE_LIST = 0)::INT) OVER q, 0) AS APP_C_UWL_CCT, coalesce(sum((ok AND WHITE_LIST = 0)::INT) OVER q, 0) AS ACC_C_UWL_CCT,
  coalesce(sum((BLACK_LIST = 1)::INT) OVER q, 0) AS AF_ACC_C_CT
  FROM u WINDOW q AS (PARTITION BY BUSINESS_TYPE_CD ORDER BY es, seq ROWS UNBOUNDED PRECEDING)),
ue AS (SELECT BUSINESS_TYPE_CD, es, seq, APP_C_CT::BIGINT AS APP_C_CT, ACC_C_CT::BIGINT AS ACC_C_CT, APP_C_WL_CCT::BIGINT AS APP_C_WL_CCT, ACC_C_WL_CCT::BIGINT AS ACC_C_WL_CCT,
  APP_C_UWL_CCT::BIGINT AS APP_C_UWL_CCT, ACC_C_UWL_CCT::BIGINT AS ACC_C_UWL_CCT, AF_ACC_C_CT::BIGINT AS AF_ACC_C_CT, {_RATES} FROM ue0 WHERE APP_C_CT > 0 AND rs > 0)"""
_T = ", ".join(monitor.TOTALS)
_W = ", ".join(f"{n}_{s}" for n in monitor.WINDOWED for s in _SIZES)


def _velocity(days: tuple[int, ...]) -> str:
    out = []
    for d in days:
        n = {1: "one", 3: "three", 7: "seven"}[d] + "_days"
        q = lambda key, d=d: f"OVER (PARTITION BY {key} ORDER BY es RANGE BETWEEN {d * 86400} PRECEDING AND CURRENT ROW)"
        one = lambda key: f"count(*) {q(key)}"
        c = lambda me, other, d=d: f"(SELECT count(*) FROM l x WHERE x.{other} = l.{me} AND x.es BETWEEN l.es - {d * 86400} AND l.es)"
        out += [f"{one('CERT_NO')} AS {n}_cert_apply_num", f"{c('CERT_NO', 'SPOUSE_CERT_NO')} AS {n}_cert_contact_num", f"{c('MOBILE_NUM', 'SPOUSE_MOBILE_NO')} AS {n}_mobile_contact_num"]
        out += [f"{one('CERT_NO')} - {one('CERT_NO, MOBILE_NUM')} + {one('MOBILE_NUM')} AS {n}_cert_or_mobile_num"]
        out += [f"count(DISTINCT SPOUSE_CERT_NO) {q('CERT_NO')} AS {n}_cert_couple_num", f"count(DISTINCT SPOUSE_MOBILE_NO) {q('CERT_NO')} AS {n}_cert_couple_mobile_num"]
        out += [f"{one('COMP_NAME')} AS {n}_company_apply_num", f"{one('STANDARD_ADDR')} AS {n}_address_apply_num"]
    return f"{_BASE} SELECT APP_NO, CERT_NO, {', '.join(out)} FROM l"


def _pop(slide: int) -> str:
    return f""", {_dealt("a", "da", 3600, slide)}, {_dealt("r", "dr", 3600, slide)},
ha AS (SELECT BUSINESS_TYPE_CD, w_end, count(*) AS apply_num FROM da GROUP BY 1, 2),
hr AS (SELECT BUSINESS_TYPE_CD, w_end, count(*) AS return_num, count(*) FILTER (ok) AS success_num, {", ".join(f"sum({c}::DECIMAL(36,15))::DOUBLE / count({c}) AS {n}" for n, c in monitor.AVERAGES.items())} FROM dr GROUP BY 1, 2),
la AS (SELECT *, coalesce(lag(apply_num, 1) OVER q, 0) AS last_num, coalesce(lag(apply_num, {86400 // slide}) OVER q, 0) AS last_24_num FROM ha WINDOW q AS (PARTITION BY BUSINESS_TYPE_CD ORDER BY w_end)),
lr AS (SELECT *, coalesce(lag(success_num, 1) OVER q, 0) AS r_last, coalesce(lag(success_num, {86400 // slide}) OVER q, 0) AS r_last_24 FROM hr WINDOW q AS (PARTITION BY BUSINESS_TYPE_CD ORDER BY w_end))"""


Query = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]
_ALL: dict[str, tuple[Query, str]] = {}


def _put(name: str, query: Query, sql: str) -> None:
    _ALL[name] = (query, _BASE + sql)


def _ok():
    return approved(F.col("CREDIT_CODE"))

def _secs():
    return F.unix_seconds("et")



def _one(a: DataFrame, r: DataFrame, slide: int) -> DataFrame:
    return monitor.windowed(a, r, slide, {"1H": 3600})


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _run(a: DataFrame, r: DataFrame) -> DataFrame:
    return monitor.running_applies(a).join(monitor.running_results(r), KEY)


_put("running_apply_totals", lambda a, r, x: monitor.running_applies(a), _RUNNING + " SELECT * FROM ra")
_put("running_result_totals", lambda a, r, x: monitor.running_results(r).select(KEY, *monitor.result_flags(1), F.round("AVG_ACC_CCSCT", 6).alias("AVG_ACC_CCSCT"), F.round("AVG_ACC_PCSCT", 6).alias("AVG_ACC_PCSCT")),
     _RUNNING + " SELECT BUSINESS_TYPE_CD, ACC_C_CT, APP_C_WL_CCT, ACC_C_WL_CCT, APP_C_UWL_CCT, ACC_C_UWL_CCT, AF_ACC_C_CT, round(cs, 6) AS AVG_ACC_CCSCT, round(ps, 6) AS AVG_ACC_PCSCT FROM rr")
_put("running_product_rates", lambda a, r, x: monitor.running_product_rates(a, r), _RUNNING + f", j AS (SELECT *, {_RATES} FROM ra JOIN rr USING (BUSINESS_TYPE_CD)) SELECT BUSINESS_TYPE_CD, ts, {_T} FROM j")
_put("running_product_rates_integer", lambda a, r, x: monitor.running_product_rates(a, r, "integer").select(KEY, "PR_CT", "AF_PR_CT"),
     _RUNNING + " SELECT BUSINESS_TYPE_CD, (ACC_C_CT // APP_C_CT)::DOUBLE AS PR_CT, (AF_ACC_C_CT // APP_C_CT)::DOUBLE AS AF_PR_CT FROM ra JOIN rr USING (BUSINESS_TYPE_CD)")
_put("running_time_guarded", lambda a, r, x: joins.join_running(monitor.running_applies(a).withColumn("a_et", F.timestamp_millis("ts")), monitor.running_results(r).withColumn("r_et", F.timestamp_millis("r_ts")), KEY, ("a_et", "r_et", 3600)).select(KEY, "ts", "r_ts", "APP_C_CT", "ACC_C_CT"),
     _RUNNING + " SELECT BUSINESS_TYPE_CD, ts, r_ts, APP_C_CT, ACC_C_CT FROM ra JOIN rr USING (BUSINESS_TYPE_CD) WHERE abs(ts // 1000 - r_ts // 1000) <= 3600")
_put("running_per_event", lambda a, r, x: monitor.running_events(a, r).select(KEY, _secs().alias("es"), "seq", *monitor.TOTALS), _EVENTS + f" SELECT BUSINESS_TYPE_CD, es, seq, {_T} FROM ue")
_put("approved_customers", lambda a, r, x: r.groupBy(KEY).agg(distinct_if(F.col("CUST_ID"), _ok()).alias("n")), " SELECT BUSINESS_TYPE_CD, count(DISTINCT CUST_ID) FILTER (ok) AS n FROM r GROUP BY 1")
def _risky():
    return _ok() & (F.coalesce("CREDIT_SCORE_1", F.lit(0.0)).cast("int") < 220) & (F.coalesce("CREDIT_LIMIT", F.lit(0.0)) > 40000)

_put("risky_customer_rate", lambda a, r, x: r.groupBy(KEY).agg(F.round(ratio(distinct_if(F.col("CUST_ID"), _risky()), distinct_if(F.col("CUST_ID"), _ok())), 6).alias("rate")),
     " SELECT BUSINESS_TYPE_CD, round(CASE WHEN count(DISTINCT CUST_ID) FILTER (ok) = 0 THEN -999.0 ELSE count(DISTINCT CUST_ID) FILTER (ok AND trunc(CREDIT_SCORE_1) < 220 AND CREDIT_LIMIT > 40000)::DOUBLE / count(DISTINCT CUST_ID) FILTER (ok) END, 6) AS rate FROM r GROUP BY 1")
_put("conditional_avg", lambda a, r, x: r.groupBy(KEY).agg(F.round(avg_if(F.col("CREDIT_SCORE_1"), _ok()), 6).alias("mean"), count_where(_ok()).alias("n")), " SELECT BUSINESS_TYPE_CD, round(avg(CREDIT_SCORE_1) FILTER (ok), 6) AS mean, count(*) FILTER (ok) AS n FROM r GROUP BY 1")
def _sliding(slide: int, suffix: str) -> None:
    """The sliding-window queries with this slide, over all events."""
    _put(f"hop_result_profile{suffix}", lambda a, r, x: aggregates.hop(r, [KEY], slide, {"H": 3600}, {"cs": F.col("CREDIT_SCORE_1"), "lim": F.col("CREDIT_LIMIT")}).select(KEY, "w_end", F.col("n_H").alias("n"), F.round(F.col("cs_H") / F.col("n_H"), 6).alias("cs"), F.round(F.col("lim_H") / F.col("n_H"), 6).alias("lim")),
         _pop(slide) + " SELECT BUSINESS_TYPE_CD, w_end, return_num AS n, round(AVG_CS_1, 6) AS cs, round(AVG_LIMIT, 6) AS lim FROM hr")
    _put(f"hop_apply_named{suffix}", lambda a, r, x: aggregates.hop(a, [KEY, "BUSINESS_TYPE_NAME"], slide, {"H": 3600}, {}), _pop(slide) + " SELECT BUSINESS_TYPE_CD, 'name ' || BUSINESS_TYPE_CD AS BUSINESS_TYPE_NAME, w_end, apply_num AS n_H FROM ha")
    _put(f"hop_result_1h{suffix}", lambda a, r, x: _one(a, r, slide).select(KEY, "w_end", "AVG_ACC_CCSCT_1H", "AVG_ACC_PCSCT_1H", "RATE_OC_1H", "ACC_C_CCT_1H"), _windows({"1H": 3600}, slide) + " SELECT BUSINESS_TYPE_CD, w_end, AVG_ACC_CCSCT_1H, AVG_ACC_PCSCT_1H, RATE_OC_1H, ACC_C_CCT_1H FROM w")
    _put(f"hop_1h_joined{suffix}", lambda a, r, x: _one(a, r, slide), _windows({"1H": 3600}, slide) + f" SELECT BUSINESS_TYPE_CD, w_end, {', '.join(n + '_1H' for n in monitor.WINDOWED)} FROM w")
    _put(f"multi_hop{suffix}", lambda a, r, x: monitor.apply_windows(a, slide, _SIZES), _windows(_SIZES, slide) + " SELECT BUSINESS_TYPE_CD, w_end, APP_C_CT_1H AS n_1H, APP_C_CT_2H AS n_2H, APP_C_CT_6H AS n_6H FROM ha")
    _put(f"product_monitor_windowed{suffix}", lambda a, r, x: monitor.windowed(a, r, slide, _SIZES), _windows(_SIZES, slide) + f" SELECT BUSINESS_TYPE_CD, w_end, {_W} FROM w")
    _put(f"multi_hop_joined{suffix}", lambda a, r, x: monitor.windowed(a, r, slide, _SIZES).select(KEY, "w_end", "PR_CT_1H", "PR_CT_2H", "PR_CT_6H"), _windows(_SIZES, slide) + " SELECT BUSINESS_TYPE_CD, w_end, PR_CT_1H, PR_CT_2H, PR_CT_6H FROM w")
    pm = f"SELECT BUSINESS_TYPE_CD, CASE WHEN BUSINESS_TYPE_CD = 'P0' THEN 'product zero' END AS BUSINESS_TYPE_NAME, es AS DT, seq, {_T}, {_W} FROM ue JOIN w USING (BUSINESS_TYPE_CD)"
    _put(f"product_monitor{suffix}", lambda a, r, x: monitor.product_monitor(a, r, slide), _windows(_SIZES, slide) + _EVENTS + f" {pm} WHERE w_end = es // {slide} * {slide} + {slide}")
    _put(f"product_monitor_exact{suffix}", lambda a, r, x: monitor.product_monitor(a.where(f"{KEY} = 'P3'"), r.where(f"{KEY} = 'P3'"), slide, "previous"), _windows(_SIZES, slide) + _EVENTS + f" {pm} WHERE w_end = es // {slide} * {slide} AND BUSINESS_TYPE_CD = 'P3'")
    nxt = f" SELECT BUSINESS_TYPE_CD, es, seq, APP_C_CT, APP_C_CT_1H FROM ue JOIN w USING (BUSINESS_TYPE_CD) WHERE w_end = es // {slide} * {slide}"
    for which, add in (("next", f" + {slide}"), ("previous", "")):
        _put(f"running_with_{'prev' if which == 'previous' else which}_hop{suffix}", lambda a, r, x, which=which: joins.align_running(monitor.running_events(a, r), _one(a, r, slide), KEY, slide, which).select(KEY, _secs().alias("es"), "seq", "APP_C_CT", "APP_C_CT_1H"), _windows({"1H": 3600}, slide) + _EVENTS + nxt + add)
    _put(f"running_vs_hop_range{suffix}", lambda a, r, x: joins.join_range(_run(a, r).withColumn("ts", F.expr("ts div 1000")), _one(a, r, slide), KEY, 22, 3601).select(KEY, "ts", "w_end", "APP_C_CT", "APP_C_CT_1H"),
         _RUNNING + _windows({"1H": 3600}, slide) + " SELECT BUSINESS_TYPE_CD, ts // 1000 AS ts, w_end, APP_C_CT, APP_C_CT_1H FROM ra JOIN rr USING (BUSINESS_TYPE_CD) JOIN w USING (BUSINESS_TYPE_CD) WHERE ts // 1000 BETWEEN w_end - 22 AND w_end + 3601")
    _put(f"running_vs_hop_key{suffix}", lambda a, r, x: _run(a, r).join(_one(a, r, slide), KEY).select(KEY, "w_end", "APP_C_CT", "APP_C_CT_1H"), _RUNNING + _windows({"1H": 3600}, slide) + " SELECT BUSINESS_TYPE_CD, w_end, APP_C_CT, APP_C_CT_1H FROM ra JOIN rr USING (BUSINESS_TYPE_CD) JOIN w USING (BUSINESS_TYPE_CD)")
    _put(f"two_stream_demo{suffix}", lambda a, r, x: monitor.two_stream_demo(a, r, slide), _windows({"1H": 3600}, slide) + _EVENTS + f" SELECT BUSINESS_TYPE_CD, es AS DT, seq, APP_C_CT, ACC_C_CT, APP_C_CT_1H, ACC_C_CT_1H FROM ue JOIN w USING (BUSINESS_TYPE_CD) WHERE w_end = es // {slide} * {slide}")
    top = ", ".join(f"round({f}({c}) FILTER (w_end <= pane + {z}), 6) AS {n}_{s}" for n, f, c in (("most", "max", "CREDIT_SCORE_1"), ("least", "min", "CREDIT_LIMIT")) for s, z in _SIZES.items())
    _put(f"hop_result_extremes{suffix}", lambda a, r, x: _rounded(aggregates.hop(r, [KEY], slide, _SIZES, {}, maxes={"most": F.col("CREDIT_SCORE_1")}, mins={"least": F.col("CREDIT_LIMIT")})),
         f""", {_dealt("r", "dr", 21600, slide)} SELECT BUSINESS_TYPE_CD, w_end, {", ".join(f"count(*) FILTER (w_end <= pane + {z}) AS n_{s}" for s, z in _SIZES.items())}, {top} FROM dr GROUP BY 1, 2""")
    rank = lambda t, b, c: f"round(CASE WHEN apply_num = 0 OR {b} <= 0 OR {c} <= 0 THEN -999.0 ELSE (success_num / apply_num) / ({b} / {c}) END, 6) AS {t}"
    _put(f"period_over_period{suffix}", lambda a, r, x: monitor.period_over_period(a, r, slide),
         _pop(slide) + f" SELECT BUSINESS_TYPE_CD AS P_ID, w_end AS DT, w_end % 86400 // 3600 AS CH, apply_num AS APP_C_PH, return_num AS R_C_PH, success_num AS ACC_C_PH, {_rate('apply_num', 'last_num', 'APP_P_H')}, {_rate('apply_num', 'last_24_num', 'APP_P_D')}, {_rate('success_num', 'apply_num', 'PR')}, {rank('PR_P_H', 'r_last', 'last_num')}, {rank('PR_P_D', 'r_last_24', 'last_24_num')}, {', '.join(f'round({n}, 6) AS {n}' for n in monitor.AVERAGES)} FROM la JOIN lr USING (BUSINESS_TYPE_CD, w_end)")
    _put(f"lag_previous{suffix}", lambda a, r, x: monitor.hop_apply_series(a, slide, 3600, 86_400 // slide).select(KEY, "w_end", "last_num"), _pop(slide) + " SELECT BUSINESS_TYPE_CD, w_end, last_num FROM la")
    _put(f"lag_day{suffix}", lambda a, r, x: monitor.hop_apply_series(a, slide, 3600, 86_400 // slide).select(KEY, "w_end", "last_24_num"), _pop(slide) + " SELECT BUSINESS_TYPE_CD, w_end, last_24_num FROM la")


_sliding(SLIDE, "")
_sliding(REFERENCE_SLIDE, "_10s")
_put("lag_fill_first", lambda a, r, x: over.lag_dealt(r, [KEY], ["seq"], "CREDIT_SCORE_1", 3, name="before").select("seq", F.round("before", 6).alias("before")),
     " SELECT seq, round(CASE WHEN row_number() OVER q <= 3 THEN first(CREDIT_SCORE_1) OVER q ELSE lag(CREDIT_SCORE_1, 3) OVER q END, 6) AS before FROM r WINDOW q AS (PARTITION BY BUSINESS_TYPE_CD ORDER BY es, seq)")
_put("lag_types", lambda a, r, x: over.lag_dealt(over.lag_dealt(r.withColumn("d", F.col("APPLY_SCORE").cast("decimal(20,6)")), [KEY], ["seq"], "d", 1, 0, "ld"), [KEY], ["seq"], "CREDIT_CODE", 2, "-", "lc").select("seq", F.col("ld").cast("double").alias("ld"), "lc"),
     " SELECT seq, coalesce(lag(APPLY_SCORE, 1) OVER q, 0)::DOUBLE AS ld, coalesce(lag(CASE WHEN ok THEN '0' ELSE '1' END, 2) OVER q, '-') AS lc FROM r WINDOW q AS (PARTITION BY BUSINESS_TYPE_CD ORDER BY es, seq)")
_put("cumulative_over", lambda a, r, x: aggregates.cumulative(r, [KEY], ["seq"], {"n": F.lit(1).cast("long"), "s": F.col("APPLY_SCORE").cast("long")}, {"m": F.col("APPLY_SCORE")}).select("seq", "n", "s", "m"),
     " SELECT seq, count(*) OVER q AS n, (sum(APPLY_SCORE) OVER q)::BIGINT AS s, max(APPLY_SCORE) OVER q AS m FROM r WINDOW q AS (PARTITION BY BUSINESS_TYPE_CD ORDER BY es, seq ROWS UNBOUNDED PRECEDING)")
_put("latest_per_bucket", lambda a, r, x: over.latest_per(a.withColumn("b", F.floor(_secs() / SLIDE)), [KEY, "b"], ["et", "seq"]).select(KEY, "b", "seq"), f" SELECT BUSINESS_TYPE_CD, es // {SLIDE} AS b, seq FROM a QUALIFY row_number() OVER (PARTITION BY BUSINESS_TYPE_CD, es // {SLIDE} ORDER BY es DESC, seq DESC) = 1")
_LABEL = "strftime(make_timestamp(es * 1000000), '%Y-%m-%d %H:%M:%S')[:18] || '0'"
_put("bucket_snapshot", lambda a, r, x: aggregates.bucket_max(monitor.running_events(a, r), [KEY], bucket_label(F.col("et")), ["APP_C_CT", "ACC_C_CT"]), _EVENTS + f" SELECT BUSINESS_TYPE_CD, {_LABEL} AS time_str, max(APP_C_CT) AS APP_C_CT, max(ACC_C_CT) AS ACC_C_CT FROM ue GROUP BY 1, 2")
def _bucketed(df: DataFrame, **sums) -> DataFrame:
    run = aggregates.cumulative(df, [KEY], ["seq"], {n: c.cast("long") for n, c in sums.items()})
    return aggregates.bucket_max(run, [KEY], bucket_label(F.col("et")), ["et", *sums])


_put("bucket_join", lambda a, r, x: joins.join_bucket(_bucketed(r, ACC_C_CT=F.when(_ok(), 1).otherwise(0)), _bucketed(a, APP_C_CT=F.lit(1)), [KEY]).select(KEY, "time_str", _secs().alias("es"), "ACC_C_CT", "APP_C_CT"),
     f""" SELECT p.BUSINESS_TYPE_CD, p.time_str, p.es, ACC_C_CT, APP_C_CT FROM
     (SELECT BUSINESS_TYPE_CD, {_LABEL} AS time_str, max(es) AS es, max(n)::BIGINT AS ACC_C_CT FROM (SELECT *, sum(ok::INT) OVER (PARTITION BY BUSINESS_TYPE_CD ORDER BY es, seq ROWS UNBOUNDED PRECEDING) AS n FROM r) GROUP BY 1, 2) p
     JOIN (SELECT BUSINESS_TYPE_CD, {_LABEL} AS time_str, max(es) AS es, max(n) AS APP_C_CT FROM (SELECT *, count(*) OVER (PARTITION BY BUSINESS_TYPE_CD ORDER BY es, seq ROWS UNBOUNDED PRECEDING) AS n FROM a) GROUP BY 1, 2) q
     ON p.BUSINESS_TYPE_CD = q.BUSINESS_TYPE_CD AND p.time_str = q.time_str AND abs(p.es - q.es) <= 2""")
_put("band_join", lambda a, r, x: joins.join_band(r.select(KEY, "CUST_ID", "seq", "et"), a.select(KEY, "CUST_ID", F.col("seq").alias("apply"), "et"), [KEY, "CUST_ID"], 1800, 300).select(KEY, "CUST_ID", "seq", "r_apply", (_secs() - F.unix_seconds("r_et")).alias("lag")),
     " SELECT r.BUSINESS_TYPE_CD, r.CUST_ID, r.seq, a.seq AS r_apply, r.es - a.es AS lag FROM r JOIN a USING (BUSINESS_TYPE_CD, CUST_ID) WHERE a.es BETWEEN r.es - 1800 AND r.es + 300")
def _joined_back(x: DataFrame) -> DataFrame:
    view = over.trailing(x, ["COMP_NAME", "STANDARD_ADDR"], {"d7": 7}, {"n": F.lit(1)}).select("APPLY_TIME", "COMP_NAME", "STANDARD_ADDR", "et", "d7_n")
    return joins.join_band(x, view, ["APPLY_TIME", "COMP_NAME", "STANDARD_ADDR"], 2, 2).select("APP_NO", F.col("r_d7_n").alias("n"))


_put("velocity_joined_back", lambda a, r, x: _joined_back(x), f""", v AS (SELECT es, COMP_NAME, STANDARD_ADDR, count(*) OVER (PARTITION BY COMP_NAME, STANDARD_ADDR ORDER BY es RANGE BETWEEN {7 * 86400} PRECEDING AND CURRENT ROW) AS n FROM l)
     SELECT l.APP_NO, v.n FROM l JOIN v ON l.es = v.es AND l.COMP_NAME = v.COMP_NAME AND l.STANDARD_ADDR = v.STANDARD_ADDR""")
_put("union_ids", lambda a, r, x: over.union_ids(x, "CERT_NO", "SPOUSE_CERT_NO").select("APP_NO", "id", "flag"), " SELECT APP_NO, CERT_NO AS id, 'fake' AS flag FROM l UNION ALL SELECT APP_NO, SPOUSE_CERT_NO, 'real' FROM l")
_put("contact_velocity", lambda a, r, x: over.contact_counts(x, "CERT_NO", "SPOUSE_CERT_NO", {"n7": 7}).select("APP_NO", "n7"), f" SELECT APP_NO, (SELECT count(*) FROM l y WHERE y.SPOUSE_CERT_NO = l.CERT_NO AND y.es BETWEEN l.es - {7 * 86400} AND l.es) AS n7 FROM l")
_RANGE = "(PARTITION BY {} ORDER BY es RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)"
for _n, _k in {"cert": ["CERT_NO"], "mobile": ["MOBILE_NUM"], "cert_mobile": ["CERT_NO", "MOBILE_NUM"], "company": ["COMP_NAME"], "address": ["STANDARD_ADDR"]}.items():
    _put(f"velocity_{_n}", lambda a, r, x, k=_k: over.trailing(x, k, {"d7": 7}, {"n": F.lit(1)}).select("APP_NO", F.col("d7_n").alias("n")), f" SELECT APP_NO, count(*) OVER {_RANGE.format(', '.join(_k))} AS n FROM l")
_put("velocity_conditional", lambda a, r, x: over.trailing(x, ["CERT_NO"], {"d7": 7}, {"n": F.when(F.col("CERT_TYPE") == "1", 1), "m": F.when(F.col("APP_NO").isNotNull(), 1)}).select("APP_NO", F.col("d7_n").alias("n"), F.col("d7_m").alias("m")),
     f" SELECT APP_NO, (sum(CASE WHEN CERT_TYPE = '1' THEN 1 ELSE 0 END) OVER {_RANGE.format('CERT_NO')})::BIGINT AS n, count(APP_NO) OVER {_RANGE.format('CERT_NO')} AS m FROM l")
_put("velocity_distinct", lambda a, r, x: over.trailing(x, ["COMP_NAME", "STANDARD_ADDR"], {"d1": 1}, distinct={"n": "SPOUSE_CERT_NO"}).select("APP_NO", F.col("d1_n").alias("n")), " SELECT APP_NO, count(DISTINCT SPOUSE_CERT_NO) OVER (PARTITION BY COMP_NAME, STANDARD_ADDR ORDER BY es RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n FROM l")
_ALL["velocity_features"] = (lambda a, r, x: over.velocity_features(x), _velocity((1, 3, 7)))
_ALL["velocity_features_7d"] = (lambda a, r, x: over.velocity_features(x, (7,)), _velocity((7,)))


def _bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(credit.applies(spark, sf_dir), credit.results(spark, sf_dir), credit.loans(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(query) for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items()}

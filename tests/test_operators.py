"""Traps of the domain, the fixture of ten applications, windows against the built-in ones."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.functions.scalars import approved, avg_if, bucket_label, distinct_if, ratio, row_time, to_time, upper
from tidewatch.operators.aggregates import cumulative, hop
from tidewatch.operators.joins import join_band
from tidewatch.operators.over import contact_counts, lag_dealt, lag_rows, latest_per, trailing, velocity_features
from tidewatch.sources.credit import applies, with_event_time

SF = "/root/testdata/sf0.001"


def one(df):
    return df.first()[0]


def test_ratio(spark):
    df = spark.createDataFrame([(3, 4), (8, 4), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.75, 2.0, -999.0]
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), mode="integer")).collect()] == [0.0, 2.0, -999.0]


def test_code_that_is_no_number(spark):
    df = spark.createDataFrame([("0",), ("x",), (None,), ("1",)], "c string")
    assert [r[0] for r in df.select(approved(F.col("c"))).collect()] == [True, False, False, False]


def test_distinct_counts_null_once_and_average_of_none_is_nan(spark):
    df = spark.createDataFrame([("a", True), (None, True), (None, True), ("b", False)], "id string, ok boolean")
    assert one(df.agg(distinct_if(F.col("id"), F.col("ok")))) == 2
    assert math.isnan(one(df.agg(avg_if(F.lit(1.0), F.col("id") == "zzz"))))


def test_labels(spark):
    df = with_event_time(spark.createDataFrame([(1704103209999,)], "t long"), "t")
    assert df.select(bucket_label(F.col("et")), upper(F.lit("ab"))).first()[:] == ("2024-01-01 10:00:00", "AB")
    assert str(one(df.select(row_time(F.lit(1704103200))))) == "2024-01-01 09:59:59.999000"


def test_lag_default_replaces_null_and_first_value_fills(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "i long, v long").withColumn("k", F.lit(1))
    assert [r.x for r in lag_rows(df, ["k"], ["i"], "v", 1, 0, "x").orderBy("i").collect()] == [0, 5, 0]
    assert [r.x for r in lag_rows(df, ["k"], ["i"], "v", 1, name="x").orderBy("i").collect()] == [5, 5, None]


@pytest.mark.parametrize("slide,size", [(600, 3600), (1200, 7200)])
def test_hop_equals_window(spark, slide, size):
    df = applies(spark, SF).limit(80)
    want = df.groupBy(F.window("et", f"{size} seconds", f"{slide} seconds").alias("w"), "BUSINESS_TYPE_CD").count()
    want = {(r[0], r[1], r[2]) for r in want.select("BUSINESS_TYPE_CD", F.unix_seconds("w.end"), "count").collect()}
    got = hop(df, ["BUSINESS_TYPE_CD"], slide, {"H": size}, {})
    assert {(r.BUSINESS_TYPE_CD, r.w_end, r.n_H) for r in got.collect()} == want


def test_ten_applications(spark):
    rows = [
        ("123", "a", "321", "aaa", "a_b", 1), ("789", "b", "987", "bbb", "a_b", 2), ("123", "c", "321", "aaa", "a_c", 3), ("123", "d", "123", "bbb", "a_c", 4),
        ("321", "e", "123", "aaa", "a_b", 5), ("321", "e", "123", "aaa", "a_b", 5), ("987", "g", "123", "aaa", "a_b", 7), ("321", "a", "123", "bbb", "a_b", 8),
        ("256", "a", "444", "aaa", "a_b", 9), ("123", "dda", "123", "bbb", "a_c", 10),
    ]
    want = [(1, 0, 1, 1, 1, 1), (1, 0, 2, 1, 1, 2), (2, 0, 3, 1, 2, 1), (3, 1, 4, 2, 2, 2), (2, 2, 6, 1, 4, 4), (2, 2, 6, 1, 4, 4), (1, 1, 7, 1, 5, 5), (3, 2, 8, 1, 3, 6), (1, 0, 9, 1, 6, 7), (4, 6, 10, 2, 4, 3)]
    df = spark.createDataFrame(rows, "CERT_NO string, APP_NO string, SPOUSE_CERT_NO string, COMP_NAME string, STANDARD_ADDR string, APPLY_TIME long")
    df = with_event_time(df.withColumns({"MOBILE_NUM": F.lit("aaa"), "SPOUSE_MOBILE_NO": F.lit(None).cast("string")}), "APPLY_TIME", "s")
    got = velocity_features(df, (7,)).select(*[f"seven_days_{n}" for n in ("cert_apply_num", "cert_contact_num", "cert_or_mobile_num", "cert_couple_num", "company_apply_num", "address_apply_num")])
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame([(None, "a", "m", "c", "d", "x", "y", 1)], "CERT_NO string, APP_NO string, MOBILE_NUM string, COMP_NAME string, STANDARD_ADDR string, SPOUSE_CERT_NO string, SPOUSE_MOBILE_NO string, APPLY_TIME long")
    df = with_event_time(df, "APPLY_TIME", "s")
    assert velocity_features(df).count() == 0 and velocity_features(df, drop_null_keys=False).count() == 1


def test_nobody_names_a_null_contact(spark):
    rows = [("1", "a", "m", "c", "d", None, None, 1), (None, "b", None, "c", "d", None, None, 2), ("2", "c", "m", "c", "d", "1", "m", 3)]
    df = spark.createDataFrame(rows, "CERT_NO string, APP_NO string, MOBILE_NUM string, COMP_NAME string, STANDARD_ADDR string, SPOUSE_CERT_NO string, SPOUSE_MOBILE_NO string, APPLY_TIME long")
    got = contact_counts(with_event_time(df, "APPLY_TIME", "s"), "CERT_NO", "SPOUSE_CERT_NO", {"n": 7})
    assert {(r.APP_NO, r.n) for r in got.collect()} == {("a", 0), ("b", 0), ("c", 0)}
    later = with_event_time(df.union(spark.createDataFrame([("1", "d", "m", "c", "d", None, None, 9)], df.schema)), "APPLY_TIME", "s")
    assert {(r.APP_NO, r.n) for r in contact_counts(later, "CERT_NO", "SPOUSE_CERT_NO", {"n": 7}).collect()} == {("a", 0), ("b", 0), ("c", 0), ("d", 1)}


def test_trailing_of_null_keys_times_and_fractions_equals_frames(spark):
    rows = [(k, None if k % 11 == 0 else f"k{k % 5}", None if k % 13 == 0 else (k * 7919) % 900_000, None if k % 7 == 0 else k / 3, None if k % 4 == 0 else str(k % 9)) for k in range(600)]
    df = spark.createDataFrame(rows + rows[:40], "seq long, k string, t long, v double, c string").withColumn("et", F.timestamp_seconds("t"))
    got = trailing(df, ["k"], {"a": 1, "b": 3}, {"n": F.lit(1), "v": F.col("v")}, {"c": "c"})
    assert got.count() == 640 and got.where("t is null and (a_n <> 0 or b_v <> 0 or b_c <> 0)").count() == 0
    for h, days in (("a", 1), ("b", 3)):
        w = Window.partitionBy("k").orderBy("t").rangeBetween(-days * 86_400, 0)
        want = df.where("t is not null").select("seq", F.count("*").over(w), F.round(F.coalesce(F.sum("v").over(w), F.lit(0.0)), 6), F.size(F.collect_set("c").over(w)))
        own = got.where("t is not null").select("seq", f"{h}_n", F.round(f"{h}_v", 6), f"{h}_c")
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, want.collect()))
    assert trailing(df.limit(0), ["k"], {"a": 1}, {"n": F.lit(1)}).count() == 0


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(20,6)", "string", "boolean"])
def test_lag_keeps_types(spark, kind):
    df = spark.createDataFrame([(1, "1"), (2, None), (3, "0")], "i long, v string").withColumns({"k": F.lit(1), "v": F.col("v").cast(kind)})
    out = lag_rows(df, ["k"], ["i"], "v", 1, "0", "x")
    assert out.schema["x"].dataType == df.schema["v"].dataType
    assert [str(r.s) for r in out.orderBy("i").select(F.col("x").cast("int" if kind != "string" else kind).cast("string").alias("s")).collect()] == ["0", "1", "0"]


def test_running_sums_over_hours_equal_one_frame(spark):
    df = applies(spark, SF).withColumn("v", F.when(F.col("seq") % 3 == 0, F.col("seq") % 11))
    one = Window.partitionBy("BUSINESS_TYPE_CD").orderBy("et", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("seq", F.sum("v").over(one).alias("s"), F.max("v").over(one).alias("m"))
    got = cumulative(df, ["BUSINESS_TYPE_CD"], ["seq"], {"s": F.col("v")}, {"m": F.col("v")}).select("seq", "s", "m")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_windows_of_null_fraction_and_repeated_values(spark):
    rows = [(k, "p" if k % 4 else None, (k * 37) % 5000, None if k % 7 == 0 else k / 3, str(k % 6)) for k in range(300)]
    df = spark.createDataFrame(rows, "seq long, k string, APPLY_TIME long, v double, c string")
    df = with_event_time(df.where("k is not null"), "APPLY_TIME", "s")
    got = hop(df, ["k"], 10, {"S": 60, "L": 1000}, {"v": F.col("v")}, {"c": F.col("c")})
    got = {(r.w_end, r.n_S, round(r.v_S, 9), r.c_S) for r in got.where("n_S > 0").collect()}
    w = df.groupBy(F.window("et", "60 seconds", "10 seconds").alias("w")).agg(F.count("*"), F.round(F.coalesce(F.sum("v"), F.lit(0.0)), 9), F.count_distinct("c"))
    assert got == {(int(r[0].end.timestamp()), *r[1:]) for r in w.collect()}
    assert hop(df.limit(0), ["k"], 10, {"S": 60}, {"v": F.col("v")}, {"c": F.col("c")}).count() == 0


def test_times_from_text(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00.1239",), ("x",), (None,)], "t string")
    assert [str(r[0]) for r in df.select(to_time(F.col("t"))).collect()] == ["2024-01-01 10:00:00.123000", "None", "None"]


def test_running_sums_keep_rows_without_key_or_time(spark):
    rows = [("a", 10, 1, 1), (None, 20, 2, 2), ("a", None, 3, 4), ("a", 5000, 4, None), (None, None, 5, 16), (None, None, 6, 32), ("a", 10, 7, 64)]
    df = spark.createDataFrame(rows, "k string, t long, seq long, v long").withColumn("et", F.timestamp_seconds("t"))
    one = Window.partitionBy("k").orderBy("et", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("seq", F.sum("v").over(one).alias("s"), F.max("v").over(one).alias("m"))
    got = cumulative(df, ["k"], ["seq"], {"s": F.col("v")}, {"m": F.col("v")}).select("seq", "s", "m")
    assert got.count() == 7 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert cumulative(df.limit(0), ["k"], ["seq"], {"s": F.col("v")}).count() == 0


def test_latest_of_each_key(spark):
    rows = [("a", 1, 1), ("a", 2, 0), ("a", 2, 5), (None, 3, 1), (None, None, 9), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, t int, seq int")
    assert sorted(map(tuple, latest_per(df, ["k"], ["t", "seq"]).collect()), key=str) == sorted([("a", 2, 5), (None, 3, 1), ("b", None, None)], key=str)


def test_names_of_products(spark):
    from tidewatch.plans import monitor
    from tidewatch.sources.credit import results

    names = spark.createDataFrame([("P0", "zero"), ("P0", "also zero"), ("P1", "one")], "BUSINESS_TYPE_CD string, BUSINESS_TYPE_NAME string")
    got = monitor.product_monitor(applies(spark, SF), results(spark, SF), 600, names=names)
    assert {tuple(r) for r in got.select("BUSINESS_TYPE_CD", "BUSINESS_TYPE_NAME").distinct().collect()} == {("P0", "also zero"), ("P1", "one"), ("P2", None), ("P3", None)}


def test_extremes_and_sketches_of_windows(spark):
    rows = [(k, "p" if k % 4 else None, (k * 37) % 5000, None if k % 7 == 0 else k / 3, str((k * 7919) % 1000)) for k in range(1500)]
    df = with_event_time(spark.createDataFrame(rows, "seq long, k string, APPLY_TIME long, v double, c string"), "APPLY_TIME", "s")
    sizes = {"S": 60, "M": 70, "L": 1000}
    got = hop(df, ["k"], 10, sizes, {"one": F.lit(1)}, {"c": F.col("c")}, {"top": F.col("v"), "last": F.col("c")}, {"low": F.col("v")}, {"many": F.col("c")})
    for s, size in sizes.items():
        w = df.groupBy(F.window("et", f"{size} seconds", "10 seconds").alias("w"), "k").agg(F.count("*"), F.max("v"), F.max("c"), F.min("v"), F.count_distinct("c"))
        want = {(r["k"], int(r["w"].end.timestamp())): tuple(r[2:]) for r in w.collect()}
        own = {(r["k"], r["w_end"]): (r[f"n_{s}"], r[f"top_{s}"], r[f"last_{s}"], r[f"low_{s}"], r[f"c_{s}"]) for r in got.where(f"n_{s} > 0").collect()}
        assert own == want
        assert got.where(f"abs(many_{s} - c_{s}) > greatest(1, 0.03 * c_{s})").count() == 0
    empty = got.where("n_S = 0 and (top_S is not null or many_S <> 0)")
    assert empty.count() == 0 and got.where("n_S = 0").count() > 0
    assert hop(df.limit(0), ["k"], 10, sizes, {}, maxes={"top": F.col("v")}, sketches={"many": F.col("c")}).count() == 0


@pytest.mark.parametrize("before,after", [(2, 2), (0, 0), (100, 7)])
def test_band_join_equals_all_pairs(spark, before, after):
    left = [(k, None if k % 9 == 0 else f"k{k % 2}", None if k % 10 == 0 else (k * 7919) % 900) for k in range(150)] + [(1, "k1", 919)] * 2
    right = [(k, None if k % 8 == 0 else f"k{k % 2}", None if k % 11 == 0 else (k * 6007) % 900) for k in range(200)]
    a, b = (with_event_time(spark.createDataFrame(x, "i long, k string, t long"), "t", "s") for x in (left, right))
    got = sorted((r.i, r.r_i, r.k) for r in join_band(a, b, ["k"], before, after).collect())
    assert got == sorted((i, j, k) for i, k, t in left for j, m, u in right if None not in (k, t, u) and k == m and t - before <= u <= t + after)
    plan = join_band(a, b, ["k"], before, after)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_back_multiplies_equal_applications(spark):
    rows = [("321", "d", 4), ("321", "e", 5), ("321", "e", 5), ("987", "g", 7)]
    df = with_event_time(spark.createDataFrame(rows, "CERT_NO string, APP_NO string, APPLY_TIME long"), "APPLY_TIME", "s")
    view = trailing(df, ["CERT_NO"], {"d7": 7}, {"n": F.lit(1)}).select("APPLY_TIME", "CERT_NO", "et", "d7_n")
    got = join_band(df, view, ["APPLY_TIME", "CERT_NO"], 2, 2)
    assert sorted((r.APP_NO, r.r_d7_n) for r in got.collect()) == [("d", 1), *[("e", 3)] * 4, ("g", 1)]


@pytest.mark.parametrize("n,default", [(1, None), (1, 0), (3, None), (8640, 0), (700, -1), (700, None)])
def test_dealt_lags_equal_one_frame(spark, n, default):
    rows = [(k, None if k % 6 == 0 else f"k{k % 2}", None if k % 97 == 0 else (k * 7919) % 40_000, None if k % 5 == 0 else k) for k in range(9000 if n > 1000 else 1500)]
    if n > 1000:
        rows = [(i, "one", t, v) for i, _, t, v in rows]
    df = with_event_time(spark.createDataFrame(rows, "seq long, k string, t long, v long"), "t", "s")
    want = lag_rows(df, ["k"], ["et", "seq"], "v", n, default, "x").select("seq", "x")
    got = lag_dealt(df, ["k"], ["seq"], "v", n, default, "x")
    assert got.columns == [*df.columns, "x"]
    assert sorted(map(str, got.select("seq", "x").collect())) == sorted(map(str, want.collect()))
    assert lag_dealt(df.limit(0), ["k"], ["seq"], "v", n, default).count() == 0


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(20,6)", "string", "boolean"])
def test_dealt_lag_keeps_types(spark, kind):
    df = spark.createDataFrame([(1, "1"), (2, None), (3, "0")], "i long, v string").withColumns({"k": F.lit(1), "v": F.col("v").cast(kind), "et": F.timestamp_seconds("i")})
    out = lag_dealt(df, ["k"], ["i"], "v", 1, "0", "x")
    assert out.schema["x"].dataType == df.schema["v"].dataType
    assert [str(r.s) for r in out.orderBy("i").select(F.col("x").cast("int" if kind != "string" else kind).cast("string").alias("s")).collect()] == ["0", "1", "0"]

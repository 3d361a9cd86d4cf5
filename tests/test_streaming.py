"""Streams over JSON folders give what the batch forms give on closed windows."""

from pyspark.sql import functions as F

from tidewatch.operators import aggregates, over
from tidewatch.plans import monitor
from tidewatch.sources import credit
from tidewatch.streaming import live

SF = "/root/testdata/sf0.001"


def topic(df, path):
    df.drop("et").repartition(1).write.json(str(path))
    return path + "/"


def drain(df, tmp, mode, name):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp}/c_{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_running_totals(spark, tmp_path):
    a, r = credit.applies(spark, SF), credit.results(spark, SF)
    sa = credit.read_topic(spark, topic(a, f"{tmp_path}/a"), a.drop("et").schema.simpleString()[7:-1].replace(":", " "), "APPLY_TIME")
    sr = credit.read_topic(spark, topic(r, f"{tmp_path}/r"), r.drop("et").schema.simpleString()[7:-1].replace(":", " "), "CREDIT_TIME")
    got = drain(live.running_product_rates(sa, sr), tmp_path, "update", "totals")
    last = over.latest_per(got, [monitor.KEY], [F.expr("APP_C_CT + ACC_C_CT")])
    want = monitor.running_product_rates(a, r)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, want.collect()))


def test_windows_and_their_join(spark, tmp_path):
    a, r = credit.applies(spark, SF), credit.results(spark, SF)
    streams = []
    for name, df, time in (("a", a, "APPLY_TIME"), ("r", r, "CREDIT_TIME")):
        rows = credit.read_topic(spark, topic(df, f"{tmp_path}/{name}"), df.drop("et").schema.simpleString()[7:-1].replace(":", " "), time)
        streams.append(live.hop(rows, [monitor.KEY], "10 minutes", "1 hour", {}).withColumnRenamed("n", f"n_{name}"))
    got = drain(live.join_hop(*streams, [monitor.KEY]), tmp_path, "append", "windows")
    got = {(x[0], x[1]): (x[2], x[3]) for x in got.select(monitor.KEY, F.unix_seconds("window.end"), "n_a", "n_r").collect()}
    both = [aggregates.hop(df, [monitor.KEY], 600, {"H": 3600}, {}) for df in (a, r)]
    want = {(x[0], x[1]): (x[2], x[3]) for x in both[0].join(both[1].withColumnRenamed("n_H", "m"), [monitor.KEY, "w_end"]).collect()}
    closed = max(e for _, e in got)
    assert len(got) > 50 and got == {k: v for k, v in want.items() if k[1] <= closed}


def test_trailing_counts(spark, tmp_path):
    x = credit.loans(spark, SF).where("APPLY_TIME < 1705000000")
    rows = credit.read_topic(spark, topic(x, f"{tmp_path}/x"), x.drop("et").schema.simpleString()[7:-1].replace(":", " "), "APPLY_TIME", "s", "0 seconds")
    counts = live.trailing_counts(rows, "CERT_NO", "APP_NO", 7 * 86400, F.when(F.col("CERT_TYPE") == "1", 1), "SPOUSE_MOBILE_NO")
    got = {(r.id, r.n, r.s, r.d) for r in drain(counts, tmp_path, "append", "trailing").collect()}
    batch = over.trailing(x, ["CERT_NO"], {"d7": 7}, {"n": F.lit(1), "s": F.when(F.col("CERT_TYPE") == "1", 1)}, {"d": "SPOUSE_MOBILE_NO"})
    want = {(r.APP_NO, r.d7_n, r.d7_s, r.d7_d) for r in batch.collect()}
    assert len(got) > 0.9 * len(want) and got <= want


def test_trailing_counts_of_several_batches_and_values(spark, tmp_path):
    rows = [(k, str(k % 2), 90_000 + (k * 613) % 9000, str(k % 5) if k % 3 else None) for k in range(300)]
    x = spark.createDataFrame(rows, "id long, k string, t long, v string")
    for lo in range(90_000, 99_000, 3000):  # three files in order of time, one for each batch
        x.where(f"t >= {lo} and t < {lo + 3000}").coalesce(1).write.mode("append").json(f"{tmp_path}/x")
    live_rows = credit.read_topic(spark, f"{tmp_path}/x/", "id long, k string, t long, v string", "t", "s", "0 seconds", reader_options={"maxFilesPerTrigger": 1})
    rows = drain(live.trailing_counts(live_rows, "k", "id", 1800, F.col("id"), "v"), tmp_path, "append", "parts").collect()
    want = {}
    for r in (own := x.collect()):
        frame = [y for y in own if y.k == r.k and r.t - 1800 <= y.t <= r.t]
        want[str(r.id)] = (len(frame), sum(y.id for y in frame), len({y.v for y in frame if y.v is not None}))
    assert len(rows) > 290 and not [(r, want[r.id]) for r in rows if want[r.id] != (r.n, r.s, r.d)]


def test_store(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), ("b", 3, "2024-01-01")], "k string, v int, t string").withColumn("t", F.to_timestamp("t"))
    live.kv_upsert(rows, f"{tmp_path}/store", "k", "v", "t", 3, 0)
    live.kv_upsert(rows, f"{tmp_path}/store", "k", "v", "t", 3, 0)
    store = spark.read.parquet(f"{tmp_path}/store")
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = live.kv_lookup(asked, store, "k", F.to_timestamp(F.lit("2024-01-04 12:00:00")))
    assert {r.k: r.value for r in got.collect()} == {"a": "2", "b": None, "c": None}
    for _ in range(2):  # done again, it is the same
        live.kv_compact(store, f"{tmp_path}/less", F.to_timestamp(F.lit("2024-01-04 12:00:00")))
    live.kv_upsert(rows.where("k = 'b'"), f"{tmp_path}/less", "k", "v", "t", 30, 1)
    less = spark.read.parquet(f"{tmp_path}/less")
    again = live.kv_lookup(asked, less, "k", F.to_timestamp(F.lit("2024-01-04 12:00:00")))
    assert less.count() == 2 and {r.k: r.value for r in again.collect()} == {"a": "2", "b": "3", "c": None}


def test_json_sink(spark, tmp_path):
    a = credit.applies(spark, SF).limit(20)
    rows = credit.read_topic(spark, topic(a, f"{tmp_path}/a"), "SESSION_ID string, APPLY_TIME bigint", "APPLY_TIME")
    for _ in range(2):  # started again from its checkpoint, it writes nothing twice
        credit.write_topic(rows, f"{tmp_path}/out", f"{tmp_path}/c", trigger={"availableNow": True}).awaitTermination()
    assert spark.read.json(f"{tmp_path}/out").count() == 20


def streams(spark, tmp_path):
    out = []
    for name, df, time in (("a", credit.applies(spark, SF), "APPLY_TIME"), ("r", credit.results(spark, SF), "CREDIT_TIME")):
        schema = df.drop("et").schema.simpleString()[7:-1].replace(":", " ")
        out.append(credit.read_topic(spark, topic(df, f"{tmp_path}/{name}"), schema, time, reader_options={"maxFilesPerTrigger": 1}))
    return out


def test_totals_after_each_event_are_staged_and_meet_the_next_window(spark, tmp_path):
    a, r = streams(spark, tmp_path)
    query, running = live.staged(live.running_events(a, r), f"{tmp_path}/staged/", f"{tmp_path}/c_staged", trigger={"availableNow": True})
    query.awaitTermination()
    batch = monitor.running_events(credit.applies(spark, SF), credit.results(spark, SF))
    want = {(x[0], x.es, x.seq, x.APP_C_CT, x.ACC_C_CT, x.PR_CT) for x in batch.withColumn("es", F.unix_seconds("et")).collect()}
    rows = spark.read.json(f"{tmp_path}/staged/").select(monitor.KEY, "ts", "seq", "APP_C_CT", "ACC_C_CT", "PR_CT").collect()
    got = {tuple(x) for x in rows}
    assert len(rows) == len(got) > 0.9 * len(want) and got <= want
    again, _ = live.staged(live.running_events(a, r), f"{tmp_path}/staged/", f"{tmp_path}/c_staged", trigger={"availableNow": True})
    again.awaitTermination()  # started again from its checkpoint, it writes nothing twice
    assert spark.read.json(f"{tmp_path}/staged/").count() == len(rows)
    closed = {(x[0], x.w_end): x.n_H for x in aggregates.hop(credit.applies(spark, SF), [monitor.KEY], 600, {"H": 3600}, {}).collect()}
    for which, add in (("next", 600), ("previous", 0)):
        windows = live.hop(streams(spark, tmp_path / which)[0], [monitor.KEY], "10 minutes", "1 hour", {})
        met = drain(live.align_running(running, windows, 600, which), tmp_path, "append", f"aligned_{which}").collect()
        paired = {(s, t // 600 * 600 + add, closed[k, t // 600 * 600 + add]) for k, t, s, *_ in got if (k, t // 600 * 600 + add) in closed}
        found = {(x.seq, x.w_end, x.n) for x in met}
        assert found <= paired and len(found) == len(met) > 0.9 * len(paired) > 100


def test_lags_by_rows(spark, tmp_path):
    r = streams(spark, tmp_path)[1]
    got = {tuple(x) for x in drain(live.row_lags(r, "APPLY_SCORE", (1, 40)), tmp_path, "append", "lags").select("seq", "lag_1", "lag_40").collect()}
    own = credit.results(spark, SF)
    for n in (1, 40):
        own = over.lag_rows(own, [monitor.KEY], ["et", "seq"], "APPLY_SCORE", n, 0, f"lag_{n}")
    want = {tuple(x) for x in own.select("seq", "lag_1", "lag_40").collect()}
    assert len(got) > 0.9 * len(want) and got <= want

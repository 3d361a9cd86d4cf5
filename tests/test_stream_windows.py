"""Windows of several sizes on streams equal the batch form on closed windows; restarts lose and double nothing."""

import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import aggregates
from tidewatch.operators.over import latest_per
from tidewatch.plans import monitor
from tidewatch.sources import credit
from tidewatch.streaming import live, windows

SF = "/root/testdata/sf0.001"
SCHEMA = "seq bigint, k string, t bigint, v double, c string"
SIZES = {"S": 60, "M": 200, "L": 1000}


def some_rows(n=400):
    return [(i, None if i % 17 == 0 else f"k{i % 2}", 90_000 + (i * 7919) % 3000, None if i % 7 == 0 else i / 3, None if i % 5 == 0 else str(i % 23)) for i in range(n)] + [(n, "k0", 99_000, 1.0, "x"), (n + 1, "k1", 99_500, 1.0, "x")]


def measures():
    return {"v": F.col("v"), "one": F.lit(1)}, {"c": aggregates.keyed(F.col("c"), F.col("seq") % 3 != 0), "d": F.col("c")}


def run(df, tmp_path, name):
    q = df.writeStream.format("json").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/c_{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).json(f"{tmp_path}/{name}")


@pytest.mark.parametrize("salts", [1, 3])
def test_all_sizes_in_one_row_equal_batch(spark, tmp_path, salts):
    rows = spark.createDataFrame(some_rows(), SCHEMA)
    sums, sets = measures()
    for part in range(5):  # out of order within the watermark's delay, a file for each batch
        lo, hi = 90_000 + 600 * part, 90_600 + 600 * part
        rows.where(f"(t >= {lo} and t < {hi}) or ({part} = 4 and t >= {hi})").orderBy(F.rand(part)).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = credit.read_topic(spark, f"{tmp_path}/in/", SCHEMA, "t", "s", "700 seconds")
        # started again from its checkpoint for each file
        got = run(windows.hop(stream, ["k"], 10, SIZES, sums, sets, F.col("c"), salts), tmp_path, "out")
    want = aggregates.hop(credit.with_event_time(rows, "t", "s"), ["k"], 10, SIZES, sums, sets)
    names = ["k", "w_end", *[f"{n}_{s}" for n in ("n", "one", "c", "d") for s in SIZES], *[F.round(f"v_{s}", 9) for s in SIZES]]
    closed = (99_500 - 700) // 10 * 10
    own = [tuple(r) for r in got.select(names).collect()]
    held = {tuple(r) for r in want.where(f"w_end <= {closed}").select(names).collect()}
    assert len(own) == len(set(own)) > 1000 and set(own) == held
    assert got.where("dt <> timestamp_millis(w_end * 1000 - 1)").count() == 0


def test_state_is_bounded_by_the_largest_size(spark, tmp_path):
    rows = [(i, "k0", 90_000 + i * 10, 1.0, str(i)) for i in range(500)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(f"{tmp_path}/in")
    stream = credit.read_topic(spark, f"{tmp_path}/in/", SCHEMA, "t", "s", "0 seconds")
    run(windows.hop(stream, ["k"], 10, SIZES, {}, {"c": F.col("c")}), tmp_path, "out")
    for name, most in (("panes", 101), ("last", 101)):
        state = spark.read.format("statestore").option("path", f"{tmp_path}/c_out").option("operatorId", 0).option("stateVarName", name).load()
        assert 0 < state.count() <= most
    now = spark.read.format("statestore").option("path", f"{tmp_path}/c_out").option("operatorId", 0).option("stateVarName", "now").load()
    assert len(json.loads(now.select("value.held").first()[0])["panes"]) <= 101


def topics(spark, tmp_path, parts):
    """Both streams as folders of several files, and their readers."""
    out = []
    for name, df, time in (("a", credit.applies(spark, SF), "APPLY_TIME"), ("r", credit.results(spark, SF), "CREDIT_TIME")):
        df = df.where("et < '2024-01-16'").drop("et")
        for k in range(parts):
            df.where(f"unix_seconds(timestamp_millis({time})) div 86400 % {parts} = {k}" if parts > 1 else "true").coalesce(1).write.mode("append").json(f"{tmp_path}/{name}")
        schema = df.schema.simpleString()[7:-1].replace(":", " ")
        out.append(credit.read_topic(spark, f"{tmp_path}/{name}/", schema, time))
    return out


def test_monitor_of_62_columns_as_three_queries(spark, tmp_path, monkeypatch):
    now, folder = {"availableNow": True}, f"{tmp_path}/job"
    a, r = topics(spark, tmp_path, 1)
    start = lambda part: live.monitor_job(a, r, folder, part, 600, trigger=now).awaitTermination()
    start("monitor")  # before there is anything to read
    start("windows")
    # the totals' query is killed between its two writes
    whole = credit.publish

    def killed(batch, topic, *more):
        if topic.endswith("/latest"):
            raise RuntimeError("killed")
        whole(batch, topic, *more)

    monkeypatch.setattr(credit, "publish", killed)
    with pytest.raises(Exception, match="killed"):
        start("totals")
    monkeypatch.setattr(credit, "publish", whole)
    for part in ("monitor", "totals", "monitor", "windows", "totals", "monitor"):
        start(part)
    batch = [df.where("et < '2024-01-16'") for df in (credit.applies(spark, SF), credit.results(spark, SF))]
    closed = min(df.agg(F.max(F.unix_seconds("et"))).first()[0] for df in batch) - 5
    want = monitor.product_monitor(*batch, 600).where(f"DT <= {closed} and (DT div 600 + 1) * 600 <= {closed}")
    assert len(want.columns) == 63
    got = spark.read.schema(want.schema).json(f"{folder}/monitor")
    own, held = sorted(map(tuple, got.collect()), key=str), sorted(map(tuple, want.collect()), key=str)
    assert own == held and len(held) > 50
    totals = spark.read.json(f"{folder}/totals")
    every = monitor.running_events(*batch).where(F.unix_seconds("et") <= closed)
    assert totals.count() == totals.select("seq").distinct().count() == every.count()
    last = latest_per(totals, ["BUSINESS_TYPE_CD"], ["ts", "seq"]).select("BUSINESS_TYPE_CD", "ts", "seq").collect()
    assert {tuple(x) for x in last} <= {tuple(x) for x in spark.read.json(f"{folder}/latest").select("BUSINESS_TYPE_CD", "ts", "seq").collect()}


def test_a_batch_is_published_once(spark, tmp_path, monkeypatch):
    df, topic = spark.range(50).withColumn("s", F.col("id").cast("string")), f"{tmp_path}/topic"
    moved = []
    fs = credit.hadoop_files

    class Stops:
        """A file system that fails after the second file has been moved."""

        def __init__(self, own):
            self.own = own

        def __getattr__(self, name):
            return getattr(self.own, name)

        def rename(self, *where):
            if len(moved) == 2:
                raise OSError("lost")
            moved.append(where)
            return self.own.rename(*where)

    monkeypatch.setattr(credit, "hadoop_files", lambda *x: (Stops(fs(*x)[0]), fs(*x)[1]))
    credit.make_topics(spark, topic)
    with pytest.raises(OSError):
        credit.publish(df, topic, 7)
    before = spark.read.json(topic).count()
    monkeypatch.setattr(credit, "hadoop_files", fs)
    credit.publish(df.repartition(9), topic, 7)
    credit.publish(df, topic, 7)
    assert 0 < before < 50 and spark.read.json(topic).count() == 50 and spark.read.json(topic).distinct().count() == 50


def test_rows_without_key_or_time_in_running_totals(spark, tmp_path):
    a, r = credit.applies(spark, SF).limit(60), credit.results(spark, SF).limit(60)
    streams = []
    for name, df, time in (("a", a, "APPLY_TIME"), ("r", r, "CREDIT_TIME")):
        df = df.drop("et").withColumn(time, F.when(F.col("seq") % 5 != 0, F.col(time))).withColumn("BUSINESS_TYPE_CD", F.when(F.col("seq") % 7 != 0, F.col("BUSINESS_TYPE_CD")))
        df.coalesce(1).write.json(f"{tmp_path}/{name}")
        streams.append((credit.read_topic(spark, f"{tmp_path}/{name}/", df.schema.simpleString()[7:-1].replace(":", " "), time, delay="0 seconds"), credit.with_event_time(spark.read.schema(df.schema).json(f"{tmp_path}/{name}"), time)))
    got = run(live.running_events(*[s for s, _ in streams]), tmp_path, "totals").select("BUSINESS_TYPE_CD", "ts", "seq", "APP_C_CT", "ACC_C_CT")
    closed = min(b.agg(F.max(F.unix_seconds("et"))).first()[0] for _, b in streams)
    want = monitor.running_events(*[b for _, b in streams]).select("BUSINESS_TYPE_CD", F.unix_seconds("et").alias("ts"), "seq", "APP_C_CT", "ACC_C_CT").where(f"ts is null or ts <= {closed}")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.where("ts is null").count() > 3 and want.where("BUSINESS_TYPE_CD is null").count() > 3


@pytest.mark.parametrize("slide,until,day", [(600, "2024-01-16", 144), (10, "2024-01-02 20:00:00", 700)])
def test_period_monitor(spark, tmp_path, slide, until, day):
    batch = [df.where(f"et < '{until}'") for df in (credit.applies(spark, SF), credit.results(spark, SF))]
    for k in range(2):  # started again for the later half
        streams = []
        for name, df, time in (("a", batch[0], "APPLY_TIME"), ("r", batch[1], "CREDIT_TIME")):
            middle = df.agg(F.expr("percentile_approx(unix_seconds(et), 0.5)")).first()[0] // 3600 * 3600
            df.where(f"(unix_seconds(et) >= {middle}) = {bool(k)}").drop("et").coalesce(1).write.mode("append").json(f"{tmp_path}/{name}")
            streams.append(credit.read_topic(spark, f"{tmp_path}/{name}/", df.drop("et").schema.simpleString()[7:-1].replace(":", " "), time, delay="30000 seconds"))
        got = run(live.period_over_period(*streams, slide, day=day), tmp_path, "period")
    closed = min(df.agg(F.max(F.unix_seconds("et"))).first()[0] for df in batch) - 30_000
    want = monitor.period_over_period(*batch, slide, day=day).where(f"DT <= {closed}")
    assert got.columns == want.columns and len(got.columns) == 18
    own, held = sorted(map(tuple, got.collect()), key=str), sorted(map(tuple, want.collect()), key=str)
    assert own == held and len(held) > 100 and want.where("APP_P_D not in (-999.0)").count() > 20

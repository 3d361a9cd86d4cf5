"""The versioned store, and totals beside windows on streams."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import aggregates, joins
from tidewatch.plans import monitor
from tidewatch.sources import credit
from tidewatch.streaming import live, store

SF = "/root/testdata/sf0.001"


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, t string").withColumn("t", F.to_timestamp("t"))


def values(df):
    return {r.k: r.v for r in df.collect()}


def test_versions_compaction_and_expiry(spark, tmp_path):
    path, day = f"{tmp_path}/store", lambda d: F.to_timestamp(F.lit(f"2024-01-{d:02d}"))
    assert store.read(spark, path, ["k"], "t") is None
    store.write(batch(spark, [("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), ("b", 3, "2024-01-01"), (None, 9, "2024-01-01")]), path, ["k"], "t", 0, days=5)
    store.write(batch(spark, [("a", 0, "2024-01-01"), ("c", 4, "2024-01-09")]), path, ["k"], "t", 1, days=5)
    for _ in range(2):  # a batch that is done again changes nothing
        store.write(batch(spark, [("b", 5, "2024-01-03")]), path, ["k"], "t", 2, days=5)
    assert store.manifest(spark, path)["version"] == 3
    now = {"a": 2, "b": 5, "c": 4, None: 9}
    assert values(store.read(spark, path, ["k"], "t")) == now and values(store.read(spark, path, ["k"], "t", 1)) == {"a": 2, "b": 3, None: 9}
    assert values(store.read(spark, path, ["k"], "t", as_of=day(8))) == {"c": 4}
    store.compact(spark, path, ["k"], "t", day(8))
    held = store.manifest(spark, path)
    assert (held["version"], held["through"], held["changes"]) == (4, 2, []) and held["snapshot"].startswith("snapshots/")
    assert values(store.read(spark, path, ["k"], "t")) == {"c": 4} and values(store.read(spark, path, ["k"], "t", 3)) == now
    store.write(batch(spark, [("b", 5, "2024-01-03")]), path, ["k"], "t", 2)  # in the snapshot
    store.write(batch(spark, [("d", 7, "2024-01-10")]), path, ["k"], "t", 3, days=5)
    assert values(store.read(spark, path, ["k"], "t")) == {"c": 4, "d": 7}
    store.vacuum(spark, path, keep=2)  # expired keys leave the disk, the versions kept can be read
    assert values(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)) == {"c": 4, "d": 7}
    assert values(store.read(spark, path, ["k"], "t", 4)) == {"c": 4} and values(store.read(spark, path, ["k"], "t")) == {"c": 4, "d": 7}


def test_readers_never_see_half_of_anything(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/store"
    store.write(batch(spark, [("a", 1, "2024-01-01")]), path, ["k"], "t", 0)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", fails)
        with pytest.raises(OSError):
            store.write(batch(spark, [("a", 2, "2024-01-02")]), path, ["k"], "t", 1)
        with pytest.raises(OSError):
            store.compact(spark, path, ["k"], "t")
    assert values(store.read(spark, path, ["k"], "t")) == {"a": 1}
    (tmp_path / "store/manifests/2").write_text('{"version": 2, "snap')  # a manifest that is being written
    assert values(store.read(spark, path, ["k"], "t")) == {"a": 1}
    store.write(batch(spark, [("a", 2, "2024-01-02")]), path, ["k"], "t", 1)
    assert values(store.read(spark, path, ["k"], "t")) == {"a": 2}


def test_lookup_reads_the_touched_buckets(spark, tmp_path):
    path = f"{tmp_path}/store"
    store.write(batch(spark, [(f"k{i}", i, "2024-01-01") for i in range(300)]), path, ["k"], "t", 0)
    asked = spark.createDataFrame([("k7", 1), ("k7", 2), ("none", 3), (None, 4)], "k string, i int")
    found = store.lookup(asked, path, ["k"], "t", ["v"])
    assert sorted((r.i, r.v) for r in found.collect() if r.v is not None) == [(1, 7), (2, 7)] and found.count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [__bucket" in plan.replace("isnotnull(__bucket#", "__bucket#") or "__bucket#" in plan[plan.index("PartitionFilters") :][:200]


def stream(spark, df, time, path):
    df.drop("et").coalesce(1).write.json(path)
    return credit.read_topic(spark, path + "/", df.drop("et").schema.simpleString()[7:-1].replace(":", " "), time)


@pytest.mark.parametrize("bound", [None, (22, 40 * 86_400)])
def test_totals_beside_windows(spark, tmp_path, bound):
    a, r = credit.applies(spark, SF), credit.results(spark, SF)
    sa, sr = stream(spark, a, "APPLY_TIME", f"{tmp_path}/a"), stream(spark, r, "CREDIT_TIME", f"{tmp_path}/r")
    now, path, topic = {"availableNow": True}, f"{tmp_path}/totals", f"{tmp_path}/out"
    live.keep_totals(live.running_product_rates(sa, sr), path, f"{tmp_path}/c1", now).awaitTermination()
    w = aggregates.hop(a, [monitor.KEY], 600, {"H": 3600}, {})
    w.coalesce(1).write.json(f"{tmp_path}/w")
    own = spark.readStream.schema(f"{monitor.KEY} string, w_end bigint, n_H bigint").json(f"{tmp_path}/w/")
    for k in range(2):  # a batch that was not recorded as done is done again, now with later totals: its rows are the same
        for done in tmp_path.glob("c2/commits/*") if k else []:
            done.unlink()
        for mark in tmp_path.glob("out/_batches/*") if k else []:
            mark.unlink()
        live.totals_beside(own, path, topic, f"{tmp_path}/c2", bound, now).awaitTermination()
        later = spark.createDataFrame([("P0", 1 << 45, 5)], f"{monitor.KEY} string, ts long, APP_C_CT long")
        columns = store.read(spark, path, [monitor.KEY], "ts", 1).drop("__until", "__written")
        store.write(columns.limit(0).unionByName(later, allowMissingColumns=True), path, [monitor.KEY], "ts", 99)
    assert store.pin(spark, path, topic, 0) < store.manifest(spark, path)["version"]
    totals = monitor.running_product_rates(a, r).withColumn("ts", F.expr("ts div 1000"))
    want = joins.join_range(totals, w, monitor.KEY, *bound) if bound else totals.join(w, monitor.KEY)
    names = [monitor.KEY, "ts", "w_end", "n_H", "APP_C_CT", "ACC_C_CT", "PR_CT"]
    got = spark.read.schema(want.schema).json(topic)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, want.select(names).collect())) and got.count() > 100


def test_guarded_totals(spark, tmp_path):
    a, r = credit.applies(spark, SF), credit.results(spark, SF).where(f"{monitor.KEY} <> 'P1' or et < '2024-01-20'")
    sa, sr = stream(spark, a, "APPLY_TIME", f"{tmp_path}/a"), stream(spark, r, "CREDIT_TIME", f"{tmp_path}/r")
    q = live.running_guarded(sa, sr, 86_400).writeStream.format("memory").queryName("guarded").outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    both = joins.join_running(monitor.running_applies(a).withColumn("a_et", F.timestamp_millis("ts")), monitor.running_results(r).withColumn("r_et", F.timestamp_millis("r_ts")), monitor.KEY, ("a_et", "r_et", 86_400))
    want = {tuple(x) for x in both.select(monitor.KEY, "ts", "r_ts", "APP_C_CT", "ACC_C_CT").collect()}
    assert {tuple(x) for x in spark.table("guarded").collect()} == want and 0 < len(want) < 4

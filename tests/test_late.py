"""Late rows are counted, and the slowest source holds the common watermark back."""

import time

from pyspark.sql import functions as F

from tidewatch.sources import credit
from tidewatch.streaming import late, live, windows

SCHEMA = "k string, t bigint"


def put(spark, path, times):
    spark.createDataFrame([("a", t) for t in times], SCHEMA).coalesce(1).write.mode("append").json(path)


def run(df, tmp_path, name):
    q = df.writeStream.format("json").queryName(name).option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/c_{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).json(f"{tmp_path}/{name}")


def test_late_rows_are_counted(spark, tmp_path):
    listener = late.LateRows(spark, f"{tmp_path}/late")
    spark.streams.addListener(listener)
    try:
        for times in ([1000, 1010, 2000], [1500, 1600, 1996, 2100], [5, 3000]):  # 1500 and 1600 lie behind 2000 - 5, and 5 behind 2100 - 5
            put(spark, f"{tmp_path}/in", times)
            stream = credit.read_topic(spark, f"{tmp_path}/in/", SCHEMA, "t", "s", "5 seconds")
            got = run(windows.hop(stream, ["k"], 10, {"S": 10}, {}), tmp_path, "panes")
        waited = time.time()
        while listener.total("panes") < 3 and time.time() - waited < 20:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = got.agg(F.sum("n_S")).first()[0]
    assert listener.total("panes") == 3 and rows == 5  # of nine rows three were late and one is still waiting
    written = spark.read.json(f"{tmp_path}/late")
    assert written.agg(F.sum("late")).first()[0] == 3 and written.where("watermark is null").count() == 0


def test_an_idle_source_holds_the_windows_back(spark, tmp_path):
    put(spark, f"{tmp_path}/a", range(1000, 5000, 100))
    put(spark, f"{tmp_path}/b", [1000])
    a, b = (credit.read_topic(spark, f"{tmp_path}/{n}/", SCHEMA, "t", "s", "5 seconds") for n in "ab")
    both = live.join_hop(*[live.hop(x, ["k"], "100 seconds", "200 seconds", {}).withColumnRenamed("n", n) for x, n in ((a, "n_a"), (b, "n_b"))], ["k"])
    assert run(both, tmp_path, "joined").count() == 0  # b may still bring rows of 1000
    put(spark, f"{tmp_path}/b", [4000])
    put(spark, f"{tmp_path}/a", [4950])  # a query that starts again knows the common watermark only, so both have to go on
    a, b = (credit.read_topic(spark, f"{tmp_path}/{n}/", SCHEMA, "t", "s", "5 seconds") for n in "ab")
    both = live.join_hop(*[live.hop(x, ["k"], "100 seconds", "200 seconds", {}).withColumnRenamed("n", n) for x, n in ((a, "n_a"), (b, "n_b"))], ["k"])
    got = {tuple(r) for r in run(both, tmp_path, "joined").select(F.unix_seconds("window.end"), "n_a", "n_b").collect()}
    assert got == {(1100, 1, 1), (1200, 2, 1)}

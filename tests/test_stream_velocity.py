"""Velocity features on streams equal the batch form on what the watermark has passed."""

from pyspark.sql import functions as F

from tidewatch.operators import over
from tidewatch.sources import credit
from tidewatch.streaming import velocity

SF = "/root/testdata/sf0.001"


def run(df, tmp_path):
    q = df.writeStream.format("json").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).json(f"{tmp_path}/out")


def test_features_equal_batch_over_restarts(spark, tmp_path):
    own = credit.loans(spark, SF).where("et < '2024-01-13'").drop("et", "seq")
    own = own.withColumn("COMP_NAME", F.when(F.col("APP_NO") % 31 != 0, F.col("COMP_NAME"))).withColumn("SPOUSE_CERT_NO", F.when(F.col("APP_NO") % 5 != 0, F.col("SPOUSE_CERT_NO")))
    own = own.union(own.where("APP_NO % 40 = 1")).union(own.where("APP_NO % 40 = 2").withColumn("APP_NO", F.concat("APP_NO", F.lit("x"))))
    cuts = [0, 1704300000, 1704600000, 1705000000, 1 << 40]
    schema = own.schema.simpleString()[7:-1].replace(":", " ")
    for lo, hi in zip(cuts, cuts[1:], strict=False):  # a file and a start from the checkpoint for each; within a file in any order
        own.where(f"APPLY_TIME >= {lo} and APPLY_TIME < {hi}").orderBy(F.rand(3)).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        got = run(velocity.velocity_features(credit.read_topic(spark, f"{tmp_path}/in/", schema, "APPLY_TIME", "s", "0 seconds")), tmp_path)
    want = over.velocity_features(credit.with_event_time(own, "APPLY_TIME", "s"))
    assert len(got.columns) == 26 and got.columns == want.columns
    got, want = sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))
    assert got == want and len(got) > 350


def test_ten_applications_and_state_that_expires(spark, tmp_path):
    rows = [
        ("123", "a", "321", "aaa", "a_b", 1), ("789", "b", "987", "bbb", "a_b", 2), ("123", "c", "321", "aaa", "a_c", 3), ("123", "d", "123", "bbb", "a_c", 4),
        ("321", "e", "123", "aaa", "a_b", 5), ("321", "e", "123", "aaa", "a_b", 5), ("987", "g", "123", "aaa", "a_b", 7), ("321", "a", "123", "bbb", "a_b", 8),
        ("256", "a", "444", "aaa", "a_b", 9), ("123", "dda", "123", "bbb", "a_c", 10),
    ]
    schema = "CERT_NO string, APP_NO string, SPOUSE_CERT_NO string, COMP_NAME string, STANDARD_ADDR string, APPLY_TIME long"
    more = {"MOBILE_NUM": F.lit("aaa"), "SPOUSE_MOBILE_NO": F.lit(None).cast("string")}
    df = spark.createDataFrame(rows, schema).withColumns(more)
    df.coalesce(1).write.json(f"{tmp_path}/in")
    wide = df.schema.simpleString()[7:-1].replace(":", " ")
    stream = lambda: velocity.velocity_features(credit.read_topic(spark, f"{tmp_path}/in/", wide, "APPLY_TIME", "s", "0 seconds"))
    got = run(stream(), tmp_path)
    want = over.velocity_features(credit.with_event_time(df, "APPLY_TIME", "s"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 10
    # long after the longest horizon nothing of them is left
    for t in (10 * 86_400, 20 * 86_400):
        spark.createDataFrame([("x", "late", None, "other", "else", t)], schema).withColumns({"MOBILE_NUM": F.lit("y"), "SPOUSE_MOBILE_NO": F.lit(None).cast("string")}).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        run(stream(), tmp_path)
    for name in ("entered", "last", "now", "waiting"):
        state = spark.read.format("statestore").option("path", f"{tmp_path}/c").option("operatorId", 1).option("stateVarName", name).load()
        assert state.where("key.a not in ('x', 'y', 'other', 'else')").count() == 0, name

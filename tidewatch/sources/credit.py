"""Streams of credit applications and results: schemas, topics, and the same columns from an events table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

APPLY_SCHEMA = "SESSION_ID string, APP_NO string, CUST_ID string, BUSINESS_TYPE_CD string, BUSINESS_TYPE_NAME string, CUST_SOURCE string, CHANNEL_SOURCE string, APPLY_TIME bigint"
RESULT_SCHEMA = (
    "SESSION_ID string, APP_NO string, CUST_ID string, CREDIT_NO string, BUSINESS_TYPE_CD string, STATE_CODE string, CREDIT_CODE string, REFUSE_REASON string, "
    "INTEREST_RATE double, CREDIT_LIMIT double, REPAY_MODE_CD string, LOAN_TERM int, CREDIT_SCORE_1 double, CREDIT_SCORE_2 double, CREDIT_SCORE_3 double, "
    "ANTI_FRAUD_SCORE_1 double, ANTI_FRAUD_SCORE_2 double, WHITE_LIST int, BLACK_LIST int, APPLY_SCORE int, CREDIT_TIME bigint"
)


def with_event_time(df: DataFrame, column: str, unit: str = "ms", delay: str | None = None) -> DataFrame:
    """Add `et`, whole seconds, from an epoch column in `ms` or `s`; with `delay`, a watermark."""
    df = df.withColumn("et", F.timestamp_seconds(F.expr(f"{column} div 1000") if unit == "ms" else F.col(column)))
    return df.withWatermark("et", delay) if delay else df


def reading(topic: str, start: str | dict = "latest", options: dict | None = None, reader_options: dict | None = None) -> dict[str, str]:
    """The options of a Kafka reader: properties get their prefix unless they have it; offsets by partition go in as JSON."""
    offsets = json.dumps({topic: start}) if isinstance(start, dict) else start
    return {"subscribe": topic, "startingOffsets": offsets} | (reader_options or {}) | prefixed(options)


def prefixed(options: dict | None) -> dict[str, str]:
    return {k if k.startswith("kafka.") else f"kafka.{k}": v for k, v in (options or {}).items()}


def topic_rows(df: DataFrame, key: str | Column | None = None, partition: str | Column | None = None) -> DataFrame:
    """What a Kafka sink gets: the row as JSON in `value`, and a key (rows of one key go to one partition) or the number of a partition, each a column or an expression.

    Without either, rows are dealt out in turn.
    """
    named = [F.col(c) if isinstance(c, str) else c for c in (key, partition) if c is not None]
    names = [n for n, c in (("key", key), ("partition", partition)) if c is not None]
    return df.select(F.to_json(F.struct("*")).alias("value"), *[c.cast("string" if n == "key" else "int").alias(n) for n, c in zip(names, named, strict=True)])


def read_topic(spark: SparkSession, topic: str, schema: str, column: str, unit: str = "ms", delay: str = "5 seconds", start: str | dict = "latest", options: dict | None = None, reader_options: dict | None = None) -> DataFrame:
    """A stream of JSON rows from a topic, or from a folder of JSON files if `topic` holds a slash.

    `options` go to Kafka with their prefix added, `reader_options` (such as maxOffsetsPerTrigger, failOnDataLoss, maxFilesPerTrigger) to Spark's reader
    as they are. `start`: earliest, latest, or offsets by partition, {"0": 23}. It holds for the first start; later ones go on from the checkpoint.
    """
    if "/" in topic:
        rows = spark.readStream.schema(schema).options(**(reader_options or {})).json(topic)
    else:
        reader = spark.readStream.format("kafka").options(**reading(topic, start, options, reader_options))
        rows = reader.load().select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")
    return with_event_time(rows, column, unit, delay)


def write_topic(df: DataFrame, topic: str, checkpoint: str, mode: str = "append", key: str | Column | None = None, partition: str | Column | None = None, trigger: dict | None = None, options: dict | None = None) -> StreamingQuery:
    """Write rows as JSON to a topic, or to a folder if `topic` holds a slash. `update` mode keeps additions and never sends deletions."""
    if "/" in topic:
        if mode == "append":
            writer = df.writeStream.format("json").option("path", topic)
        else:
            writer = df.writeStream.foreachBatch(lambda batch, number: batch.write.mode("overwrite").json(f"{topic}/batch={number}")).outputMode(mode)
    else:
        writer = topic_rows(df, key, partition).writeStream.format("kafka").option("topic", topic).options(**prefixed(options)).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def hadoop_files(spark: SparkSession, path: str):
    """The file system that a path lies in, and how to name places in it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def make_topics(spark: SparkSession, *topics: str) -> None:
    """Make the folders of topics, so that their readers may start before their writers."""
    for topic in topics:
        fs, place = hadoop_files(spark, topic)
        fs.mkdirs(place(topic))


def publish(batch: DataFrame, topic: str, number: int, files: int = 4) -> None:
    """Add the rows of a batch to a folder of JSON once, however often the batch is done.

    Rows are dealt to files by their values, files are moved in whole under names made of the batch's and the file's number, and a mark in `_batches`
    says that the batch is complete. A batch that was stopped anywhere is done again: files already in place hold the same rows and stay, so a
    stream that reads the folder has seen none of them twice.
    """
    fs, place = hadoop_files(batch.sparkSession, topic)
    mark = place(f"{topic}/_batches/{number}")
    if fs.exists(mark):
        return
    own = f"{topic}/_writing/{number}"
    batch.repartition(files, *batch.columns).write.mode("overwrite").json(own)
    for status in fs.listStatus(place(own)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            target = place(f"{topic}/batch-{number:010d}-{name[5:10]}.json")
            if not fs.exists(target):
                fs.rename(status.getPath(), target)
    fs.mkdirs(place(f"{topic}/_batches"))
    fs.create(mark, True).close()
    fs.delete(place(own), True)


def write_topics(df: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame] | None], checkpoint: str, mode: str = "append", files: int = 4, trigger: dict | None = None) -> StreamingQuery:
    """Write every batch of a stream to several folders of JSON, each row once in each: folder and what to make of the batch for it (None: as it is).

    The marks of `publish` tell which folders have a batch already, so a query that was killed between two of them goes on with the other.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        for topic, made in sinks.items():
            publish(made(batch) if made else batch, topic, number, files)
        batch.unpersist()

    make_topics(df.sparkSession, *sinks)
    return df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))


def applies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit applications of the events table."""
    e = _events(spark, sf_dir).where("event_type in ('view', 'click')")
    product = F.concat(F.lit("P"), (F.col("user_id") % 4).cast("string"))
    own = e.select(
        F.col("event_id").cast("string").alias("SESSION_ID"),
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("CUST_ID"),
        product.alias("BUSINESS_TYPE_CD"),
        F.concat(F.lit("name "), product).alias("BUSINESS_TYPE_NAME"),
        F.col("ms").alias("APPLY_TIME"),
    )
    return with_event_time(own, "APPLY_TIME")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit results of the events table."""
    e = _events(spark, sf_dir).where("event_type in ('purchase', 'signup', 'error')")
    own = e.select(
        F.col("event_id").cast("string").alias("SESSION_ID"),
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("CUST_ID"),
        F.concat(F.lit("P"), (F.col("user_id") % 4).cast("string")).alias("BUSINESS_TYPE_CD"),
        F.when(F.col("event_type") == "error", "1").otherwise("0").alias("CREDIT_CODE"),
        (F.col("value") / 100).alias("INTEREST_RATE"),
        F.col("value").alias("CREDIT_SCORE_1"),
        (F.col("value") / 2).alias("CREDIT_SCORE_2"),
        (F.col("value") + F.col("k")).alias("CREDIT_SCORE_3"),
        F.col("k").cast("double").alias("ANTI_FRAUD_SCORE_1"),
        F.when(F.col("k") % 3 != 0, F.col("k") * 2.0).alias("ANTI_FRAUD_SCORE_2"),
        (F.col("value") * 300).alias("CREDIT_LIMIT"),
        (F.col("k") % 2).alias("WHITE_LIST"),
        (F.col("k") % 5 == 0).cast("int").alias("BLACK_LIST"),
        F.col("k").alias("APPLY_SCORE"),
        F.col("ms").alias("CREDIT_TIME"),
    )
    return with_event_time(own, "CREDIT_TIME")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan applications with relationships, of the events table."""
    e = _events(spark, sf_dir)
    text = lambda c: c.cast("string")
    own = e.select(
        F.col("event_id").alias("seq"),
        text(F.col("event_id")).alias("APP_NO"),
        text(F.col("user_id")).alias("CERT_NO"),
        text(F.col("user_id") % 50).alias("MOBILE_NUM"),
        F.col("event_type").alias("COMP_NAME"),
        text(F.col("user_id") % 20).alias("STANDARD_ADDR"),
        text((F.col("user_id") * 7) % 150).alias("SPOUSE_CERT_NO"),
        text((F.col("user_id") * 7) % 50).alias("SPOUSE_MOBILE_NO"),
        text(F.col("k") % 3).alias("CERT_TYPE"),
        F.expr("ms div 1000").alias("APPLY_TIME"),
    )
    return with_event_time(own, "APPLY_TIME", "s")

"""A keyed store of latest values with versions, written by streams and read whole by anyone.

Rows lie in buckets by a hash of their key. A batch adds one folder of changes; a compaction writes what is left to a new snapshot. What the store holds
at a time is named by a manifest: a snapshot, and the changes behind it. Manifests are numbered and made in one step, and a reader takes the last one that
is complete, so it sees all of a batch or a compaction, or nothing. A version can be read again until `vacuum` deletes what no late manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.credit import hadoop_files

BUCKETS = 32


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int")


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, place = hadoop_files(spark, path)
    folder = place(f"{path}/manifests")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()) if fs.exists(folder) else []


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The last complete manifest, or that of a version: version, snapshot (a folder or null), through (the last batch in it), changes (batches behind it), schema."""
    for number in [version] if version is not None else reversed(_manifests(spark, path)):
        text = "".join(r.value for r in spark.read.text(f"{path}/manifests/{number}").collect())
        if text.endswith("}"):  # not one that is being written
            return json.loads(text)
    return {"version": 0, "snapshot": None, "through": -1, "changes": [], "schema": None}


def _commit(spark: SparkSession, path: str, held: dict) -> None:
    """Make the manifest of the next version; fails if another writer has made it."""
    fs, place = hadoop_files(spark, path)
    fs.mkdirs(place(f"{path}/manifests"))
    number = max(_manifests(spark, path), default=0) + 1
    out = fs.create(place(f"{path}/manifests/{number}"), False)
    out.write(bytearray(json.dumps(held | {"version": number}).encode()))
    out.close()


def write(batch: DataFrame, path: str, keys: list[str], order: str, number: int, days: int | None = None) -> None:
    """Add a batch's latest row of each key, by `order`; with `days`, a row expires so long after its `order`, a time. A batch that is in the store is left out."""
    spark = batch.sparkSession
    held = manifest(spark, path)
    if number <= held["through"] or number in held["changes"]:
        return
    own = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
    until = F.col(order) + F.make_dt_interval(F.lit(days)) if days is not None else F.lit(None).cast("timestamp")
    own = own.withColumns({"__until": until, "__written": F.lit(number).cast("long"), "__bucket": _bucket(keys)})
    own.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{path}/changes/{number}")
    _commit(spark, path, held | {"changes": [*held["changes"], number], "schema": own.schema.jsonValue()})


def read(spark: SparkSession, path: str, keys: list[str], order: str, version: int | None = None, as_of: Column | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The latest row of each key at a version (None: the last), without those expired at `as_of`; None if there is nothing yet. Of some buckets only, if given."""
    held = manifest(spark, path, version)
    parts = ([held["snapshot"]] if held["snapshot"] else []) + [f"changes/{n}" for n in held["changes"]]
    found = None
    for part in parts:
        rows = spark.read.schema(T.StructType.fromJson(held["schema"])).parquet(f"{path}/{part}")  # a folder may hold no rows
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return None
    if buckets is not None:
        found = found.where(F.col("__bucket").isin(buckets))
    names = [c for c in found.columns if c != "__bucket"]
    latest = found.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(order, "__written")).alias("r")).select("r.*")
    if as_of is not None:
        latest = latest.where(F.col("__until").isNull() | (F.col("__until") > as_of))
    return latest


def lookup(df: DataFrame, path: str, keys: list[str], order: str, values: list[str], version: int | None = None, as_of: Column | None = None) -> DataFrame:
    """Rows with the stored values of their keys, null where there are none; only the buckets that the rows' keys fall in are read."""
    spark = df.sparkSession
    touched = [r.b for r in df.select(_bucket(keys).alias("b")).distinct().collect()]  # BUCKETS at most
    latest = read(spark, path, keys, order, version, as_of, touched)
    if latest is None:
        raise ValueError(f"{path}: nothing has been written yet")
    found = latest.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *values)
    on = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    return df.join(found, on, "left").select(*df.columns, *values)


def compact(spark: SparkSession, path: str, keys: list[str], order: str, as_of: Column | None = None) -> None:
    """Write the latest rows that have not expired to a snapshot that stands for all batches so far. Readers see it when its manifest is there."""
    held = manifest(spark, path)
    latest = read(spark, path, keys, order, held["version"] or None, as_of)
    if latest is None or not held["changes"]:
        return
    folder = f"snapshots/{uuid.uuid4().hex}"
    latest.withColumn("__bucket", _bucket(keys)).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{path}/{folder}")
    _commit(spark, path, held | {"snapshot": folder, "through": max(held["changes"]), "changes": []})


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete manifests but the last ones, and the snapshots and changes that none of those names."""
    fs, place = hadoop_files(spark, path)
    kept = _manifests(spark, path)[-keep:]
    named = set()
    for held in (manifest(spark, path, v) for v in kept):
        named |= {held["snapshot"], *(f"changes/{n}" for n in held["changes"])}
    for kind in ("snapshots", "changes"):
        if fs.exists(place(f"{path}/{kind}")):
            for status in fs.listStatus(place(f"{path}/{kind}")):
                if f"{kind}/{status.getPath().getName()}" not in named:
                    fs.delete(status.getPath(), True)
    for number in _manifests(spark, path)[:-keep]:
        fs.delete(place(f"{path}/manifests/{number}"), False)


def pin(spark: SparkSession, store: str, job: str, number: int) -> int:
    """The version of a store that a job's batch reads: the last one when the batch is first done, the same whenever it is done again."""
    fs, place = hadoop_files(spark, job)
    mark = place(f"{job}/_versions/{number}")
    if not fs.exists(mark):
        fs.mkdirs(place(f"{job}/_versions"))
        own = place(f"{job}/_versions/_{uuid.uuid4().hex}")
        out = fs.create(own, True)
        out.write(bytearray(str(manifest(spark, store)["version"]).encode()))
        out.close()
        fs.rename(own, mark)
    return int("".join(r.value for r in spark.read.text(f"{job}/_versions/{number}").collect()))

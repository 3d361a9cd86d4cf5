"""Small helpers that every operator of this subpackage uses: shared storage, size-checked joins, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join may be broadcast only after it was counted and found to hold no more rows than this (16-byte rows: about 64 MB in memory).
BROADCAST_ROWS = 1_000_000


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared one that the session names in spark.checkpoint.dir. Where none is set, a local session makes one, any other fails."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidewatch/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: later steps neither recompute them nor depend on an executor."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark an already materialized side for broadcast if a count shows it to be within the limit; else leave it to a shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the graph with the edges (a, b): rows (id, component), component the smallest id reachable.

    Each round points every node to the smallest label among its neighbours' and then halves the paths; only minima are
    shuffled (with map-side combining), so a node with very many edges costs no more than its edges. Nodes without edges
    are not returned. Null ends are ignored.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = materialize(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label"))
    labels = materialize(labels)
    for _ in range(rounds):
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.id == near.a, "left").select(
            "id", "label", F.least("label", F.coalesce("near", "label")).alias("now")
        )
        # a node's label may itself have a smaller label by now: follow it once
        up = step.select(F.col("id").alias("uid"), F.col("now").alias("up"))
        new = materialize(
            step.join(up, step.now == up.uid, "left").select("id", F.least("now", F.coalesce("up", "now")).alias("label"), F.col("label").alias("old"))
        )
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("id", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return labels.select("id", F.col("label").alias("component"))

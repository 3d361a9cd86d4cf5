"""Hard negatives by blocks of inner products.

Anchors and candidates are dealt out in blocks, and a task multiplies tiles of one block of each by Strassen's method on 64-bit integers, so
scores are exact. It keeps a heap of the best positives of each of its anchors, and later, for each anchor and positive, a heap of the best
negatives within the positive's window of scores; the heaps of all tasks are merged by rank, and Spark cuts them before the shuffle too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize
from .vector_codes import rectangle, usable, whole

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: A positive's window: this share (in hundredths) of its score at least and at most.
LEAST, MOST = 30, 90
#: Rows of a block at most, and of a small table's blocks at least; rows of a tile.
BLOCK, FINE_BLOCK, TILE_ANCHORS, TILE = 1 << 16, 1 << 11, 256, 4096
#: Sides no longer than this are multiplied directly.
LEAF = 64


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of 64-bit integer matrices by seven half-sized ones, odd sides with a line of zeros; sums are exact (modulo 2 ** 64)."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, b.shape[1] // 2, a.shape[1] // 2  # noqa: E741
    (a11, a12), (a21, a22) = ((a[:i, :l], a[:i, l:]), (a[i:, :l], a[i:, l:]))
    (b11, b12), (b21, b22) = ((b[:l, :j], b[:l, j:]), (b[l:, :j], b[l:, j:]))
    p1, p2, p3, p4 = strassen(a11 + a22, b11 + b22), strassen(a21 + a22, b11), strassen(a11, b12 - b22), strassen(a22, b21 - b11)
    p5, p6, p7 = strassen(a11 + a12, b22), strassen(a21 - a11, b11 + b12), strassen(a12 - a22, b21 + b22)
    return np.block([[p1 + p4 - p5 + p7, p3 + p5], [p2 + p4, p1 - p2 + p3 + p6]])[:m, :n]


class Heap:
    """The best so many (score, id, row) of what was offered: higher scores first, then smaller ids."""

    def __init__(self, most: int) -> None:
        self.most, self.held = most, []

    def merge(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(scores) > self.most:  # all above the last score that can count, and those that tie with it
            fine = scores >= np.partition(scores, -self.most)[-self.most]
            scores, ids, rows = scores[fine], ids[fine], rows[fine]
        self.held = sorted([*self.held, *zip((-scores).tolist(), ids.tolist(), rows.tolist(), strict=True)])[: self.most]


def _side(table: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    """Row numbers, ids, labels and vectors of a block."""
    table = table.combine_chunks()
    column = table.column("v").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
    return (*(table.column(c).to_numpy() for c in ("row", "vec_id")), np.array(table.column("label").to_pylist(), object), rectangle(column, width))


def _tiles(a: tuple, c: tuple, together: Callable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor places, candidate places and scores, tile by tile; `together` gives the candidates of anchors of one label."""
    for label in dict.fromkeys(a[2].tolist()):
        own, others = np.flatnonzero(a[2] == label), np.flatnonzero(together(c[2], label))
        for at in range(0, len(own), TILE_ANCHORS):
            for to in range(0, len(others), TILE):
                part, some = own[at : at + TILE_ANCHORS], others[to : to + TILE]
                yield part, some, strassen(a[3][part], c[3][some].T)


def _blocks(n: int) -> int:
    return max(-(-n // BLOCK), min(32, -(-n // FINE_BLOCK)), 1)


def mine(vectors: DataFrame, anchors_of: str = "vec_id % 100 = 0", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: see the module.

    Anchors are the rows that pass `anchors_of`. Rows without an id or label, or whose vector is null or holds null or non-finite components, take no
    part. A row's components are floor(256 * x), held within +-2**26; shorter vectors count zeros behind them. Ties go to the smaller id. Rows that
    repeat an id are rows of their own: two anchors of one id have their results both, and one is the other's positive. Anchors without a positive,
    and positives whose window holds nothing, give no rows; so does an empty table. Other columns are left out.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole("embedding", SCALE).alias("v"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()))  # written once, so that a row keeps its number
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 1, 1)
    anchors = rows.where(anchors_of)
    over, across = _blocks(anchors.count()), _blocks(n)
    dealt = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    right = rows.withColumns({"j": dealt(across)}).withColumn("i", each(over)).groupBy("i", "j")

    def against(left: DataFrame, work: Callable, out: str) -> DataFrame:
        left = left.select(*[F.col(c).alias(c) for c in left.columns], dealt(over).alias("i")).withColumn("j", each(across))
        return left.groupBy("i", "j").cogroup(right).applyInArrow(work, out)

    def best(left: pa.Table, others: pa.Table) -> pa.Table:
        a, c = _side(left, width), _side(others, width)
        heaps = [Heap(positives) for _ in a[0]]
        for part, some, scores in _tiles(a, c, lambda labels, label: labels == label):
            for k, own in zip(part.tolist(), scores, strict=True):
                other = c[0][some] != a[0][k]
                heaps[k].merge(own[other], c[1][some][other], c[0][some][other])
        return _table([(int(a[0][k]), int(a[1][k]), -s, i, r) for k, heap in enumerate(heaps) for s, i, r in heap.held], ["row", "anchor_id", "score", "id", "other"])

    def within(left: pa.Table, others: pa.Table) -> pa.Table:
        a, c = _side(left, width), _side(others, width)
        asked = [[(p["place"], p["score"]) for p in held] for held in left.column("asked").to_pylist()]
        heaps = {(k, place): Heap(negatives) for k, held in enumerate(asked) for place, _ in held}
        for part, some, scores in _tiles(a, c, lambda labels, label: labels != label):
            for k, own in zip(part.tolist(), scores, strict=True):
                for place, score in asked[k]:
                    fine = np.flatnonzero((100 * own >= LEAST * score) & (100 * own <= MOST * score))
                    if len(fine):
                        heaps[k, place].merge(own[fine], c[1][some[fine]], c[0][some[fine]])
        return _table([(int(a[0][k]), place, -s, i, r) for (k, place), heap in heaps.items() for s, i, r in heap.held], ["row", "place", "score", "id", "other"])

    order = [F.desc("score"), "id", "other"]
    found = against(anchors, best, "row bigint, anchor_id bigint, score bigint, id bigint, other bigint")
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("place") <= positives)
    found = materialize(found.select("row", "anchor_id", F.col("place").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    asked = found.groupBy("row").agg(F.collect_list(F.struct("place", F.col("positive_score").alias("score"))).alias("asked"))  # a few of each anchor
    near = against(anchors.join(asked, "row"), within, "row bigint, place bigint, score bigint, id bigint, other bigint")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("row", "place").orderBy(*order))).where(F.col("rank") <= negatives)
    both = near.join(found, ["row", "place"])
    return both.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    cols = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols, strict=True)})


#: Vectors of equal length.
ORACLE_SQL = """WITH k AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  [floor(256 * y::DOUBLE)::DOUBLE for y in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([y for y in embedding if y IS NULL OR NOT isfinite(y)]) = 0),
s AS MATERIALIZED (SELECT a.row AS row, a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM k a JOIN k c ON a.row <> c.row WHERE a.vec_id % 100 = 0),
p AS (SELECT row, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY row ORDER BY score DESC, id) AS place FROM s WHERE same
  QUALIFY place <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.row, place ORDER BY score DESC, id))::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.row = s.row AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score QUALIFY rank <= 10"""

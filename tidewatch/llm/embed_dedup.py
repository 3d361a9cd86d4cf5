"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut in halves, and each half has a codebook of its own; the pairs of codes are the cells of a grid. A vector is stored in
the cell of its nearest codes. A search visits cells by growing sum of the two squared distances (the multi-sequence order) until it has
visited as many as were needed, on a bounded sample, to reach the target recall; what it finds there is verified with the
exact cosine. Equal vectors of one label are one class before anything is searched, and a cell reports how many links each vector
has and which component they lead to, not the links one by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, materialize, small
from .words import longs

COSINE = 0.93
#: Codebooks and the number of visited cells are fitted on this many vectors at most (about).
SAMPLE = 4000
#: Codes of each half: at least so many, at most so many; between them the cells grow in number with the vectors, CELL of them in each.
CODES, MOST_CODES, CELL = 12, 128, 2048
RECALL = 0.995
#: Vectors of either side that a task compares at a time; larger cells are dealt out by pairs of blocks.
BLOCK = 4096


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, so that very small and very large ones keep their direction."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Index:
    left: np.ndarray
    right: np.ndarray
    visits: int

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = x.shape[1] // 2
        return tuple(((v[:, None, :] - book[None]) ** 2).sum(axis=2) for v, book in ((x[:, :half], self.left), (x[:, half:], self.right)))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def visited(self, x: np.ndarray) -> np.ndarray:
        """The cells that each vector's search visits, the nearest first."""
        a, b = self.distances(x)
        return np.array([traverse(p, q, self.visits) for p, q in zip(a, b, strict=True)], np.int64).reshape(len(x), -1)


def traverse(a: np.ndarray, b: np.ndarray, visits: int) -> list[int]:
    """The cells with the smallest sums a[i] + b[j], by the multi-sequence algorithm."""
    i_of, j_of = a.argsort(kind="stable"), b.argsort(kind="stable")
    heap, seen, out = [(a[i_of[0]] + b[j_of[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append(int(i_of[i]) * len(b) + int(j_of[j]))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (a[i_of[p]] + b[j_of[q]], p, q))
    return out


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    book = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(12):
        near = ((x[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(len(book)):
            if (near == c).any():
                book[c] = x[near == c].mean(axis=0)
    return book


def fit(x: np.ndarray, labels: np.ndarray, cosine: float = COSINE, recall: float = RECALL, seed: int = 3, codes: int = CODES) -> Index:
    """Codebooks of unit vectors, and the visits at which the sample's own links reach the target recall (all cells if none shows it)."""
    rng = np.random.default_rng(seed)
    if not len(x):
        return Index(np.zeros((1, 1)), np.zeros((1, 1)), 1)
    half, k = x.shape[1] // 2, min(codes, len(x))
    index = Index(_codebook(x[:, :half], k, rng), _codebook(x[:, half:], k, rng), k * k)
    # links among sampled vectors, and of each with itself moved to the edge of the radius
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    edge = cosine * x + np.sqrt(1 - cosine**2) * noise
    at = np.array([{c: r for r, c in enumerate(row)}[own] for row, own in zip(index.visited(x), index.cells(edge).tolist(), strict=True)])
    index.visits = int(np.quantile(at, recall, method="higher")) + 1
    return index


def near_dedup(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    Vectors link within one label (null: none) when their cosine in double precision is at least `cosine`. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing, nor do vectors of different lengths. n_links counts the other vectors linked
    directly (a pair found counts for both), component_id is the smallest vec_id reachable, kept says whether that is the vector's own id. Rows that repeat an
    id are vectors of their own, each with its own row: with equal vectors of one label they link with each other, and where theirs is the smallest id of
    a component, all of them are kept. A row without an id is left out.
    """
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.where(fine & F.col("label").isNotNull())
    # equal vectors of a label are one class
    classes = good.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))  # a number of its own: vectors that repeat an id may be in several classes
    n, spread = classes.count(), 1 << 30
    chosen = classes.where(F.pmod(F.xxhash64("label", "v"), F.lit(spread)) < min(spread, int(spread * sample / max(n, 1)))).orderBy("least", "label", "v").collect()
    widths = classes.select(F.size("v").alias("d")).groupBy("d").count().orderBy(F.desc("count"), "d").limit(1).collect()
    width = widths[0]["d"] if widths else 1
    x = np.array([r["v"] for r in chosen if len(r["v"]) == width], float).reshape(-1, width)
    codes = max(CODES, min(MOST_CODES, int(np.ceil(np.sqrt(n / CELL)))))
    index = fit(unit(x) if len(x) else x, np.array([r["label"] for r in chosen]), cosine, codes=codes) if width > 1 else None

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, raw, who, weight = (batch.column(i).to_pylist() for i in range(4))
            out: list[tuple] = []
            for at in range(0, len(raw), 256):
                part = raw[at : at + 256]
                same = [i for i, v in enumerate(part) if len(v) == width]
                x = np.array([part[i] for i in same], float).reshape(-1, width)
                u = unit(x) if len(x) else x
                own, seen = (index.cells(u), index.visited(u)) if index and len(x) else (np.zeros(len(x), int), np.zeros((len(x), 1), int))
                for k, i in enumerate(same):
                    v = x[k].tobytes()
                    out.append((labels[at + i], int(own[k]), True, who[at + i], weight[at + i], v))
                    out += [(labels[at + i], int(c), False, who[at + i], weight[at + i], v) for c in seen[k]]
                for i, v in enumerate(part):  # vectors of another length: compared within a cell of their own length
                    if len(v) != width:
                        for stored in (True, False):
                            out.append((labels[at + i], -len(v), stored, who[at + i], weight[at + i], np.array(v, float).tobytes()))
                if len(out) >= 20_000:
                    yield _batch(out, _PLACED)
                    out = []
            if out:
                yield _batch(out, _PLACED)

    def verified(table: pa.Table) -> pa.Table:
        ids, weights = table.column("id").to_numpy(), table.column("weight").to_numpy()
        stored = np.array(table.column("stored").to_pylist(), bool)
        x = np.array([np.frombuffer(v, float) for v in table.column("v").to_pylist()])
        x = unit(x)
        searched = index is not None and x.shape[1] == width
        here, asks = np.flatnonzero(stored), np.flatnonzero(~stored)
        label, count, linked = ids.copy(), np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        blocks = []
        for at in range(0, len(asks), BLOCK):
            part = asks[at : at + BLOCK]
            for to in range(0, len(here), BLOCK):
                own = here[to : to + BLOCK]
                near = (x[part] @ x[own].T >= cosine) & (ids[part][:, None] != ids[own][None])
                count[part] += (near * weights[own][None]).sum(axis=1)
                if near.any():
                    if searched:  # who is found but does not visit the asker's cell has this link from here alone
                        found, by = np.flatnonzero(near.any(axis=0)), np.flatnonzero(near.any(axis=1))
                        visits, home = index.visited(x[own[found]]), index.cells(x[part[by]])
                        unseen = near[np.ix_(by, found)] & ~np.array([np.isin(home, v) for v in visits]).T
                        count[own[found]] += (unseen * weights[part[by]][:, None]).sum(axis=0)
                    linked[part] |= near.any(axis=1)
                    linked[own] |= near.any(axis=0)
                    blocks.append((part, own, np.packbits(near, axis=1)))
        # the smallest id that links lead to, within this cell: not one row for each link
        while True:
            before = label.copy()
            for part, own, bits in blocks:
                near = np.unpackbits(bits, axis=1, count=len(own)).astype(bool)
                high = np.iinfo(np.int64).max
                label[own] = np.minimum(label[own], np.where(near, label[part][:, None], high).min(axis=0))
                label[part] = np.minimum(label[part], np.where(near, label[own][None], high).min(axis=1))
            if (before == label).all():
                break
        return pa.table({"a": longs(ids[linked]), "b": longs(label[linked]), "weight": longs(count[linked])})

    pairs = classes.select("label", "v", "id", "weight").mapInArrow(placed, ", ".join(f"{n} {t}" for n, _, t in _PLACED))
    # a large cell is dealt out by pairs of blocks, so no task holds more than one of each side
    placed_rows = materialize(pairs)
    blocks = placed_rows.groupBy("label", "cell").agg(*[F.greatest(F.ceil(F.sum(F.when(c, 1).otherwise(0)) / F.lit(BLOCK)), F.lit(1)).cast("int").alias(n) for n, c in (("held", F.col("stored")), ("asked", ~F.col("stored")))])
    both = placed_rows.join(blocks, ["label", "cell"])
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    both = both.withColumn("i", F.explode(F.when(F.col("stored"), every("asked")).otherwise(F.array(hashed("asked")))))
    both = both.withColumn("j", F.explode(F.when(F.col("stored"), F.array(hashed("held"))).otherwise(every("held"))))
    near = both.drop("held", "asked").groupBy("label", "cell", "i", "j").applyInArrow(verified, "a bigint, b bigint, weight bigint")
    found = materialize(near)
    w = classes.select("id", "weight", "least")
    degree = found.groupBy(F.col("a").alias("id")).agg(F.sum("weight").alias("other"))
    label = components(found.select("a", "b"))
    least = materialize(w.join(label, "id").groupBy("component").agg(F.min("least").alias("first")))
    state = w.join(degree, "id", "left").join(label.join(small(least), "component"), "id", "left")
    state = state.select("id", (F.col("weight") - 1 + F.coalesce("other", F.lit(0))).alias("n_links"), F.coalesce("first", "least").alias("component_id"))
    of_class = classes.select("label", "v", "id").join(state, "id").drop("id")
    linked = good.select("vec_id", "label", "v").join(of_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(fine & F.col("label").isNotNull())).select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("component_id") == F.col("vec_id")).alias("kept"))


_PLACED = [("label", pa.string(), "string"), ("cell", pa.int32(), "int"), ("stored", pa.bool_(), "boolean"), ("id", pa.int64(), "bigint"), ("weight", pa.int64(), "bigint"), ("v", pa.binary(), "binary")]


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _, _ in fields])

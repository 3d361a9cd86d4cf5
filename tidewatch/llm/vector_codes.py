"""Product codes of vectors, with equal-average search.

Vectors of whole numbers are cut into 8 parts, and each part position has a codebook of 16 entries. Entries are sorted by the sum of their
components; the search for a part's nearest entry begins where the part's own sum would stand and goes outward on both sides, until the
squared gap of the sums over the dimension is greater than the best squared distance: no entry beyond can be as near.

A round reads the vectors where they lie; a task adds up its parts by entry, and only these sums are shuffled. What the driver holds
is the codebooks: 16 vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Whole components are held within these bounds, so that sums of squares fit 64 bits.
MOST = 1 << 26
#: Vectors that a task works on at a time.
ROWS = 8192
#: Rows of one label are dealt out so many ways where labels are too many for a broadcast of their totals.
SALTS = 32


def usable(v: str) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(v: str, scale: int) -> Column:
    """floor(scale * x) of every component, in double precision, held within +-MOST."""
    return F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int"))


def rectangle(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as 64-bit integers, zeros behind shorter ones."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(np.diff(column.offsets.to_numpy()))
    if len(flat) == len(column) * width:
        return flat.reshape(-1, width)
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row (the lower index of equally near ones) and its squared distance."""
    n, k = x.shape
    sums = book.sum(axis=1)
    order = sums.argsort(kind="stable")
    sums, own = sums[order], x.sum(axis=1)
    down = np.searchsorted(sums, own) - 1
    up = down + 1
    best, entry = np.full(n, np.iinfo(np.int64).max), np.full(n, len(book))
    rows, last = np.arange(n), len(book) - 1
    while len(rows):
        lo, hi = down[rows], up[rows]
        below = np.where(lo >= 0, own[rows] - sums[np.maximum(lo, 0)], np.iinfo(np.int64).max)
        above = np.where(hi <= last, sums[np.minimum(hi, last)] - own[rows], np.iinfo(np.int64).max)
        left = below <= above
        gap = np.where(left, below, above)
        # every entry not yet seen is at least this far off in its sum; gap * gap / k > best, without leaving 64 bits
        on = (gap < np.iinfo(np.int64).max) & (gap.astype(float) ** 2 <= k * best[rows].astype(float) * (1 + 1e-9) + 1)
        rows, left = rows[on], left[on]
        at = np.where(left, down[rows], up[rows])
        index = order[at]
        d = ((x[rows] - book[index]) ** 2).sum(axis=1)
        better = (d < best[rows]) | ((d == best[rows]) & (index < entry[rows]))
        best[rows[better]], entry[rows[better]] = d[better], index[better]
        down[rows[left]] -= 1
        up[rows[~left]] += 1
    return entry, best


def codes_of(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of every part of every row; books is (parts, entries, components)."""
    found = [nearest(part, book) for part, book in zip(np.split(x, len(books), axis=1), books, strict=True)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _sums(rows: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """One round: the new entries. Unused ones stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, k = books.shape
        total, count = np.zeros((parts * entries, k), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                x = rectangle(batch.column(0).slice(at, ROWS), width)
                own = codes_of(x, books)[0] + np.arange(parts) * entries
                np.add.at(total, own.ravel(), x.reshape(-1, k))
                count += np.bincount(own.ravel(), minlength=len(count))
        used = np.flatnonzero(count)
        cols = [np.repeat(used, k), np.tile(np.arange(k), len(used)), total[used].ravel(), np.repeat(count[used], k)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["slot", "pos", "total", "n"])

    partial = rows.select("v").mapInArrow(run, "slot bigint, pos bigint, total bigint, n bigint")
    books = books.copy()
    for r in partial.groupBy("slot", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        books[r["slot"] // books.shape[1], r["slot"] % books.shape[1], r["pos"]] = r["total"] // r["n"]
    return books


def train(rows: DataFrame, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks of rows (vec_id, v): they start as the parts of the smallest ids; ids that repeat are ordered by their vectors, those without come last."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    x = rectangle(pa.array([r["v"] for r in first], pa.list_(pa.int32())), width)
    books = np.stack(np.split(x, PARTS, axis=1)) if len(x) else np.zeros((PARTS, 0, width // PARTS), np.int64)
    for _ in range(rounds if len(x) else 0):
        books = _sums(rows, books, width)
    return books


def kept_rows(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, label and whole components of the vectors that can be used, as a written table, and their common width (a multiple of the parts)."""
    rows = vectors.where(usable("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole("embedding", SCALE).alias("v"))
    rows = materialize(rows)
    widest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows, max(1, -(-widest // PARTS)) * PARTS


def compress(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code (an index for each part), error (of 64 bits) of every usable vector, and the codebooks.

    Vectors that are null or hold null or non-finite components are left out. Rows that repeat an id, or have none, are rows of their own (a null id comes
    last in the order that starts the codebooks). Shorter vectors than the longest are taken with zeros behind them, an empty one is all zeros; components beyond
    +-MOST are held there. Fewer than 16 rows make fewer entries, an empty table gives an empty one and empty codebooks. Other columns are left out.
    """
    rows, width = kept_rows(vectors)
    books = train(rows, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                code, error = codes_of(rectangle(part.column(2), width), books)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * PARTS, pa.int32()), pa.array(code.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array(error.sum(axis=1), pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, "vec_id bigint, label string, code array<int>, error bigint"), books


def digest(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code as text, error, label_error and the codebooks' hash. A label's total is joined by broadcast where labels are few, else to salted rows."""
    coded = materialize(coded)
    total = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    on = F.col("label").eqNullSafe(F.col("of"))
    if total.count() <= BROADCAST_ROWS:
        both = coded.join(F.broadcast(total), on)
    else:
        salted = total.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(salted, on & (F.col("salt") == F.col("s")))
    text = F.concat_ws("", F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    own = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return both.select("vec_id", text.alias("code"), "error", "label_error", F.lit(own).alias("codebooks_sha256"))


def _round(r: int) -> str:
    """One round in SQL: assignments, then entries."""
    return f""", n{r} AS MATERIALIZED (SELECT rid, p, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])::BIGINT * 16 + e) AS d FROM x JOIN b{r} USING (p) GROUP BY 1, 2),
b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(u.c, b{r}.c) AS c FROM b{r} LEFT JOIN (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
    SELECT p, d % 16 AS e, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n FROM n{r} JOIN x USING (rid, p), range(1, len(x) + 1) q(i) GROUP BY ALL) GROUP BY ALL) u USING (p, e))"""


#: Vectors of equal length, a multiple of 8.
ORACLE_SQL = f"""WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, [floor(4096 * y::DOUBLE)::BIGINT for y in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([y for y in embedding if y IS NULL OR NOT isfinite(y)]) = 0),
x AS MATERIALIZED (SELECT rid, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM k, range(8) t(p)),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM x WHERE rid <= 16){"".join(_round(r) for r in range(ROUNDS))},
n AS MATERIALIZED (SELECT rid, p, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])::BIGINT * 16 + e) AS d FROM x JOIN b{ROUNDS} USING (p) GROUP BY 1, 2),
f AS (SELECT rid, string_agg(printf('%02x', d % 16), '' ORDER BY p) AS code, sum(d // 16)::BIGINT AS error FROM n GROUP BY 1),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN f USING (rid), h"""

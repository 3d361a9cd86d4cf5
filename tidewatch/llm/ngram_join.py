"""N-gram Jaccard join with two-level PartEnum signatures.

Sizes fall into bands so that two sets similar enough are in one band or in neighbouring ones; for each band there is a bound k on how many
shingles such sets differ in. The domain of shingle hashes is cut into first-level parts, and each of those into three. With more than k / 2
first-level parts, two similar sets differ in at most one shingle within some of them, so at least two of its three pieces agree: every
choice of two pieces of every part is a signature. For small bands the domain is one part of k + 3 pieces, and every choice of three signs. A set
in which no more parts than can be spared have an empty choice leaves its empty choices out, as a full one must agree too; any other signs all.

One pass makes each document's set, its signatures and a sketch of it (how many hashes lie in each slice of the domain). Signatures travel as
sorted runs, four bytes each. Documents that share one form a group, and each distinct group is looked at once: the sketches bound the
similarity from above, and only who is connected by pairs that may link is kept. Any link lies within such a cluster. Each
document of a cluster travels to it once, as a set, and the cluster's exact components are found there, through the postings of its shingles. Groups
and clusters that are too large for one task are cut into blocks. Equal sets are one class and are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, materialize, small
from .words import WordHash, ids, longs, mix, shingle_set, texts

N = 5
#: Two sets link when 100 * common >= PERCENT * all.
PERCENT = 80
#: Members of a group that one row holds; larger groups are compared block by block.
CHUNK = 4096
#: Shingles of a cluster that one task holds; larger clusters are compared block by block, after their blocks were linked through pivots.
SHARD = 2_000_000
PIVOTS = 16
#: Signatures that a task gathers before it sorts and sends them.
_HELD = 2_000_000
_BITS = 36
_STEP, _SALT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA0761D6478BD642F)


@lru_cache(maxsize=None)
def _bounds(i: int) -> tuple[int, int]:
    """The smallest and the largest size of band i; the next one starts behind the largest size that a set of the first size can match."""
    low = 1
    for _ in range(i):
        low = low * 100 // PERCENT + 1
    return low, low * 100 // PERCENT


@lru_cache(maxsize=None)
def band(size: int) -> int:
    i = 0
    while _bounds(i)[1] < size:
        i += 1
    return i


@dataclass(frozen=True)
class Plan:
    """How sets of bands i - 1 and i sign: parts, pieces of each, the choices of pieces, and how many parts may have an empty choice."""

    parts: int
    pieces: int
    choices: np.ndarray
    spare: int


@lru_cache(maxsize=None)
def plan(i: int) -> Plan | None:
    """None where similar sets are equal: those need no signature."""
    least, high = _bounds(max(0, i - 1))[0], _bounds(i)[1]
    k = 2 * high * (100 - PERCENT) // (100 + PERCENT)
    if not k:
        return None
    if k <= 4:
        return Plan(1, k + 3, np.array(list(combinations(range(k + 3), 3))), 0)
    need, best = k // 2 + 1, (0.0, 0)
    for parts in range(need, 2 * need + 9):
        empty = min(1.0, 3 * exp(-least / parts * 2 / 3))
        margin = (parts - need + 0.5 - parts * empty) / sqrt(max(parts * empty * (1 - empty), 1e-9))
        if not best[1] or margin > best[0]:
            best = (margin, parts)
        if margin >= 2:
            break
    return Plan(best[1], 3, np.array([[0, 1], [0, 2], [1, 2]]), best[1] - need)


def signatures(shingles: np.ndarray) -> np.ndarray:
    """The signatures of a sorted set of unsigned 64-bit hashes, each below 2**36."""
    own, out = band(len(shingles)), []
    sums = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles), out=sums[1:])
    high = shingles >> np.uint64(32)
    for i in (own, own + 1):
        if (p := plan(i)) is None:
            continue
        n = p.parts * p.pieces
        counts = np.bincount(((high * np.uint64(n)) >> np.uint64(32)).astype(np.int64), minlength=n)
        ends = np.cumsum(counts)
        piece = mix(sums[ends] - sums[ends - counts] + np.arange(n, dtype=np.uint64) * _STEP + np.uint64((i + 1) * int(_SALT) & (2**64 - 1)))
        found = piece.reshape(p.parts, p.pieces)[:, p.choices].sum(axis=2, dtype=np.uint64)
        empty = (counts.reshape(p.parts, p.pieces)[:, p.choices] == 0).all(axis=2)
        if empty.any() and empty.any(axis=1).sum() <= p.spare:
            found = found[~empty]
        out.append(found.ravel())
    return mix(np.concatenate(out)) >> np.uint64(64 - _BITS) if out else np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    return (int(mix(s).sum(dtype=np.uint64)), int(mix(s * _STEP).sum(dtype=np.uint64))) if len(s) else (0, 0)


def _slices(n: int) -> int:
    """Slices of the domain that a sketch of n hashes counts: a power of two, two to four hashes in each."""
    return max(8, 1 << ((n - 1) // 4).bit_length())


def sketch(s: np.ndarray) -> bytes:
    """Counts by slice, four bits each; empty where one does not fit."""
    n = _slices(len(s))
    counts = np.bincount((s >> np.uint64(65 - n.bit_length())).astype(np.int64), minlength=n)
    return (counts[::2] << 4 | counts[1::2]).astype(np.uint8).tobytes() if counts.max() < 16 else b""


def _unpacked(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8)
    return np.stack([x >> 4, x & 15], axis=1).reshape(-1)


_ROW = ["kind", "bucket", "a", "b", "n", "x", "y", "z"]
_TYPES = [pa.int8(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_SCHEMA = "kind tinyint, bucket int, a bigint, b bigint, n bigint, x bigint, y bigint, z binary"


def _rows(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, _TYPES, strict=True)], _ROW)


def _run(values: np.ndarray, local: np.ndarray, base: int) -> bytes:
    """Sorted values and who has them: differences in two bytes, what exceeds them apart, then two bytes for each owner."""
    step = np.diff(values, prepend=np.uint64(0))
    over = np.flatnonzero(step >> np.uint64(16))
    head = np.array([base, len(values), len(over)], "<i8").tobytes()
    return b"".join([head, (step & np.uint64(0xFFFF)).astype("<u2").tobytes(), local.astype("<u2").tobytes(), over.astype("<u4").tobytes(), (step[over] >> np.uint64(16)).astype("<u4").tobytes()])


def _read_run(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    base, n, m = np.frombuffer(raw, "<i8", 3).tolist()
    step = np.frombuffer(raw, "<u2", n, 24).astype(np.uint64)
    over = np.frombuffer(raw, "<u4", m, 24 + 4 * n)
    step[over] += np.frombuffer(raw, "<u4", m, 24 + 4 * n + 4 * m).astype(np.uint64) << np.uint64(16)
    return np.cumsum(step, dtype=np.uint64), np.frombuffer(raw, "<u2", n, 24 + 2 * n).astype(np.int64) + base


def _signed(docs: DataFrame, buckets: int) -> DataFrame:
    """Kind 0: a row number, its doc_id, size, digest and sketch. Kind 1: a run of signatures of one bucket with their row numbers."""
    width = np.uint64(-(-(1 << _BITS) // buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, words = TaskContext.get().partitionId() << 40, WordHash()
        facts: list[list] = [[] for _ in range(6)]
        sigs: list[np.ndarray] = []
        who: list[int] = []
        seen: set[tuple[int, int]] = set()
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, facts, sigs, who, held
            n = len(facts[0])
            if not n:
                return
            row = np.arange(base, base + n)
            own, doc, size, x, y, z = facts
            yield _rows([np.zeros(n, np.int8), (row % buckets).astype(np.int32), row, np.array(doc, np.int64), np.array(size, np.int64), longs(np.array(x, np.uint64)), longs(np.array(y, np.uint64)), z])
            if sigs:
                both = np.concatenate(sigs) << np.uint64(16) | np.repeat(np.array(who, np.uint64), [len(s) for s in sigs])
                both.sort()
                value, local = both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.uint16)
                edges = np.searchsorted(value, np.arange(buckets + 1, dtype=np.uint64) * width)
                full = np.flatnonzero(np.diff(edges))
                runs = [_run(value[edges[b] : edges[b + 1]] - np.uint64(b) * width, local[edges[b] : edges[b + 1]], base) for b in full.tolist()]
                for at in range(0, len(full), 2000):
                    part = full[at : at + 2000]
                    none = pa.nulls(len(part), pa.int64())
                    yield _rows([np.ones(len(part), np.int8), part.astype(np.int32), none, none, none, none, none, runs[at : at + 2000]])
            base, facts, sigs, who, held = base + n, [[] for _ in range(6)], [], [], 0
            seen.clear()

        for batch in batches:
            for doc_id, t in zip(ids(batch).tolist(), texts(batch), strict=True):
                s = shingle_set(words.of(t.lower().split()), N)
                d = _digest(s)
                for c, v in zip(facts, (0, doc_id, len(s), *d, sketch(s) if len(s) else b""), strict=True):
                    c.append(v)
                if len(s) and d not in seen:  # equal sets sign once
                    seen.add(d)
                    sigs.append(signatures(s))
                    who.append(len(facts[0]) - 1)
                    held += len(sigs[-1])
                if held >= _HELD or len(facts[0]) == 1 << 16:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(run, _SCHEMA)


def _grouped(signed: DataFrame, buckets: int) -> DataFrame:
    """Kind 0 as it comes. Kind 2: a name, least row, size, block number, number of blocks and rows of each distinct group of a partition."""
    width = -(-(1 << _BITS) // buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, rows = [], []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind == 0).any():
                yield batch.filter(pa.array(kind == 0))
            for i in np.flatnonzero(kind == 1).tolist():
                value, row = _read_run(batch.column(7)[i].as_py())
                sigs.append(value + np.uint64(batch.column(1)[i].as_py() * width))
                rows.append(row)
        if not sigs:
            return
        sig, row = np.concatenate(sigs), np.concatenate(rows)
        del sigs, rows
        order = np.argsort(sig, kind="stable")
        sig, row = sig[order], row[order]
        same = sig[1:] == sig[:-1]
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        sig, row = sig[keep], row[keep]
        if not len(sig):
            return
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.append(starts, len(sig)))
        name = np.add.reduceat(mix(row.astype(np.uint64)), starts)
        lead = np.minimum.reduceat(row, starts)
        _, first = np.unique(name, return_index=True)
        out: list[list] = [[] for _ in range(6)]
        for g in first.tolist():
            members = np.unique(row[starts[g] : starts[g] + size[g]])
            if len(members) < 2:
                continue
            blocks = -(-len(members) // CHUNK)
            for b in range(blocks):
                for c, v in zip(out, (int(name[g]), int(lead[g]), len(members), b, blocks, members[b * CHUNK : (b + 1) * CHUNK].tobytes()), strict=True):
                    c.append(v)
            if len(out[0]) >= 20_000:
                yield group_rows(out)
                out = [[] for _ in range(6)]
        if out[0]:
            yield group_rows(out)

    def group_rows(out: list[list]) -> pa.RecordBatch:
        n = len(out[0])
        return _rows([np.full(n, 2, np.int8), np.zeros(n, np.int32), longs(np.array(out[0], np.uint64)), *[np.array(c, np.int64) for c in out[1:5]], out[5]])

    return signed.repartition("bucket").mapInArrow(run, _SCHEMA)


def _members(groups: DataFrame) -> DataFrame:
    """key, row: who is compared with whom; a group of several blocks is dealt out by pairs of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for name, block, blocks, raw in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                own = np.frombuffer(raw, np.int64)
                if blocks == 1:
                    key = np.array([name], np.int64)
                else:
                    other = np.arange(blocks, dtype=np.uint64)
                    pair = np.minimum(other, np.uint64(block)) << np.uint64(32) | np.maximum(other, np.uint64(block))
                    key = mix(mix(pair) + np.uint64(name & (2**64 - 1))).view(np.int64)
                keys.append(np.repeat(key, len(own)))
                rows.append(np.tile(own, len(key)))
            if keys:
                key, row = np.concatenate(keys), np.concatenate(rows)
                for at in range(0, len(key), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(key[at : at + 200_000]), pa.array(row[at : at + 200_000])], ["key", "row"])

    return groups.mapInArrow(run, "key bigint, row bigint")


class _Sketches:
    """The sketches of a task's rows, as counts by slice; those of twice as many slices can be folded."""

    def __init__(self, n: np.ndarray, raw: list[bytes]) -> None:
        self.n, self.level = n, np.array([len(r).bit_length() if r else 0 for r in raw])  # 0: none
        self.at, self.counts = np.zeros(len(raw), np.int64), {}
        for level in np.unique(self.level[self.level > 0]).tolist():
            own = np.flatnonzero(self.level == level)
            packed = np.frombuffer(b"".join([raw[i] for i in own.tolist()]), np.uint8).reshape(len(own), -1)
            self.counts[level] = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(own), -1)
            self.at[own] = np.arange(len(own))
        self.folded = {k - 1: v[:, ::2] + v[:, 1::2] for k, v in self.counts.items()}

    def _of(self, rows: np.ndarray, level: int) -> np.ndarray:
        own = self.level[rows] == level
        out = np.empty((len(rows), 1 << level), np.uint8)
        if own.any():
            out[own] = self.counts[level][self.at[rows[own]]]
        if not own.all():
            out[~own] = self.folded[level][self.at[rows[~own]]]
        return out

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of rows (a, b) the sizes and sketches allow: no more can be common than the smaller count of each slice."""
        n, m = self.n[a], self.n[b]
        ok = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
        level = np.minimum(self.level[a], self.level[b])
        for k in np.unique(level[ok]).tolist():
            if not k:
                continue
            of = np.flatnonzero(ok & (level == k))
            for at in range(0, len(of), max(1, 4_000_000 >> k)):
                own = of[at : at + max(1, 4_000_000 >> k)]
                most = np.minimum(self._of(a[own], k), self._of(b[own], k)).sum(axis=1, dtype=np.int64)
                ok[own] = 100 * most >= PERCENT * (n[own] + m[own] - most)
        return ok


class _Forest:
    """Who is connected so far, by the position of rows in a task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _possible(members: DataFrame) -> DataFrame:
    """a, b: who is connected, through pairs of classes that may link, to which least class, for each partition.

    A star for each tree: trees that overlap in several partitions mostly have one least member, and so the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows, number, rep, n, raw = [], [], {}, [], [], []
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            where = np.empty(batch.num_rows, np.int64)
            for i, row in enumerate(batch.column(1).to_pylist()):
                if (k := number.get(row)) is None:
                    number[row] = k = len(rep)
                    rep.append(batch.column(2)[i].as_py())
                    n.append(batch.column(3)[i].as_py())
                    raw.append(batch.column(4)[i].as_py())
                where[i] = k
            rows.append(where)
        if not keys:
            return
        key, row, rep_of = np.concatenate(keys), np.concatenate(rows), np.array(rep, np.int64)
        sketches, forest = _Sketches(np.array(n, np.int64), raw), _Forest(len(rep))
        first: dict[int, int] = {}
        for k, r in enumerate(rep):  # rows of one class
            forest.join(first.setdefault(r, k), k)
        touched: set[int] = set()

        def link(i: int, j: int) -> None:
            if forest.join(i, j):
                touched.update((i, j))

        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        # small groups: all pairs, each once
        pairs = []
        for m in range(2, 9):
            own = starts[sizes == m]
            if len(own):
                i, j = np.triu_indices(m, 1)
                at = row[own[:, None] + np.arange(m)]
                pairs.append(np.stack([at[:, i].ravel(), at[:, j].ravel()], axis=1))
        if pairs:
            both = np.concatenate(pairs)
            both = np.unique(both.min(axis=1) * len(rep) + both.max(axis=1))
            a, b = both // len(rep), both % len(rep)
            other = rep_of[a] != rep_of[b]
            a, b = a[other], b[other]
            ok = sketches.may_link(a, b)
            for i, j in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
                link(i, j)
        # larger ones: who is not yet reached is compared with each that is
        for s in np.flatnonzero(sizes > 8).tolist():
            left = np.unique(row[starts[s] : starts[s] + sizes[s]])
            root = np.array([forest.root(i) for i in left.tolist()])
            while len(left):
                queue, left, root = [int(left[0])], left[1:], root[1:]
                reached = forest.root(queue[0])
                while queue and len(left):
                    d = queue.pop()
                    hit = root == reached
                    far = np.flatnonzero(~hit)
                    hit[far] = sketches.may_link(np.full(len(far), d), left[far])
                    for i in left[hit].tolist():
                        link(d, i)
                        queue.append(i)
                    left, root = left[~hit], root[~hit]
                    if len(left) and hit.any():
                        root = np.array([forest.root(i) for i in left.tolist()])
                    reached = forest.root(d)
        if touched:
            root = np.array([forest.root(i) for i in range(len(rep))])
            least = np.full(len(rep), np.iinfo(np.int64).max)
            np.minimum.at(least, root, rep_of)
            own = np.array(sorted(touched))
            a, b = rep_of[own], least[root[own]]
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    return members.repartition("key").mapInArrow(run, "a bigint, b bigint")


def linked(who: np.ndarray, sets: list[np.ndarray], part: np.ndarray) -> np.ndarray:
    """The least id of each row's exact component; rows of one `part` (0: none known) are connected already."""
    least, alive = who.copy(), np.arange(len(sets))
    size = np.array([len(s) for s in sets])

    def postings(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = np.concatenate([sets[i] for i in rows.tolist()])
        order = np.argsort(flat, kind="stable")
        return flat[order], np.repeat(rows, size[rows])[order], np.array([len(rows)])

    shingle, owner, built = postings(alive)
    left = np.ones(len(sets), bool)
    remaining = len(sets)
    for seed in range(len(sets)):
        if not left[seed]:
            continue
        left[seed], remaining = False, remaining - 1
        queue, reached = [seed], [seed]
        while queue and remaining:
            d = queue.pop()
            if remaining < built[0] // 2 and built[0] > 16:
                shingle, owner, built = postings(np.flatnonzero(left))
            lo, hi = np.searchsorted(shingle, sets[d], "left"), np.searchsorted(shingle, sets[d], "right")
            n = hi - lo
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            common = np.bincount(owner[at], minlength=len(sets))
            hit = left & ((100 * common >= PERCENT * (size + size[d] - common)) | ((part == part[d]) & (part != 0)))
            new = np.flatnonzero(hit).tolist()
            left[hit] = False
            remaining -= len(new)
            queue += new
            reached += new
        least[reached] = who[reached].min()
    return least


def _exact(docs: DataFrame, tiles: DataFrame) -> DataFrame:
    """id, label: within each tile (rows id, key, part) the least id of each one's exact component, where that is another id."""

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for batch in batches:
            sets = [shingle_set(words.of(t.lower().split()), N).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sets, pa.binary())], ["doc_id", "to", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        key, who, part = (t.column(i).to_numpy() for i in range(3))
        raw = t.column(3)
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1], [True]]))
        out = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = order[a:b]
            least = linked(who[own], [np.frombuffer(raw[i].as_py(), np.uint64) for i in own.tolist()], part[own])
            moved = least != who[own]
            out.append(np.stack([who[own][moved], least[moved]], axis=1))
        found = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([longs(found[:, 0]), longs(found[:, 1])], ["id", "label"])

    to = tiles.groupBy("id").agg(F.collect_list(F.struct("key", "part")).alias("to"))
    own = docs.join(small(materialize(to)), docs.doc_id == F.col("id")).select("doc_id", "text", "to")
    kind = "array<struct<key:bigint,part:bigint>>"
    sets = own.mapInArrow(bare, f"doc_id bigint, to {kind}, s binary").select("doc_id", F.explode("to").alias("t"), "s")
    return sets.select("t.key", "doc_id", "t.part", "s").repartition("key").mapInArrow(run, "id bigint, label bigint")


def _labels(docs: DataFrame, clusters: DataFrame, sizes: DataFrame) -> tuple[DataFrame, bool]:
    """id, label of whoever has a smaller id in its component, and whether one label for each id is final."""
    live = clusters.join(sizes, "id").select("id", F.col("component").alias("cluster"), "n")
    weight = live.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(SHARD)).cast("int").alias("blocks"), F.count("*").alias("members"))
    live = materialize(live.join(weight, "cluster"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    none = F.lit(0).cast("long").alias("part")
    big = live.where("blocks > 1")
    whole = live.where("blocks = 1").select("id", F.xxhash64("cluster").alias("key"), none)
    if not big.limit(1).count():
        return materialize(_exact(docs, whole)), True
    # blocks of a large cluster, each with the same few pivots
    pivots = big.where(F.pmod(F.xxhash64("id", F.lit(1)), F.col("members")) < PIVOTS)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    blocks = big.select("id", "cluster", block.alias("block")).union(pivots.select("id", "cluster", every)).distinct()
    first = materialize(_exact(docs, whole.union(blocks.select("id", F.xxhash64("cluster", "block").alias("key"), none))))
    # who is outside of a cluster's largest component so far is compared with all of the cluster
    label = components(first.select(F.col("id").alias("a"), F.col("label").alias("b")))
    now = big.join(label, "id", "left").select("id", "cluster", "n", "blocks", F.coalesce("component", "id").alias("part"))
    now = materialize(now)
    largest = now.groupBy("cluster", "part").agg(F.count("*").alias("k")).groupBy("cluster").agg(F.max_by("part", F.struct("k", "part")).alias("main"))
    rest = materialize(now.join(largest, "cluster").where("part <> main").select("id", "cluster", "n", "blocks", "part"))
    parts = rest.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(SHARD)).cast("int").alias("parts"))
    left = rest.join(parts, "cluster").select("id", "cluster", "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("r"), every)
    all_parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("r")
    right = now.join(parts, "cluster").select("id", "cluster", "part", all_parts, block.alias("block"))
    tiles = left.select("id", F.xxhash64("cluster", "r", "block").alias("key"), "part").union(right.select("id", F.xxhash64("cluster", "r", "block").alias("key"), "part"))
    return materialize(first.union(_exact(docs, tiles.distinct()))), False


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document with an id; component_id is the smallest doc_id reachable by links.

    Words are what stands between ASCII white space, A-Z in lower case. A text of fewer than five words is one shingle; null and empty
    texts have none and link with nothing. Rows that repeat an id are returned each, and linked as one document.
    """
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    buckets = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = materialize(_grouped(_signed(own, buckets), buckets))
    facts = table.where("kind = 0").select(F.col("a").alias("row"), F.col("b").alias("doc_id"), "n", F.col("x").alias("d1"), F.col("y").alias("d2"), F.col("z").alias("k"))
    # equal sets are one class, which its smallest id stands for
    classes = facts.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")).where("members > 1")
    rows = facts.join(small(materialize(classes.drop("members"))), ["d1", "d2", "n"], "left").select("row", "doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), "k")
    rows = materialize(rows)
    groups = table.where("kind = 2").dropDuplicates(["a", "b", "n", "x"])
    members = _members(groups.select("a", "x", "y", "z")).join(rows, "row").select("key", "row", "rep", "n", "k")
    clusters = components(materialize(_possible(members).distinct()))
    sizes = rows.groupBy(F.col("doc_id").alias("id")).agg(F.sum("n").alias("n"), F.count("*").alias("times"))
    label, final = _labels(own, clusters, sizes.select("id", "n"))
    if not final or sizes.where("times > 1").limit(1).count():
        same = rows.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        label = components(label.select(F.col("id").alias("a"), F.col("label").alias("b")).union(same)).select("id", F.col("component").alias("label"))
    return rows.join(label, rows.rep == label.id, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id, columns as they came.

    Rows without an id and rows of null or empty text stay; of rows that repeat an id all stay or all go.
    """
    gone = materialize(ngram_join(docs).where("doc_id <> component_id").select("doc_id").distinct())
    gone = small(gone.select(F.col("doc_id").alias("gone_id")))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")

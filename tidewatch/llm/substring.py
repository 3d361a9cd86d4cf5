"""Substring dedup: passages that an earlier document holds are cut out, found with suffix automata of reference shards.

A broadcast automaton of every shard would make each document pass by all shards, work that grows with the square of the corpus. So
passages are dealt to shards instead. A window of 13 words has a minimizer, the least hash of its six-word runs: equal
windows have equal minimizers. Passages that very many documents share are one reference shard that is broadcast: minimizers that are frequent
in a share of the documents show where they may stand, one aggregate over all documents gives their windows and the first document of each, and every document's
segments of such windows are streamed through the shard's automaton, so that no task gathers the places of a frequent passage. Of the others, only
runs of windows whose minimizer stands in several documents are candidates. Each goes to the shard of its minimizer; there a suffix automaton of the distinct candidates is built, each state knowing the first document that
holds it, and every candidate is streamed through it: where the matching statistic reaches the threshold and the first
document is an earlier one, the words are covered. Maximal spans of covered words are removed. Of documents with equal texts the
first alone takes part; the others are covered whole.

Candidates are chosen by hashes; the automata compare the words themselves.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, small
from .words import grams, hashed, ids, longs, texts

WINDOW, RUN = 13, 6
#: A minimizer of more candidates than this is dealt out by whole windows, so that a very common passage does not meet in one shard.
HOT = 5000
#: A minimizer is frequent if this many documents of every SAMPLE-th hold it. This decides only how windows travel: each other one goes to its minimizer's shard.
SAMPLE, OFTEN, MOST_KEYS = 64, 8, 50_000
#: The broadcast shard holds at most this many windows of frequent minimizers, those of most places; the rest are dealt out by whole windows.
SHARD_ROWS = 10_000
#: The spans are broadcast to the documents only if they were found to hold no more bytes and rows than this.
_END = 2**31 - 1
NONE = 1 << 63
SPAN_BYTES, SPAN_ROWS = 16_000_000, 200_000


class Automaton:
    """Suffix automaton of several sequences; each state holds the least document of the sequences that contain it."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [NONE]

    def _state(self, length: int, first: int, like: int = -1) -> int:
        self.next.append(dict(self.next[like]) if like >= 0 else {})
        self.link.append(self.link[like] if like >= 0 else 0)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.first[q], q)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list[int], doc: int) -> None:
        p = 0
        for c in words:
            q = self.next[p].get(c)
            if q is not None:
                p = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
                self.first[p] = min(self.first[p], doc)
                continue
            new, self_link = self._state(self.length[p] + 1, doc), 0
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self_link = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            self.link[new] = self_link
            p = new

    def close(self) -> None:
        """Let each state know the documents of the longer ones that end in it."""
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[v] >= 0:
                self.first[self.link[v]] = min(self.first[self.link[v]], self.first[v])

    def firsts(self, words: list[int], window: int) -> list[int]:
        """For each window of the words, the least document that holds it (or NONE)."""
        out, v, n = [], 0, 0
        for i, c in enumerate(words):
            while v and c not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if c in self.next[v]:
                v, n = self.next[v][c], n + 1
            while n > window and self.length[self.link[v]] >= window:  # the state that holds just the last `window` words
                v = self.link[v]
                n = self.length[v]
            if i >= window - 1:
                out.append(self.first[v] if n >= window else NONE)
        return out


def _least(g: np.ndarray, n: int) -> np.ndarray:
    """Where the least of every n values in a row stands, the first of equal ones."""
    place, width = np.arange(len(g)), 1
    while width < n:
        step = min(width, n - width)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(g[right] < g[left], right, left)
        width += step
    return place


def _runs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, minimizer, first window and number of windows of each run of windows with one minimizer place, for groups of texts.

    The texts of a group stand one behind another; windows across their ends are left out.
    """
    for first, edge, h in hashed(column):
        if len(h) < WINDOW:
            continue
        g = grams(h, RUN)
        place = _least(g, WINDOW - RUN + 1)
        new = np.concatenate([[True], place[1:] != place[:-1]])
        new[edge[:-1][edge[:-1] < len(new)]] = True
        starts = np.flatnonzero(new)
        row = np.searchsorted(edge, starts, "right") - 1
        n = np.minimum(np.append(starts[1:], len(place)), edge[row + 1] - WINDOW + 1) - starts
        own = np.flatnonzero(n > 0)
        starts, row = starts[own], row[own]
        yield first + row, g[place[starts]], starts - edge[row], n[own]


def _is_in(key: np.ndarray, often: np.ndarray) -> np.ndarray:
    if not len(often):
        return np.zeros(len(key), bool)
    return often[np.minimum(np.searchsorted(often, key), len(often) - 1)] == key


def _segments(key: np.ndarray, start: np.ndarray, n: np.ndarray, often: np.ndarray) -> list[tuple[int, int]]:
    """The longest stretches (first window, end) of windows with frequent minimizers."""
    turn = np.diff(np.concatenate([[0], _is_in(key, often).astype(np.int8), [0]]))
    first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) - 1
    return list(zip(start[first].tolist(), (start[last] + n[last]).tolist(), strict=True))


def _passages(batch: pa.RecordBatch, often: np.ndarray) -> Iterator[tuple[int, list[bytes], list[tuple[int, int]]]]:
    """Id, words and segments of each text that has windows with frequent minimizers."""
    doc_ids, column = ids(batch), batch.column(batch.schema.get_field_index("text"))
    for row, key, start, n in _runs(column):
        for r in np.unique(row[_is_in(key, often)]).tolist():
            a, b = np.searchsorted(row, [r, r + 1]).tolist()
            yield int(doc_ids[r]), column[r].as_py().split(), _segments(key[a:b], start[a:b], n[a:b], often)


def _frequent(docs: DataFrame) -> np.ndarray:
    """Minimizers that OFTEN documents of every SAMPLE-th hold, sorted; MOST_KEYS at most, those in most documents."""
    held = _placed(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0), np.zeros(0, np.uint64))
    many = held.groupBy("key").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") >= OFTEN)
    keys = [r["key"] for r in many.orderBy(F.desc("n"), "key").limit(MOST_KEYS).collect()]
    return np.sort(np.array(keys, np.int64).view(np.uint64))


def _shared_windows(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """words, first, n: the windows with frequent minimizers that several documents hold, the first of these and the number of places."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for doc_id, cut, segments in _passages(batch, often):
                for a, b in segments:
                    for i in range(a, b):
                        x = b" ".join(cut[i : i + WINDOW])
                        if x in seen:
                            had = seen[x]
                            had[0], had[1], had[2] = min(had[0], doc_id), max(had[1], doc_id), had[2] + 1
                        else:
                            seen[x] = [doc_id, doc_id, 1]
                if len(seen) >= 50_000:
                    yield rows(seen)
                    seen = {}
        if seen:
            yield rows(seen)

    def rows(seen: dict[bytes, list[int]]) -> pa.RecordBatch:
        columns = zip(*seen.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), *[pa.array(c, pa.int64()) for c in columns]], ["words", "first", "last", "n"])

    found = docs.mapInArrow(windows, "words binary, first bigint, last bigint, n bigint")
    return found.groupBy("words").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).where("first < last").drop("last")


def _streamed(docs: DataFrame, often: np.ndarray) -> tuple[DataFrame, DataFrame | None]:
    """Spans (doc_id, start, stop) that the broadcast shard covers, and the candidates of frequent minimizers that are not in it (none: all are)."""
    known = materialize(_shared_windows(docs, often))
    rest = known.count() > SHARD_ROWS
    shard = [(bytes(r["words"]), r["first"]) for r in known.orderBy(F.desc("n"), "words").limit(SHARD_ROWS).collect()]
    sent = docs.sparkSession.sparkContext.broadcast(shard)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, number = Automaton(), {}
        for x, first in sent.value:
            automaton.add([number.setdefault(w, len(number)) for w in x.split()], first)
        automaton.close()
        for batch in batches:
            out: list[tuple[int, int, int, bool]] = []
            for doc_id, cut, segments in _passages(batch, often):
                for a, b in segments:
                    span = None
                    for i, f in enumerate(automaton.firsts([number.get(w, -1) for w in cut[a : b + WINDOW - 1]], WINDOW), a):
                        if f < doc_id:
                            if span and i <= span[1]:
                                span[1] = i + WINDOW
                            else:
                                if span:
                                    out.append((doc_id, *span, True))
                                span = [i, i + WINDOW]
                        elif rest and f == NONE:
                            out.append((doc_id, i, i + 1, False))
                    if span:
                        out.append((doc_id, *span, True))
            if out:
                columns = zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.bool_()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["doc_id", "start", "stop", "covered"])

    found = docs.mapInArrow(stream, "doc_id bigint, start int, stop int, covered boolean")
    if not rest:
        return found.select("doc_id", "start", "stop"), None
    found = materialize(found)
    left = found.where("not covered").select("doc_id", "start", F.lit(1).alias("n"), F.lit(True).alias("hot"))
    return found.where("covered").select("doc_id", "start", "stop"), left


def _placed(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """key, doc_id, start, n: the runs of windows of every document, by minimizer, without those of frequent minimizers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = ids(batch)
            for row, key, start, n in _runs(batch.column(batch.schema.get_field_index("text"))):
                other = np.flatnonzero(~_is_in(key, often)) if len(often) else slice(None)
                columns = [longs(key[other]), longs(doc_ids[row[other]]), pa.array(start[other].astype(np.int32)), pa.array(n[other].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "start", "n"])

    return docs.mapInArrow(cut, "key bigint, doc_id bigint, start int, n int")


def _candidates(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """doc_id, start, n, hot: the runs of windows whose minimizer stands in several documents, without those of frequent minimizers."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        key, doc, start, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(4))
        del held
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(np.append(edge, len(key)))
        many = np.repeat(doc[edge] != doc[edge + counts - 1], counts)
        hot = np.repeat(counts > HOT, counts)[many]
        doc, start, n = doc[many], start[order][many], n[order][many]
        for at in range(0, len(doc), 200_000):
            part = slice(at, at + 200_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (doc, start, n, hot)], ["doc_id", "start", "n", "hot"])

    return _placed(docs, often).repartition("key").mapInArrow(shared, "doc_id bigint, start int, n int, hot boolean")


def _covered(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """doc_id, start, stop: words that windows cover which start in an earlier document too."""
    lists = candidates.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "n", "hot")).alias("c"))
    own = docs.join(lists, F.col("doc_id") == F.col("id")).select("doc_id", "text", "c")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            out: list[list] = [[], [], [], [], []]
            runs = batch.column(2)
            of = (h[a:b] for _, edge, h in hashed(batch.column(1)) for a, b in itertools.pairwise(edge.tolist()))
            for k, (doc_id, t, h) in enumerate(zip(ids(batch).tolist(), texts(batch), of, strict=True)):
                cut = t.split()
                g, whole = grams(h, RUN), grams(h, WINDOW)
                least = g[_least(g, WINDOW - RUN + 1)].tolist() if len(whole) else []
                c = runs[k].values
                for start, n, hot in zip(*[c.field(i).to_pylist() for i in range(3)], strict=True):
                    if start + n > len(whole):
                        continue  # of another row with this id
                    for a, b in [(i, 1) for i in range(start, start + n)] if hot else [(start, n)]:
                        key = int(whole[a]) if hot else least[a]
                        digest = hash((int(whole[a]), int(whole[a + b - 1]), b)) & (2**64 - 1)  # of numbers: alike on every machine
                        for x, v in zip(out, (key, digest, doc_id, a, None if digest in seen else b" ".join(cut[a : a + b + WINDOW - 1])), strict=True):
                            x.append(v)
                        seen.add(digest)
                if len(out[0]) >= 50_000:
                    yield rows(out)
                    out = [[], [], [], [], []]
                    seen.clear()
            if out[0]:
                yield rows(out)

    def rows(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [longs(np.array(out[0], np.uint64)), longs(np.array(out[1], np.uint64)), longs(np.array(out[2])), pa.array(out[3], pa.int32()), pa.array(out[4], pa.binary())],
            ["key", "digest", "doc_id", "start", "words"],
        )

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        key, digest, doc, start = (t.column(i).to_numpy() for i in range(4))
        words = t.column(4)
        order = np.lexsort((doc, digest, key))
        edges = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])).tolist()
        out: list[tuple[int, int, int]] = []
        for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
            own = order[a:b]
            group: dict[int, list[int]] = {}
            for i in own.tolist():
                group.setdefault(int(digest[i]), []).append(i)
            if len(group) == 1 and doc[own[0]] == doc[own[-1]]:
                continue
            number: dict[bytes, int] = {}
            content = {d: [number.setdefault(x, len(number)) for x in next(w.as_py() for w in (words[i] for i in rows_) if w.is_valid).split()] for d, rows_ in group.items()}
            least = {d: int(doc[rows_].min()) for d, rows_ in group.items()}
            automaton = Automaton()
            for d in sorted(group, key=least.__getitem__):
                automaton.add(content[d], least[d])
            automaton.close()
            for d, rows_ in group.items():
                first = automaton.firsts(content[d], WINDOW)
                for i in rows_:
                    me, at, last = int(doc[i]), int(start[i]), -1
                    for k, f in enumerate(first):
                        if f < me:
                            if last >= 0 and k <= last:
                                out[-1] = (me, out[-1][1], at + k + WINDOW)
                            else:
                                out.append((me, at + k, at + k + WINDOW))
                            last = k + WINDOW
            if len(out) >= 100_000:
                yield spans(out)
                out = []
        if out:
            yield spans(out)

    def spans(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "start", "stop"])

    routed = own.mapInArrow(dealt, "key bigint, digest bigint, doc_id bigint, start int, words binary").repartition("key")
    return routed.mapInArrow(matched, "doc_id bigint, start int, stop int")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept: every document's words without those that an earlier document's passage covers.

    Words are what stands between ASCII white space, unchanged; kept words are joined by one space. Null and empty texts have no words; texts of fewer
    than 13 words lose none. Rows without an id are left out. Of rows that repeat an id none is earlier than another, and each
    loses what is covered in any of them, so ids should be unique.
    """
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    hashed = materialize(own.where("text is not null").select("doc_id", F.sha2("text", 256).alias("h")))
    first = hashed.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = materialize(hashed.join(first, "h").where("doc_id > first").select(F.col("doc_id").alias("id")).distinct())
    alone = own.join(small(copies), F.col("doc_id") == F.col("id"), "left_anti")
    often = _frequent(alone)
    candidates, spans = _candidates(alone, often), None
    if len(often):
        spans, left = _streamed(alone, often)
        candidates = candidates.unionByName(left) if left is not None else candidates
    covered = _covered(alone, candidates)
    covered = covered.unionByName(spans) if spans is not None else covered
    found = covered.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "stop")).alias("c"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c in batch.column(1):
                edges = np.stack([c.values.field(0).to_numpy(), c.values.field(1).to_numpy()], axis=1)
                edges = edges[np.argsort(edges[:, 0], kind="stable")]
                reach = np.maximum.accumulate(edges[:, 1])
                new = np.concatenate([[True], edges[1:, 0] > reach[:-1]])
                begin = np.flatnonzero(new)
                out.append(np.stack([edges[begin, 0], reach[np.append(begin[1:], len(edges)) - 1]], axis=1).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "spans"])

    whole = np.array([0, _END], "<i4").tobytes()
    spans = found.mapInArrow(merged, "id bigint, spans binary").unionByName(copies.select("id", F.lit(whole).alias("spans")))
    spans = materialize(spans.groupBy("id").agg(F.max("spans").alias("spans")))
    size = spans.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("spans")), F.lit(0)).alias("b")).first()
    if size["n"] <= SPAN_ROWS and size["b"] <= SPAN_BYTES:
        spans = F.broadcast(spans)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, out = [], [], []
            for t, raw in zip(texts(batch), batch.column(2).to_pylist(), strict=True):
                words = t.split()
                n.append(len(words))
                if raw and len(words) >= WINDOW:
                    at, keep = 0, []
                    for a, b in np.frombuffer(raw, "<i4").reshape(-1, 2).tolist():
                        keep += words[at:a]
                        at = b
                    words = keep + words[at:]
                gone.append(n[-1] - len(words))
                out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    rows = own.join(spans, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(kept, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def plain(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """What the definition says, for tests on a few documents."""
    first: dict[tuple, int] = {}
    cut = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(cut):
        for k in range(len(cut[i]) - WINDOW + 1):
            first.setdefault(tuple(cut[i][k : k + WINDOW]), i)
    out = {}
    for i, w in cut.items():
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if first[tuple(w[k : k + WINDOW])] < i:
                gone.update(range(k, k + WINDOW))
        keep = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(keep)).hexdigest())
    return out

"""Bounded-space online packing of documents into sequences.

Each partition keeps a fixed number of open windows. A piece goes where it fits best; when none has room for it, the fullest
open window is filled up with the head of the piece and emitted, and the tail is placed anew. What is open at the end of a partition is merged
into full windows, and the rest of all partitions, less than one window each, is merged across them.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize
from .tokens import encoder

OPEN_WINDOWS = 64
_PIECE = [
    ("doc_id", pa.int64(), "bigint"),
    ("start", pa.int64(), "bigint"),
    ("length", pa.int64(), "bigint"),
    ("ids", pa.binary(), "binary"),
    ("ids_crc32", pa.int64(), "bigint"),
    ("doc_tokens", pa.int64(), "bigint"),
    ("sequence_id", pa.int64(), "bigint"),
    ("offset", pa.int64(), "bigint"),
    ("part", pa.int32(), "int"),
    ("rest", pa.bool_(), "boolean"),
]


class Packer:
    """The open windows of one partition. Pieces are (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, size: int, n_open: int) -> None:
        self.size, self.n_open = size, n_open
        self.windows: dict[int, list] = {}
        self.free: list[tuple[int, int]] = []  # (room, window), ascending
        self.count = 0

    def add(self, doc_id, ids: bytes) -> Iterator[list]:
        """Place a document; yields the windows that are full or given up."""
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            yield [(doc_id, at, ids[4 * at : 4 * (at + self.size)], total)]
            at += self.size
        while at < total:
            need = total - at
            k = bisect_left(self.free, (need, -1))
            if k < len(self.free):  # the least room that is enough
                room, w = self.free.pop(k)
                self.windows[w].append((doc_id, at, ids[4 * at :], total))
                if room == need:
                    yield self.windows.pop(w)
                else:
                    insort(self.free, (room - need, w))
                return
            if len(self.free) < self.n_open:
                self.windows[self.count] = [(doc_id, at, ids[4 * at :], total)]
                insort(self.free, (self.size - need, self.count))
                self.count += 1
                return
            room, w = self.free.pop(0)  # the fullest
            self.windows[w].append((doc_id, at, ids[4 * at : 4 * (at + room)], total))
            at += room
            yield self.windows.pop(w)

    def rest(self) -> Iterator[list]:
        """Merge the open windows, the fullest first: full ones, then at most one that is not."""
        now, held = [], 0
        for _, w in self.free:
            for doc_id, start, ids, total in self.windows[w]:
                while ids:
                    room = 4 * (self.size - held)
                    head, ids = ids[:room], ids[room:]
                    now.append((doc_id, start, head, total))
                    start += len(head) // 4
                    held += len(head) // 4
                    if held == self.size:
                        yield now
                        now, held = [], 0
        self.windows, self.free = {}, []
        if now:
            yield now


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 2048, n_open: int = OPEN_WINDOWS, ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of at most `size` ids (a power of two); a row per piece.

    Columns: doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens, sequence_id, offset, and with `ids`
    the ids as little-endian 32-bit numbers. Null or empty text leaves the end id alone. Every sequence holds `size` ids, but
    for the last few of the whole input, which hold powers of two, so nothing is padded. A null doc_id is carried along;
    rows that repeat an id are packed as documents of their own.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    spark = docs.sparkSession
    end = int(end_id).to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, packer, rows, done = encoder(tokenizer), Packer(size, n_open), [], 0

        def put(window: list) -> None:
            nonlocal done
            offset, full = 0, sum(len(p[2]) for p in window) == 4 * size
            for doc_id, start, raw, total in window:
                n = len(raw) // 4
                keep = raw if ids or not full else None
                rows.append((doc_id, start, n, keep, zlib.crc32(raw), total, (part << 32) + done, offset, part, not full))
                offset += n
            done += 1

        def flush() -> pa.RecordBatch:
            nonlocal rows
            cols, rows = list(zip(*rows, strict=True)), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(cols, _PIECE, strict=True)], [n for n, _, _ in _PIECE])

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, raw in zip(batch.column(0).to_pylist(), enc.encode_all(texts), strict=True):
                for window in packer.add(doc_id, raw + end):
                    put(window)
                if len(rows) >= 4000:
                    yield flush()
        enc.rest()
        if ids:  # batches of ids are large: what they took goes back to the system
            pa.default_memory_pool().release_unused()
        for window in packer.rest():
            put(window)
        if rows:
            yield flush()

    schema = ", ".join(f"{n} {t}" for n, _, t in _PIECE)
    made = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packed, schema))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if ids else [])]

    # less than one window of each partition is left: where it stands in the sequence of all of them
    rest = made.where("rest")
    sizes = rest.groupBy("part").agg(F.sum("length").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_of = F.sum("n").over(Window.partitionBy())
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), all_of.alias("all"))
    placed = rest.join(sizes, "part").withColumn("at", F.col("before") + F.col("offset"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                end_of_full = x["all"] - x["all"] % size
                start, raw, at = x["start"], x["ids"], x["at"]
                while raw:
                    if at < end_of_full:
                        k, offset, room = at // size, at % size, size - at % size
                    else:  # the tail in powers of two, the largest first
                        base, k, bit = end_of_full, end_of_full // size, size >> 1
                        while not (x["all"] % size & bit and at < base + bit):
                            if x["all"] % size & bit:
                                base, k = base + bit, k + 1
                            bit >>= 1
                        offset, room = at - base, base + bit - at
                    head, raw = raw[: 4 * room], raw[4 * room :]
                    n = len(head) // 4
                    rows.append((x["doc_id"], start, n, head, zlib.crc32(head), x["doc_tokens"], -1 - k, offset, x["part"], True))
                    start, at = start + n, at + n
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(cols, _PIECE, strict=True)], [n for n, _, _ in _PIECE])

    return made.where("not rest").select(out).unionByName(placed.mapInArrow(merged, schema).select(out))

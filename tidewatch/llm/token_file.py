"""Token-ID files: patched frame-of-reference blocks.

A segment holds the ids of consecutive documents. It is cut into blocks of 512 ids. Of each block the minimum is subtracted and
the rest packed at the bit width that a percentile of the block needs; ids that need more stand in the block's exception list.
An index of the blocks' byte offsets and one of the documents' ids and lengths make any range readable on its own.

Layout, little-endian: magic `TWT1`; u32 n_docs, n_ids, n_blocks; i64 doc ids (with a validity byte each); u32 lengths;
u32 n_blocks + 1 byte offsets of the blocks, counted from the first block; the blocks. Block: u32 minimum; u8 width, u8 0,
u16 n_exceptions; 64 * width bytes of packed values; u16 positions and u32 differences of the exceptions.

The segments are rows of a table that Spark writes (one binary value each), so that commits survive lost executors and any
store that Spark can write will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import work_dir
from .tokens import encoder

MAGIC, BLOCK, LANE = b"TWT1", 512, 64
#: The width of a block's packed values is what this share of its ids needs.
PERCENTILE = 0.95
SEGMENT_IDS = 1 << 18
#: Pieces that a worker remembers, twice over, also between its tasks: nothing else here needs the memory, and many recur in the next task.
KNOWN = 500_000

_SEGMENTS = "part int, seq int, first_doc_id bigint, n_docs bigint, n_ids bigint, payload binary"


def _packed(rows: np.ndarray, width: int) -> np.ndarray:
    """(n, 512) values below 2**width -> (n, 64 * width) bytes: each run of 64 values fills `width` 64-bit words."""
    n = len(rows)
    if not width:
        return np.zeros((n, 0), np.uint8)
    v = np.ascontiguousarray(rows.reshape(n * (BLOCK // LANE), LANE).T.astype(np.uint64))
    out = np.zeros((width, v.shape[1]), np.uint64)
    for i in range(LANE):
        word, shift = divmod(i * width, 64)
        out[word] |= v[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= v[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).view(np.uint8).reshape(n, LANE * width)


def _unpacked(raw: np.ndarray, width: int) -> np.ndarray:
    """The inverse of _packed."""
    n = len(raw)
    w = np.ascontiguousarray(raw.reshape(-1).view("<u8").reshape(n * (BLOCK // LANE), width).T) if width else None
    out = np.zeros((LANE, n * (BLOCK // LANE)), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 64)
        x = w[word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (w[word + 1] << np.uint64(64 - shift))
        out[i] = x & mask
    return np.ascontiguousarray(out.T).reshape(n, BLOCK).astype(np.uint32)


def write_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The bytes of a segment."""
    n_blocks = -(-len(ids) // BLOCK)
    full = np.zeros(n_blocks * BLOCK, np.uint32)
    full[: len(ids)] = ids
    if n_blocks:
        full[len(ids) :] = full[(n_blocks - 1) * BLOCK]
    rows = full.reshape(n_blocks, BLOCK)
    low = rows.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rows = rows - low[:, None]
    at = int(PERCENTILE * (BLOCK - 1))
    wide = np.partition(rows, at, axis=1)[:, at] if n_blocks else low
    width = np.array([int(x).bit_length() for x in wide.tolist()], np.int64)
    over = rows >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    blocks: list[bytes] = [b""] * n_blocks
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        body = _packed(np.where(over[own], 0, rows[own]), w)
        for k, b in enumerate(own.tolist()):
            where = np.flatnonzero(over[b])
            head = np.array([low[b]], "<u4").tobytes() + bytes([w, 0]) + np.array([len(where)], "<u2").tobytes()
            blocks[b] = head + body[k].tobytes() + where.astype("<u2").tobytes() + rows[b][where].astype("<u4").tobytes()
    starts = np.zeros(n_blocks + 1, "<u4")
    np.cumsum([len(b) for b in blocks], out=starts[1:])
    return b"".join(
        [
            MAGIC,
            np.array([len(doc_ids), len(ids), n_blocks], "<u4").tobytes(),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            bytes(x is not None for x in doc_ids),
            np.array(lengths, "<u4").tobytes(),
            starts.tobytes(),
            *blocks,
        ]
    )


class Segment:
    """Reads a segment's documents and any range of its ids."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        n_docs, self.n_ids, self.n_blocks = np.frombuffer(raw, "<u4", 3, 4).tolist()
        at = 16
        found = np.frombuffer(raw, "<i8", n_docs, at).tolist()
        valid = raw[at + 8 * n_docs : at + 9 * n_docs]
        self.doc_ids = [x if ok else None for x, ok in zip(found, valid, strict=True)]
        at += 9 * n_docs
        self.lengths = np.frombuffer(raw, "<u4", n_docs, at)
        at += 4 * n_docs
        self.starts = np.frombuffer(raw, "<u4", self.n_blocks + 1, at)
        self.raw, self.base = np.frombuffer(raw, np.uint8), at + 4 * (self.n_blocks + 1)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from start to stop; only their blocks are read."""
        stop = self.n_ids if stop is None else stop
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-stop // BLOCK)
        at = self.starts[a:b].astype(np.int64) + self.base
        heads = self.raw[at[:, None] + np.arange(8)]
        low, width = np.ascontiguousarray(heads[:, :4]).view("<u4")[:, 0], heads[:, 4].astype(np.int64)
        n_over = np.ascontiguousarray(heads[:, 6:8]).view("<u2")[:, 0].astype(np.int64)
        out = np.empty((b - a, BLOCK), np.uint32)
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            out[own] = _unpacked(self.raw[at[own][:, None] + 8 + np.arange(LANE * w)], w)
        for k in np.flatnonzero(n_over).tolist():
            n, body = int(n_over[k]), int(at[k] + 8 + LANE * width[k])
            where = self.raw[body : body + 2 * n].copy().view("<u2")
            out[k, where] = self.raw[body + 2 * n : body + 6 * n].copy().view("<u4")
        out += low[:, None]
        return out.reshape(-1)[start - a * BLOCK : stop - a * BLOCK]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of every document, `end_id` behind each, in ascending doc_id order as segments under `path`.

    Null text is empty, so such a document has the end id alone. Documents without an id come first. Documents that repeat an
    id stand side by side. `tokenizer`: a file of the tokenizers library.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer, KNOWN)
        held: list[bytes] = []
        doc_ids: list[int | None] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, doc_ids, n, seq
            lengths = [len(x) // 4 for x in held]
            payload = write_segment(doc_ids, lengths, np.frombuffer(b"".join(held), "<u4"))
            row = [[part], [seq], [doc_ids[0]], [len(doc_ids)], [n], [payload]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            held, doc_ids, n, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, types, strict=True)],
                ["part", "seq", "first_doc_id", "n_docs", "n_ids", "payload"],
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1).fill_null("")), strict=True):
                ids += end
                held.append(ids)
                doc_ids.append(doc_id)
                n += len(ids) // 4
                if n >= SEGMENT_IDS:
                    yield flush()
        if held:
            yield flush()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, _SEGMENTS).write.parquet(path)


def read_tokens(spark, path: str, ids: bool = False) -> DataFrame:
    """A row per document of the files under `path`: doc_id, start, n_tokens, ids_crc32, and with `ids` the ids themselves.

    `start` counts the ids of all documents before it; `ids_crc32` is the checksum of its ids as little-endian 32-bit numbers.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    schema = "part int, seq int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                s = Segment(payload)
                all_ids = s.ids()
                ends = np.cumsum(s.lengths, dtype=np.int64)
                starts = ends - s.lengths
                raw = memoryview(all_ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(sums)
                cols = [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.full(n, seq, np.int32)),
                    pa.array(s.doc_ids, pa.int64()),
                    pa.array(starts),
                    pa.array(s.lengths.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ]
                names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"]
                if ids:
                    offsets = np.concatenate([starts, ends[-1:]]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(all_ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = segments.select("part", "seq", "payload").mapInArrow(decode, schema)
    # one row for each quarter of a million ids: first the sums of the parts, then those within each part
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("of_part").over(order), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = segments.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside")).join(before, "part")
    return rows.join(base.withColumn("base", F.col("inside") + F.col("before_part")), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else [])
    )


def token_file(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, ids: bool = False) -> DataFrame:
    """Write `docs` as token files and return what read_tokens() finds in them; `path` lies in the shared folder by default."""
    path = path or work_dir(docs.sparkSession)
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path, ids)

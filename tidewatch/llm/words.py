"""Words, word hashes and shingle sets of whole texts, as numpy arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh64_intdigest

_MUL = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD
    x = x ^ (x >> np.uint64(32))
    x = x * _MUL
    return x ^ (x >> np.uint64(29))


class WordHash(dict):
    """64-bit hashes of words; remembers up to `limit` of them, then starts again, so memory stays bounded."""

    def __init__(self, limit: int = 300_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Bytes of text that are cut into words together.
GROUP = 2_000_000


def hashed(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For groups of a binary column's texts: the first row, where each row's words begin (and the last ones end), the hashes of all words.

    Words are what stands between ASCII white space; null is empty. The distinct words of a group are hashed once, as WordHash does.
    """
    sizes = pc.binary_length(column).fill_null(0).to_pylist()
    at = 0
    while at < len(sizes):
        to, held = at, 0
        while to < len(sizes) and held < GROUP:
            held += sizes[to]
            to += 1
        cut = pc.ascii_split_whitespace(column.slice(at, to - at).fill_null(b"").view(pa.string()))
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        number, edge = coded.indices.to_numpy(), cut.offsets.to_numpy().astype(np.int64)
        h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))[number]
        if b"" in words:  # before white space at the begin of a text, behind it at the end
            real = number != words.index(b"")
            h, edge = h[real], np.concatenate([[0], np.cumsum(real)])[edge]
        yield at, edge, h
        at = to


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n word hashes."""
    if len(words) < n:
        return words[:0]
    size = len(words) - n + 1
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = h * _MUL + words[i : i + size]
    return mix(h)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text counts as one shingle, an empty one has none."""
    if not len(words):
        return words
    return np.unique(grams(words, min(n, len(words))))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a binary column; null is empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def ids(batch: pa.RecordBatch, column: str = "doc_id") -> np.ndarray:
    return batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)


def longs(x) -> pa.Array:
    """A 64-bit column of a numpy array, unsigned values kept bit for bit."""
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else np.ascontiguousarray(x, dtype=np.int64), pa.int64())

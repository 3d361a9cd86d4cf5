"""Counts over trailing days for rows that come in order of key and second, a chunk at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

DAY = 86_400
#: Rows that are counted together.
CHUNK = 200_000
_NONE = np.zeros(0, np.int64)


class Frames:
    """What lies in the frames of the last key: rows by second, and the last second of each value. Both are bounded by the longest horizon.

    A key's rows are dealt out by spans of time (`bucket`); a span begins with the rows of the longest horizon before it. Times are counted from there, and
    keys stand one behind another on one axis (`place`), so that the frames of all rows of a chunk are found at once.
    """

    def __init__(self, days: list[int], span: int) -> None:
        self.horizons, self.span, self.longest = [d * DAY for d in days], span, max(days) * DAY
        self.width = span + 2 * self.longest + 2
        self.key: tuple | None = None
        self._forget()

    def _forget(self) -> None:
        self.at, self.rows, self.named = _NONE, _NONE, _NONE
        self.values: list[tuple[np.ndarray, pa.Array | None]] = [(_NONE, None), (_NONE, None)]

    def places(self, rows: pa.RecordBatch) -> np.ndarray:
        """Where each row stands: ascending."""
        edge = np.zeros(rows.num_rows, bool)
        for name in ("kind", "a", "b", "bucket"):
            c = rows.column(name)
            x = _codes(c) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else _filled(c)
            edge[1:] |= x[1:] != x[:-1]
        bucket = rows.column("bucket")
        at = np.where(_valid(bucket), _filled(rows.column("es")) - _filled(bucket) * self.span, 0) + self.longest
        return np.cumsum(edge) * self.width + at

    def count(self, rows: pa.RecordBatch, place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The rows that ask, and for each horizon their four counts. `rows` must end with a whole second of a key."""
        key = [tuple(rows.column(n)[i].as_py() for n in ("kind", "a", "b", "bucket")) for i in (0, rows.num_rows - 1)]
        if key[0] != self.key:
            self._forget()
        self.key = key[1]
        timed, own = _valid(rows.column("bucket")), _filled(rows.column("own")) == 1
        all_at = np.concatenate([self.at, place])
        weights = [np.concatenate([held, new.astype(np.int64)]) for held, new in ((self.rows, own & timed), (self.named, ~own & timed))]
        so_far = [np.concatenate([[0], np.cumsum(w)]) for w in weights]
        ask = np.flatnonzero(_valid(rows.column("row")))
        to = np.searchsorted(all_at, place[ask], "right")
        base = int(place[-1]) // self.width * self.width
        since = max(base, int(place[-1]) - self.longest)
        out: list[list[np.ndarray]] = []
        for h in self.horizons:
            lo = np.searchsorted(all_at, place[ask] - h, "left")
            out.append([c[to] - c[lo] for c in so_far])
        for k, name in enumerate(("couple", "couple_mobile")):
            for mine, counts in zip(out, self._distinct(k, rows.column(name), place, place[ask], timed, since, base), strict=True):
                mine.append(counts)
        kept = np.searchsorted(all_at, since, "left")
        self.at, first = np.unique(all_at[kept:] - base, return_index=True)
        self.rows, self.named = (np.add.reduceat(w[kept:], first) for w in weights)
        return ask, [c for mine in out for c in mine]

    def _distinct(self, k: int, values: pa.Array, place: np.ndarray, asked: np.ndarray, timed: np.ndarray, since: int, base: int) -> list[np.ndarray]:
        """Distinct values in the frames: a value enters with its row and leaves with the horizon, or where it comes anew."""
        new = np.flatnonzero(_valid(values) & timed)
        at, held = self.values[k]
        mine = values.take(pa.array(new))
        both = mine if held is None else pa.concat_arrays([held, mine])
        at = np.concatenate([at, place[new]])
        if not len(at):
            return [np.zeros(len(asked), np.int64) for _ in self.horizons]
        code, of = _codes(both), at // self.width
        order = np.lexsort((at, code, of))
        again = np.full(len(at), np.iinfo(np.int64).max)
        same = (code[order][1:] == code[order][:-1]) & (of[order][1:] == of[order][:-1])
        again[order[:-1][same]] = at[order[1:][same]]
        entered = np.searchsorted(at, asked, "right")
        out = [entered - np.searchsorted(np.sort(np.minimum(at + h + 1, again)), asked, "right") for h in self.horizons]
        kept = np.flatnonzero((again == np.iinfo(np.int64).max) & (at >= since))
        self.values[k] = (at[kept] - base, both.take(pa.array(kept)))
        return out


def _valid(c: pa.Array) -> np.ndarray:
    return c.is_valid().to_numpy(zero_copy_only=False)


def _filled(c: pa.Array) -> np.ndarray:
    return c.cast(pa.int64()).fill_null(np.iinfo(np.int64).min >> 1).to_numpy(zero_copy_only=False)


def _codes(c: pa.Array) -> np.ndarray:
    return c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


def counting(days: list[int], span: int, kept: list[str], names: list[str], chunk: int = CHUNK) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow over rows (kind, a, b, bucket, es, own, row, couple, couple_mobile, ...) that lie in order of key, bucket and second.

    Rows with a `row` get their counts (`names`) beside the `kept` columns. Rows count under `own` = 1 and are named under 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, held, n = Frames(days, span), [], 0

        def counted(rows: pa.RecordBatch, place: np.ndarray) -> pa.RecordBatch:
            ask, counts = frames.count(rows, place)
            at = pa.array(ask)
            return pa.RecordBatch.from_arrays([*[rows.column(c).take(at) for c in kept], *[pa.array(c, pa.int64()) for c in counts]], [*kept, *names])

        wanted = chunk
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= wanted:
                rows = _joined(held)
                place = frames.places(rows)
                cut = int(np.searchsorted(place, place[-1], "left"))  # the last second may go on
                if cut:
                    yield counted(rows.slice(0, cut), place[:cut])
                held, n = [rows.slice(cut)], rows.num_rows - cut
                wanted = max(chunk, 2 * n)
        if n:
            rows = _joined(held)
            yield counted(rows, frames.places(rows))

    return run


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

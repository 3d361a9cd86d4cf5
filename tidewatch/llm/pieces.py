"""SentencePiece BPE by a prefix table.

The encoding of a text is made of tokens of which every two neighbours, taken together, encode to just these two; and the encoding of a prefix
has one last token. So a table holds the last token of each prefix: an automaton of all pieces reports those that end at a
place, and the one that goes with the last token of the prefix in front of it is stored. The ids are then read backwards.

Texts are cut where no merge can cross: in front of a run of spaces, and around characters that no piece holds
(and between letters and others, if no piece holds both). What stands between such cuts recurs, so its ids are worked out once and remembered (two generations of a bounded number).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Remembered stretches and pairs of tokens in each of two generations.
STRETCHES, PAIRS = 300_000, 1_000_000
#: Longer stretches are not remembered.
LONG = 64
NEVER = float("-inf")


class Pieces:
    """Ids of texts as little-endian unsigned 32-bit bytes, begin and end ids included, and texts of ids."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=path)
        if m.normalize("a  b") != f"{SPACE}a{SPACE}{SPACE}b":
            raise ValueError(f"{path}: only models that keep white space and put one space in front are supported")
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(m.get_piece_size()):
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i)):
                self.ids[m.id_to_piece(i)] = i
                self.score[m.id_to_piece(i)] = m.get_score(i)
        self.text = {i: p for p, i in self.ids.items()}
        letters = set("".join(self.ids))
        if any(c not in self.ids for c in letters) or any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError(f"{path}: a piece holds a line end, a character that is no piece, or a space behind another character")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.letters = letters
        self.bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # a run of spaces with what follows it up to the next space or line end; where no piece does, no stretch holds letters beside others
        alpha = "".join(sorted(c for c in letters if c.isalpha()))
        mixed = any(a.isalpha() != b.isalpha() for p in self.ids for a, b in pairwise(p.lstrip(SPACE)))
        rest = rf"[^{SPACE}\n]+" if mixed or not alpha else rf"(?:[{alpha}]+|[^{alpha}{SPACE}\n]+)"
        self.cut = re.compile(f"{SPACE}*{rest}|{SPACE}+|\n")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[str, bool], list[tuple[str, float]] | None] = {}
        odd = "".join(map(re.escape, sorted(letters)))
        self.odd = re.compile(f"([^{odd}])")
        self.lengths = np.zeros(m.get_piece_size(), np.int64)
        for i, p in self.text.items():
            self.lengths[i] = len(p)
        self.ends = [np.array([i], "<u4").tobytes() for i in (m.bos_id(), m.eos_id())]

    def merged(self, text: str, to: int = 1) -> list[str]:
        """The parts of a short text by the merges themselves, until `to` are left: the best score first, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > to:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, piece: str, left: bool) -> list[tuple[str, float]] | None:
        """The parts that stand at an edge of a piece while it is merged, each with the score of the merge that takes it in.

        None if the piece is not its own encoding, or a part of it has no better score than what it is merged into.
        """
        key = (piece, left)
        if key not in self.edges:
            parts = self.merged(piece, 2)
            if len(piece) == 1:
                self.edges[key] = [(piece, NEVER)]
            elif len(parts) != 2 or any(len(p) > 1 and self.score[p] <= self.score[piece] or self.edge(p, left) is None for p in parts):
                self.edges[key] = None
            else:
                *inner, (part, _) = self.edge(parts[0 if left else 1], left)
                self.edges[key] = [*inner, (part, self.score[piece]), (piece, NEVER)]
        return self.edges[key]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay these two; a left one of -1 is the start.

        They don't if a part at the end of the left one and one at the start of the right one, which stand there at the same time, make up a
        piece with a better score than the merges that are to take these parts in.
        """
        key = (left + 1) << 32 | right
        found = self.pairs.get(key)
        if found is None:
            own = [self.text[i] for i in (left, right) if i >= 0]
            ends, starts = self.edge(own[0], False), self.edge(own[-1], True)
            found = self.merged("".join(own)) == own if len(own) == 1 or ends is None or starts is None else self._stay(ends, starts)
            if len(self.pairs) >= PAIRS:
                self.pairs = {}
            self.pairs[key] = found
        return found

    def _stay(self, ends: list[tuple[str, float]], starts: list[tuple[str, float]]) -> bool:
        i = j = 0
        while True:
            (x, next_x), (y, next_y) = ends[i], starts[j]
            both = self.score.get(x + y, NEVER)
            if both > next_x and both >= next_y and both > NEVER:
                return False
            if next_x == next_y == NEVER:
                return True
            if next_x >= next_y:
                i += 1
            else:
                j += 1

    def _tables(self, stretches: list[str]) -> list[bytes]:
        """The ids of stretches whose characters are all pieces: the tables of last tokens, place by place of all of them together, then backwards."""
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        text = "\n".join(stretches)  # a place more for each: the empty prefix
        empty = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        ends, ids = found[:, 0] + 1, found[:, 1]
        starts = ends - self.lengths[ids]
        depth = ends - empty[np.searchsorted(empty, starts, "right") - 1]
        order = np.argsort(depth, kind="stable")
        last = np.full(len(text) + 1, -2, np.int64)  # -2: no token ends here
        last[empty] = -1
        at, known, compatible = 0, self.pairs, self.compatible
        for n in np.bincount(depth)[1:].tolist():
            now = order[at : at + n]
            at += n
            before = last[starts[now]]
            now, before = now[before > -2], before[before > -2]
            keys = (before + 1) << 32 | ids[now]
            fine = [known.get(k) for k in keys.tolist()]
            fine = np.array([compatible((k >> 32) - 1, k & 0xFFFFFFFF) if f is None else f for f, k in zip(fine, keys.tolist(), strict=True)] if None in fine else fine, bool)
            last[ends[now[fine]]] = ids[now[fine]]
        token_ends, place, to = np.zeros(len(text) + 1, bool), empty + sizes, empty
        while len(place):
            token_ends[place] = True
            place = place - self.lengths[last[place]]
            place, to = place[place > to], to[place > to]
        counts = np.concatenate(([0], np.cumsum(token_ends)))
        raw = last[token_ends].astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(counts[empty + 1].tolist(), counts[empty + sizes + 1].tolist(), strict=True)]

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """The ids of stretches; those with characters that no piece holds, which become bytes, are put together from others."""
        whole = self.letters.issuperset
        plain, odd = [s for s in wanted if whole(s)], [s for s in wanted if not whole(s)]
        parts = {s: [x for x in self.odd.split(s) if x] for s in odd}
        plain = list({*plain, *(x for cut in parts.values() for x in cut if whole(x))})
        own = dict(zip(plain, self._tables(plain), strict=True)) if plain else {}
        for s, cut in parts.items():
            own[s] = b"".join([own[x] if whole(x) else np.array([self.bytes[b] for b in x.encode()], "<u4").tobytes() for x in cut])
        return own

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) >= STRETCHES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set().union(*cut).difference(known)
        for s in [s for s in new if s in older]:
            known[s] = older[s]
        own = self._learn(new.difference(known))
        known.update((s, ids) for s, ids in own.items() if len(s) <= LONG)
        begin, end = self.ends
        long = {s: ids for s, ids in own.items() if len(s) > LONG}
        if long:
            return [b"".join([begin, *[known[s] if s in known else long[s] for s in parts], end]) for parts in cut]
        return [b"".join([begin, *map(known.__getitem__, parts), end]) for parts in cut]

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """The worker's own, kept between its tasks."""
    return Pieces(path)


#: Texts of about so many characters leave a task together.
BATCH = 2_000_000


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit, as one binary value) of every whole text, with the begin and end ids.

    A null text is an empty one, of which only the begin and end ids are left. Rows that repeat an id, or have none, are each encoded for themselves.
    Other columns, whatever their names, are left out; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for batch in batches:
            at, texts = 0, batch.column(1)
            while at < len(batch):
                part, held, since = [], 0, at
                while at < len(batch) and held < BATCH:
                    part.append(texts[at].as_py() or "")
                    held += len(part[-1])
                    at += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(since, at - since), pa.array(own.encode(part), pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and text of rows of ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for batch in batches:
            at, held_ids = 0, batch.column(1)
            while at < len(batch):
                out, held, since = [], 0, at
                while at < len(batch) and held < BATCH:
                    ids = held_ids[at].as_py()
                    out.append(None if ids is None else own.decode(ids))
                    held += len(ids or b"")
                    at += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(since, at - since), held_ids.slice(since, at - since), pa.array(out, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("binary").alias("ids")).mapInArrow(run, "doc_id bigint, ids binary, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the hashes of ids and decoded text of what `decode` returns; nulls have null hashes and no tokens, repeated ids stay rows of their own."""
    n = F.coalesce(F.octet_length("ids") / 4, F.lit(0)).cast("long")
    return decoded.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))

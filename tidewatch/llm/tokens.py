"""Token ids of whole texts with a public tokenizer file, piece by piece with a bounded memory of pieces.

A byte-level BPE never joins a piece that a space starts with what stands before it: the text cut in front of every single
space that a non-space follows gives, piece by piece, the ids of the whole text. Distinct pieces recur, so each is encoded once.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Between a Latin letter and one of these marks, or around a lone line end, a piece ends whatever stands around it.
_LETTER, _MARK = "A-Za-zÀ-ÖØ-öø-ÿ", r".,!?;:|*%$"
_FINER = re.compile(
    rf"(?<=[{_LETTER}])(?=[{_MARK}\n])|(?<=[{_MARK}])(?=[\n{_LETTER}])|(?<=[{_LETTER}{_MARK}]\n)(?=[{_LETTER}])"
)
#: Pieces that can stand side by side in one text with a separator between them.
_PLAIN = re.compile(rf" ?(?:[{_LETTER}]+|[.,!?;:*%$]+)")


#: Pieces that a worker remembers in a task, twice over, and as many finer ones: about 200 bytes each. One generation outlives the task.
LIMIT = 300_000
#: Pieces that are encoded in one text: the library takes longer for each where a text holds very many.
SIDE_BY_SIDE = 100
#: Bytes of text whose pieces are learned together.
GROUP = 1_000_000


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def encoder(path: str, limit: int = LIMIT) -> Encoder:
    """The worker's own encoder, kept between its tasks."""
    return Encoder(path, limit)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. Two generations of at most `limit` pieces are remembered.

    A text that holds the string of an added token (such as an end mark) is encoded as a whole: the library gives that string its own id.
    """

    def __init__(self, path: str, limit: int = LIMIT) -> None:
        self.path, self.limit = path, limit
        added = [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, bytes] = {}  # by the part behind a space
        self.older: dict[str, bytes] = {}
        self.exact: dict[str, bytes] = {}  # by the piece itself
        vocabulary = _tokenizer(path).get_vocab(with_added_tokens=False)
        size = max(vocabulary.values()) + 1
        #: Which ids end a word, or else which stand for a leading space: either tells where a piece among others ends.
        self.ends, self.starts = np.zeros(size, bool), np.zeros(size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.starts[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.worded = bool(self.ends.any())
        line = [] if self.worded else self._ids("\n")
        self.line = line[0] if len(line) == 1 else -1

    def _ids(self, text: str) -> list[int]:
        return self._each([text])[0]

    def _each(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, by the library's call that keeps no offsets."""
        return [x.ids for x in _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, pieces: list[str]) -> list[bytes]:
        """The ids of plain pieces, all with a space in front or all without, encoded side by side."""
        spaced = pieces[0][:1] == " "
        parts = [pieces[at : at + SIDE_BY_SIDE] for at in range(0, len(pieces), SIDE_BY_SIDE)]
        between = "" if spaced else " " if self.worded else "\n"
        found = self._each([between.join(part) for part in parts])
        return [x for part, ids in zip(parts, found, strict=True) for x in self._apart(part, np.array(ids, "<u4"), spaced)]

    def _apart(self, part: list[str], ids: np.ndarray, spaced: bool) -> list[bytes]:
        """The ids of each piece among those of their text."""
        if not spaced and not self.worded:
            ends = np.flatnonzero(ids == self.line)
            raw, cuts = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
            if len(cuts) == len(part) + 1:
                return [raw[4 * a + 4 : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
            cuts = []
        elif self.worded:
            cuts = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
        else:
            cuts = [*np.flatnonzero(self.starts[ids]).tolist(), len(ids)]
        if len(cuts) != len(part) + 1 or cuts[0] or cuts[-1] != len(ids):
            return [np.array(self._ids(p), "<u4").tobytes() for p in part]
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learn(self, wanted: list[str]) -> None:
        """Put the ids of these pieces into `exact`; those that can stand side by side are encoded together."""
        if len(self.exact) > self.limit:
            self.exact = {}
        exact, known = self.exact, self.known
        new = [p for p in dict.fromkeys(wanted) if p not in exact]
        for p in new:
            if p[:1] == " " and p[1:] in known:
                exact[p] = known[p[1:]]
        new = [p for p in new if p not in exact]
        plain = [p for p in new if _PLAIN.fullmatch(p)]
        for spaced in (True, False) if self.worded or self.line >= 0 else (True,):
            own = [p for p in plain if (p[0] == " ") == spaced]
            for at in range(0, len(own), 2000):
                part = own[at : at + 2000]
                exact.update(zip(part, self._together(part), strict=True))
        new = [p for p in new if p not in exact]
        for p, ids in zip(new, self._each(new), strict=True):
            exact[p] = np.array(ids, "<u4").tobytes()

    def rest(self) -> None:
        """Between tasks only the newest generation is kept."""
        self.older, self.exact = {}, {}

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text; the pieces of a bounded number of bytes are learned together."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        out: list[bytes] = []
        sizes = pc.binary_length(texts).to_pylist()
        at = 0
        while at < len(texts):
            to, held = at, 0
            while to < len(texts) and held < GROUP:
                held += sizes[to]
                to += 1
            out += self._group(texts.slice(at, to - at))
            at = to
        return out

    def _group(self, texts: pa.Array) -> list[bytes]:
        """What stands behind a space is numbered by its place among the distinct parts; these are looked up once, and their ids taken by number."""
        alone = [bool(self.added and self.added.search(t)) for t in texts.to_pylist()] if self.added else [False] * len(texts)
        cut = pc.split_pattern(pc.if_else(pa.array(alone), "", texts) if any(alone) else texts, " ")
        coded = cut.values.dictionary_encode()
        edge, number, parts = cut.offsets.to_numpy(), coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        behind = np.ones(len(number), bool)
        behind[edge[:-1]] = False
        used = np.zeros(len(parts), bool)
        used[number[behind]] = True
        ids = np.full(len(parts), None, object)
        ids[used] = self._meet(parts[used].tolist())
        odd = used & np.array([x is None for x in ids.tolist()], bool)  # white space behind a space
        strange = np.logical_or.reduceat(odd[number] & behind, edge[:-1]).tolist()
        taken = pa.array(ids, pa.large_binary()).take(coded.indices)
        raw, ends = memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1)
        out: list[bytes] = []
        spans = zip(self._whole(parts[number[edge[:-1]]].tolist()), ends[edge[:-1] + 1].tolist(), ends[edge[1:]].tolist(), strict=True)
        for i, (head, a, b) in enumerate(spans):
            if alone[i]:
                out.append(np.array(self._ids(texts[i].as_py()), "<u4").tobytes())
            elif strange[i]:
                out.append(self._odd(*texts[i].as_py().split(" ")))
            else:
                out.append(head + raw[a:b])
        return out

    def _meet(self, parts: list[str]) -> list[bytes | None]:
        """The ids of distinct parts behind a space; what is new is learned. What starts with white space, or is empty, is no piece."""
        if len(self.known) >= self.limit:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = [known.get(p) for p in parts]
        missing = [i for i, ids in enumerate(found) if ids is None]
        words, others = [], []
        for i in missing:
            p = parts[i]
            ids = older.get(p)
            if ids is not None:
                known[p] = ids
            elif p.isalpha():
                words.append(p)
            elif p and not p[0].isspace():
                others.append(p)
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            known.update(zip(part, self._together([" " + p for p in part]), strict=True))
        if others:
            finer = [_FINER.split(" " + p) for p in others]
            self._learn([x for cut in finer for x in cut])
            exact = self.exact
            for p, cut in zip(others, finer, strict=True):
                known[p] = b"".join([exact[x] for x in cut])
        for i in missing:
            found[i] = known.get(parts[i])
        return found

    def _odd(self, first: str, *parts: str) -> bytes:
        """A text with white space behind a space: a part is cut off only where a non-space follows the space."""
        out = [first]
        for p in parts:
            if p and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return b"".join(self._whole(out))

    def _whole(self, found: list[str]) -> list[bytes]:
        cuts = [_FINER.split(p) for p in found]
        self._learn([x for cut in cuts for x in cut])
        return [b"".join([self.exact[x] for x in cut]) for cut in cuts]


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)

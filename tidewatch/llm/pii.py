"""Personal data in whole texts: rules, and a character-level bidirectional LSTM with CRF transitions that adds to them.

The network is trained in numpy on labelled spans of a bounded sample of documents: the rules' spans as they stand, and the same ones written as
the rules don't know them (spelled or bracketed marks, other separators, no plus sign), so that it learns kinds and not the patterns. It reads overlapping
windows of a text, each window is decoded with the transitions, and the windows' spans are reconciled over the whole document: a span that a
window's edge cuts is left to the neighbour that sees it whole, the more certain of two that overlap wins, and one that overlaps a span of the
rules, is uncertain, or fails the check of its kind is dropped. In every way of writing that is learned each kind holds a digit, an @, or one of the marks
dealt out in training (the word at with a dotted domain behind it); a window with none of these is not read.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in their order and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match starts where a run of digits does
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TRIGGER = re.compile(r"[0-9@]")
#: Ways to write the marks of a span, as they are dealt out in training; the check of a found span reads the same ones.
_AT, _DOT = (" @ ", " at ", " (at) ", "(at)", " [at] ", "[at]"), (" dot ", " (dot) ", "[.]", "(.)", " [dot] ")
_GAPS = (".", "/", " / ", "  ", "_", " - ", "-", " ")
_ANY_DOT = "|".join(map(re.escape, _DOT))
#: What a window must hold to be read: a digit, an @, or any of these marks; the word at counts where a domain with a dot in any writing follows.
_READ = re.compile("[0-9@]|" + "|".join(re.escape(m) + (rf"(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9]|{_ANY_DOT}))" if m == " at " else "") for m in (*_AT, *_DOT)))
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Documents that the network may be trained on at most (about; chosen by a hash of the id).
SAMPLE_DOCS = 3000
#: Windows of a document that it is trained on at most, evenly spread.
SAMPLE_WINDOWS = 64
WINDOW, STRIDE = 96, 48
CERTAIN = 0.9
#: Symbols: printable ASCII, then other letters, other white space, all else; 0 pads.
_N_SYMBOLS = 99
_N_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind: str, text: str) -> bool:
    """Whether a text passes the check of its kind."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))
    digits = _NOT_DIGIT.sub("", text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the local part, an @ and a dotted domain, without trying a long run of letters again and again."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def rules(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the patterns, leftmost and not overlapping within a kind, by start and then kind."""
    if not _TRIGGER.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if holds(KINDS[k], m.group())]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


_TABLE = np.full(0x3000, 98, np.uint8)
_TABLE[[i for i in range(0x3000) if chr(i).isalpha()]] = 96
_TABLE[[i for i in range(0x3000) if chr(i).isspace()]] = 97
_TABLE[32:127] = np.arange(1, 96)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _TABLE[np.minimum(points, 0x2FFF)]


def windows(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit, an @, or another mark of a span."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    wanted: set[int] = set()
    for m in _READ.finditer(text):
        k = m.start() // STRIDE
        wanted.update((min(k, last), min(max(k - 1, 0), last)))
    return [k * STRIDE for k in sorted(wanted)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """The network: embedding, one LSTM each way, tag scores, CRF transitions."""

    def __init__(self, embed: int = 12, hidden: int = 20, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {"E": rng.normal(0, 0.3, (_N_SYMBOLS, embed)), "T": np.zeros((_N_TAGS, _N_TAGS)), "O": rng.normal(0, 0.2, (2 * hidden, _N_TAGS)), "o": np.zeros(_N_TAGS)}
        for way in "fb":
            self.p[f"W{way}"] = rng.normal(0, 0.25, (embed + hidden, 4 * hidden))
            self.p[f"w{way}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        # what no tag sequence may hold: an inside that no begin or inside of its kind stands before
        self.barred = np.zeros((_N_TAGS, _N_TAGS))
        for k in range(len(KINDS)):
            self.barred[:, 2 + 2 * k] = -1e4
            self.barred[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0

    def _lstm(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """x: (time, batch, embed). The outputs, and what the way back needs."""
        n, h = self.hidden, np.zeros((x.shape[1], self.hidden))
        c, w, b = h, self.p[f"W{way}"], self.p[f"w{way}"]
        out, kept = np.empty((x.shape[0], x.shape[1], n)), [None] * x.shape[0]
        for t in range(x.shape[0]) if way == "f" else range(x.shape[0] - 1, -1, -1):
            joined = np.concatenate([x[t], h], axis=1)
            z = joined @ w + b
            gates, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            before, c = c, gates[:, n : 2 * n] * c + gates[:, :n] * g
            s = np.tanh(c)
            h = gates[:, 2 * n :] * s
            out[t] = h
            if keep:
                kept[t] = (joined, gates, g, before, s)
        return out, kept

    def _lstm_back(self, d_out: np.ndarray, kept: list, way: str, grad: dict) -> np.ndarray:
        n, w = self.hidden, self.p[f"W{way}"]
        d_x = np.empty((d_out.shape[0], d_out.shape[1], w.shape[0] - n))
        dh, dc = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
        for t in range(d_out.shape[0] - 1, -1, -1) if way == "f" else range(d_out.shape[0]):
            joined, gates, g, before, s = kept[t]
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            grad[f"W{way}"] += joined.T @ dz
            grad[f"w{way}"] += dz.sum(axis=0)
            d_joined = dz @ w.T
            d_x[t], dh, dc = d_joined[:, :-n], d_joined[:, -n:], dc * f
        return d_x

    def _scores(self, x: np.ndarray, keep: bool = False):
        e = self.p["E"][x.T]
        f, kf = self._lstm(e, "f", keep)
        b, kb = self._lstm(e, "b", keep)
        both = np.concatenate([f, b], axis=2)
        return both @ self.p["O"] + self.p["o"], (both, kf, kb)

    def _marginals(self, s: np.ndarray):
        """Forward and backward sums: the log of the partition and each place's tag probabilities."""
        t = self.p["T"] + self.barred
        first = np.zeros(_N_TAGS)
        first[2::2] = -1e4
        a, b = np.empty_like(s), np.zeros_like(s)
        a[0] = s[0] + first
        for k in range(1, len(s)):
            a[k] = s[k] + _log_sum(a[k - 1][:, :, None] + t, 1)
        for k in range(len(s) - 2, -1, -1):
            b[k] = _log_sum(t + (s[k + 1] + b[k + 1])[:, None, :], 2)
        z = _log_sum(a[-1], 1)
        return a, b, z, np.exp(a + b - z[None, :, None])

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags y of the windows x, and its gradient."""
        s, (both, kf, kb) = self._scores(x, True)
        a, b, z, m = self._marginals(s)
        n, tags = x.shape[0], y.T
        at = np.arange(n)
        gold = sum(s[k, at, tags[k]].sum() for k in range(len(s)))
        t = self.p["T"] + self.barred
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        for k in range(1, len(s)):
            gold += t[tags[k - 1], tags[k]].sum()
            pair = np.exp(a[k - 1][:, :, None] + t + (s[k] + b[k])[:, None, :] - z[:, None, None])
            grad["T"] += pair.sum(axis=0)
            np.add.at(grad["T"], (tags[k - 1], tags[k]), -1)
        d = m
        for k in range(len(s)):
            d[k, at, tags[k]] -= 1
        grad["o"] = d.sum(axis=(0, 1))
        grad["O"] = np.einsum("tbh,tbk->hk", both, d)
        d_both = d @ self.p["O"].T
        d_e = self._lstm_back(d_both[:, :, : self.hidden], kf, "f", grad) + self._lstm_back(d_both[:, :, self.hidden :], kb, "b", grad)
        np.add.at(grad["E"], x.T, d_e)
        return float(z.sum() - gold) / n, {k: v / n for k, v in grad.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 280, batch: int = 48, rate: float = 0.02, seed: int = 5) -> None:
        """Adam on random batches; half of each batch holds spans. Digits inside spans are dealt anew each time."""
        rng = np.random.default_rng(seed)
        with_span = np.flatnonzero(y.any(axis=1))
        if not len(with_span):
            return
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for k in range(1, steps + 1):
            rows = np.concatenate([rng.choice(with_span, batch // 2), rng.integers(0, len(x), batch - batch // 2)])
            own, tags = x[rows].copy(), y[rows]
            digit = (own >= 17) & (own <= 26) & (tags > 0)
            own[digit] = rng.integers(17, 27, int(digit.sum()))
            _, grad = self.step(own, tags)
            now = rate * min(1.0, 2.0 * (1 - k / (steps + 1)))
            for name, g in grad.items():
                g = np.clip(g, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                self.p[name] -= now * (first[name] / (1 - 0.9**k)) / (np.sqrt(second[name] / (1 - 0.99**k)) + 1e-8)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tag sequence of each window, and each tag's probability."""
        s, _ = self._scores(x)
        *_, m = self._marginals(s)
        t = self.p["T"] + self.barred
        best = s[0].copy()
        best[:, 2::2] -= 1e4
        back = np.empty(s.shape, np.int64)
        for k in range(1, len(s)):
            paths = best[:, :, None] + t
            back[k] = paths.argmax(axis=1)
            best = paths.max(axis=1) + s[k]
        tags, at = np.empty(s.shape[:2], np.int64), np.arange(x.shape[0])
        tags[-1] = best.argmax(axis=1)
        for k in range(len(s) - 1, 0, -1):
            tags[k - 1] = back[k, at, tags[k]]
        sure = np.take_along_axis(m, tags[:, :, None], 2)[:, :, 0]
        return tags.T, sure.T

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """The spans that the network finds in each text, reconciled over its windows."""
        where: list[tuple[int, int]] = [(i, s) for i, t in enumerate(texts) for s in windows(t)]
        found: list[list[tuple[float, str, int, int]]] = [[] for _ in texts]
        for at in range(0, len(where), 512):
            part = where[at : at + 512]
            x = np.zeros((len(part), WINDOW), np.uint8)
            for k, (i, s) in enumerate(part):
                own = symbols(texts[i][s : s + WINDOW])
                x[k, : len(own)] = own
            tags, sure = self.decode(x)
            for k in np.flatnonzero(tags.any(axis=1)).tolist():
                i, s = part[k]
                n = len(texts[i])
                for kind, a, b in _of_tags(tags[k]):
                    if (a > 0 or s == 0) and (b < WINDOW or s + b >= n) and s + b <= n:
                        found[i].append((float(sure[k, a:b].mean()), kind, s + a, s + b))
        out = []
        for spans in found:
            kept: list[tuple[str, int, int]] = []
            for sure_of, kind, a, b in sorted(spans, key=lambda x: (-x[0], x[2], x[3], x[1])):
                if sure_of >= CERTAIN and all(b <= c or a >= d for _, c, d in kept):
                    kept.append((kind, a, b))
            out.append(sorted(kept, key=lambda x: x[1]))
        return out


def _of_tags(tags: np.ndarray) -> list[tuple[str, int, int]]:
    out, start, n = [], -1, len(tags)
    for i in range(n + 1):
        tag = int(tags[i]) if i < n else 0
        if start >= 0 and (tag != int(tags[start]) + 1):
            out.append((KINDS[(int(tags[start]) - 1) // 2], start, i))
            start = -1
        if tag % 2:
            start = i
    return out


def _written(kind: str, text: str, rng: random.Random) -> str:
    """A span of the rules, written in another way; its letters and digits may change."""
    if kind == "email":
        text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if c.islower() and rng.random() < 0.5 else c for c in text)
        at, dot = rng.choice((*_AT, "@")), rng.choice((*_DOT, "."))
        local, domain = text.split("@")
        return local + at + domain.replace(".", dot if at != "@" or dot != "." else " dot ")
    if kind == "ip":
        return text.replace(".", rng.choice(_DOT))
    digits = _NOT_DIGIT.sub("", text)
    gap, size = rng.choice(_GAPS), rng.choice((2, 3, 4)) if kind == "phone" else 4
    groups = gap.join(digits[i : i + size] for i in range(0, len(digits), size))
    if kind == "card":
        return groups
    return rng.choice(("", "00", "(", "+")) + (groups if rng.random() < 0.7 else text.lstrip("+"))


def varied(text: str, spans: list[tuple[str, int, int]], seed: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with each span written in another way, and the spans where they stand then; of spans that overlap the first counts."""
    rng, at, parts, out, n = random.Random(seed), 0, [], [], 0
    for kind, a, b in spans:
        if a < at:
            continue
        new = _written(kind, text[a:b], rng)
        if new.startswith("(") and kind == "phone":
            new = f"({new[1:4]}) {new[4:]}"
        parts += [text[at:a], new]
        n += a - at
        out.append((kind, n, n + len(new)))
        n, at = n + len(new), b
    return "".join([*parts, text[at:]]), out


def labelled(texts: list[str], noise: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Windows of texts, and the tags of the labelled spans that lie wholly in them; with `noise` those of the varied texts too."""
    xs, ys = [], []
    for text in texts:
        spans = rules(text)
        forms = [(text, spans)]
        if noise and spans:
            forms += [varied(text, spans, zlib.crc32(text.encode("utf-8", "surrogatepass")) + k) for k in range(2)]
        for own_text, own_spans in forms:
            starts = windows(own_text)
            for s in starts[:: -(-len(starts) // SAMPLE_WINDOWS) or 1]:
                x, y = np.zeros(WINDOW, np.uint8), np.zeros(WINDOW, np.int64)
                own = symbols(own_text[s : s + WINDOW])
                x[: len(own)] = own
                whole = True
                for kind, a, b in own_spans:
                    if a < s + WINDOW and b > s:
                        if a >= s and b <= s + WINDOW and not y[a - s : b - s].any():
                            y[a - s], y[a - s + 1 : b - s] = 1 + 2 * KINDS.index(kind), 2 + 2 * KINDS.index(kind)
                        elif not (a >= s and b <= s + WINDOW):
                            whole = False
                if whole:
                    xs.append(x)
                    ys.append(y)
    return (np.array(xs), np.array(ys)) if xs else (np.zeros((0, WINDOW), np.uint8), np.zeros((0, WINDOW), np.int64))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Tagger:
    """Train on the windows of a bounded sample of the documents that hold a digit or an @; their spans are those of the rules, and varied forms of them.

    Null texts are passed over; with nothing to learn from, nothing is added.
    """
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike("[0-9@]"))
    n = docs.count()
    spread = 1 << 30
    chosen = held.where(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < min(spread, int(spread * sample_docs / max(n, 1))))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = labelled([t.as_py() for t in batch.column(0)])
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.astype(np.uint8).tobytes() for r in y], pa.binary())], ["x", "y"])

    rows = sorted((bytes(r["x"]), bytes(r["y"])) for r in chosen.select("text").mapInArrow(extract, "x binary, y binary").collect())
    tagger = Tagger()
    if rows:
        tagger.fit(np.array([np.frombuffer(a, np.uint8) for a, _ in rows]), np.array([np.frombuffer(b, np.uint8) for _, b in rows]).astype(np.int64))
    else:
        tagger.p["o"][0] = 50.0  # nothing to learn from: nothing is added
    return tagger


def find(text: str, tagger_spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The rules' spans and those of the network that overlap none of them and pass the check of their kind."""
    added = [x for x in tagger_spans if all(x[2] <= a or x[1] >= b for _, a, b in base) and _plausible(x[0], text[x[1] : x[2]])]
    return sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0])))


_MARK_AT, _MARK_DOT = re.compile(r"\s*(?:@|[(\[]at[)\]]|\bat\b)\s*"), re.compile(r"\s*(?:[(\[]dot[)\]]|\bdot\b|[(\[]\.[)\]])\s*")
_WHOLE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z-]{2,}"), "ip": re.compile(r"[0-9]+(\.[0-9]+){3}"), "card": re.compile(r"[0-9]([\x20./_-]{0,3}[0-9])+"), "phone": re.compile(r"\+?[0-9(][\x20()./_0-9-]+[0-9]")}


def _plausible(kind: str, text: str) -> bool:
    """Whether a span, its marks read in any known way of writing, may be what the network takes it for."""
    if kind in ("email", "ip"):
        text = _MARK_DOT.sub(".", text)
        text = _MARK_AT.sub("@", text, count=1) if kind == "email" else text
    if not _WHOLE[kind].fullmatch(text) or not holds(kind, text):
        return False
    # a number without any mark of a phone is none
    return kind != "phone" or text[0] in "+(" or text.startswith("00") or len(re.findall(r"[^0-9]+", text)) >= 2


def detect(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end in code points) of every row; null text is empty and has none.

    Rows that repeat an id are judged each for itself; texts of any length are read whole; spans that start alike stand by kind.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows_of(spans: list) -> list:
        return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [rules(t) for t in texts]
            own = tagger.spans(texts)
            spans = [find(t, s, b) for t, s, b in zip(texts, own, base, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([rows_of(b) for b in base], span), pa.array([rows_of(s) for s in spans], span)], ["doc_id", "base", "spans"]
            )

    kinds = "array<struct<kind string, start bigint, end bigint>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(detected, f"doc_id bigint, base {kinds}, spans {kinds}")


def redact(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; other columns stay.

    A null text stays null, an empty one empty; of spans that overlap the first is named and both are taken out. Rows that repeat an id are judged each for itself.
    """
    names = docs.columns

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            full = [t or "" for t in texts]
            out = []
            for t, raw, own in zip(full, texts, tagger.spans(full), strict=True):
                at, parts = 0, []
                for kind, a, b in find(t, own, rules(t)):
                    if a >= at:
                        parts += [t[at:a], f"[{kind}]"]
                    at = max(at, b)
                out.append(None if raw is None else "".join([*parts, t[at:]]))
            k = names.index("text")
            yield batch.set_column(k, "text", pa.array(out, batch.column(k).type))

    return docs.mapInArrow(replaced, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, and the spans as text: kind:start:end, comma-joined."""
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))

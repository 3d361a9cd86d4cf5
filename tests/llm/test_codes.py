"""SentencePiece, vector codes and hard negatives against the library and plain versions: nulls, ties, repeats, odd sizes, empty tables."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import hard_negatives, pieces, queries, vector_codes
from tidewatch.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, v string, row int, code int, error int, score int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3, 4) for i, v, label in rows], VECTORS)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))


@pytest.mark.parametrize("letters", ["a ", "the in", " \n\ta", "▁ a", "éü한😀 a\x00́", "aaaa", "01 .,;!-=*#/²½", "abcdefghijklmnopqrstuvwxyz ,"])
def test_pieces_of_random_texts(model, letters):
    r = random.Random(letters)
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)] + [letters[0] * 3000]
    got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)]
    assert got == model.model.encode(texts, add_bos=True, add_eos=True)


def test_pieces_beside_pieces(model):
    r, own = random.Random(5), list(model.ids)
    texts = ["".join(r.choice(own) for _ in range(r.randint(1, 7))) for _ in range(5000)] + own
    got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)]
    assert got == model.model.encode(texts, add_bos=True, add_eos=True)


def test_pairs_are_those_that_encode_to_themselves(model):
    r, own = random.Random(6), sorted(model.ids)
    for a, b in [(r.choice(own), r.choice(own)) for _ in range(20_000)]:
        assert model.compatible(model.ids[a], model.ids[b]) == (model.merged(a + b) == [a, b]), (a, b)


def test_memory_of_stretches_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "STRETCHES", 50)
    own, r = pieces.Pieces(tokenizer_path("piece_bpe_32k.model")), random.Random(3)
    for _ in range(40):
        texts = [" ".join("".join(r.choice("abcde") for _ in range(r.choice((3, 5, 200)))) for _ in range(30))]
        assert np.frombuffer(own.encode(texts)[0], "<u4").tolist() == own.model.encode(texts[0], add_bos=True, add_eos=True)
    assert len(own.known) <= 80 and max(map(len, own.known)) <= pieces.LONG


def test_sentencepiece_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(-1, None), (-2, ""), (-3, "  two  spaces\n\n "), (-4, "word " * 30_000), (-5, "x" * 50_000), (-6, "a▁b <s> </s> <0x0A>"), (-6, "again"), (None, "no id")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).withColumns({"ids": F.lit(1), "n": F.lit("x")})
    path = tokenizer_path("piece_bpe_32k.model")
    got = pieces.digest(pieces.decode(pieces.encode(docs, path), path)).collect()
    from sentencepiece import SentencePieceProcessor

    sp, want = SentencePieceProcessor(model_file=path), []
    for r in docs.collect():
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(got) > 200
    assert pieces.digest(pieces.decode(pieces.encode(docs.limit(0), path), path)).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), path).first().text is None


def plain_codes(rows):
    """Codes, errors and codebooks by trying every entry."""
    kept = sorted(((i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=1) // 8) * 8
    x = [[int(np.floor(4096 * float(np.float32(c)))) for c in v] + [0] * (width - len(v)) for _, v, _ in kept]
    k = width // 8
    parts = [[v[p * k : p * k + k] for p in range(8)] for v in x]
    books = [[parts[e][p] for e in range(min(16, len(parts)))] for p in range(8)]

    def find(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(6):
        own = [[find(v[p], books[p])[1] for p in range(8)] for v in parts]
        for p, e in itertools.product(range(8), range(len(books[0]))):
            mine = [v[p] for v, c in zip(parts, own, strict=True) if c[p] == e]
            if mine:
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out, totals = [], {}
    for (i, _, label), v in zip(kept, parts, strict=True):
        found = [find(v[p], books[p]) for p in range(8)]
        totals[label] = totals.get(label, 0) + sum(d for d, _ in found)
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    own = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(i), c, e, totals[label], own) for i, c, e, label in out)


def some_vectors(seed, n, width, spread=3):
    r = random.Random(seed)
    rows = [(i, [r.choice((-1.0, 0.0, 0.5, r.gauss(0, 1) if spread else 1.0)) for _ in range(width)], r.choice((None, 1, 2, 3))) for i in range(n)]
    return rows + rows[:5] + [(3, rows[4][1], 2), (None, rows[2][1], 1), (n, None, 1), (n + 1, [None] * width, 1), (n + 2, [float("nan")] * width, 1), (n + 3, [float("inf")] * width, 2)]


@pytest.mark.parametrize("seed,n,width", [(1, 300, 16), (2, 60, 64), (3, 9, 8), (4, 200, 13), (5, 1, 8)])
def test_vector_codes(spark, seed, n, width):
    rows = some_vectors(seed, max(n, 5), width)
    if n == 1:
        rows = rows[:1]
    if width == 13:
        rows += [(1000, [0.5] * 3, 1), (1001, [], 2)]
    got = vector_codes.digest(*vector_codes.compress(vectors(spark, rows).repartition(3)))
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == plain_codes(rows)


def test_vector_codes_of_nothing_and_of_huge_components(spark, monkeypatch):
    assert vector_codes.digest(*vector_codes.compress(vectors(spark, []))).count() == 0
    huge = vector_codes.compress(vectors(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 2)]))[0].collect()
    assert {r.vec_id: r.error for r in huge} == {1: 0, 2: 0, 3: 0}
    rows = some_vectors(7, 80, 8)
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", 0)  # totals of labels go to salted rows
    got = vector_codes.digest(*vector_codes.compress(vectors(spark, rows)))
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == plain_codes(rows)


def test_equal_average_search_finds_the_nearest():
    rng = np.random.default_rng(2)
    for high in (2, 5, 1000, 1 << 26):
        x, book = rng.integers(-high, high, (500, 6)), rng.integers(-high, high, (16, 6))
        book[3] = book[9]
        d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        entry, best = vector_codes.nearest(x, book)
        assert (entry == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def plain_negatives(rows):
    own = []
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own.append((k, i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for k, i, label, v in own:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, m, lb) for m, j, lb, w in own if m != k)
            for s, j, _, _ in [x for x in scored if x[3] == label][:5]:
                window = [x for x in scored if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
                out += [(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [False, True])
def test_hard_negatives(spark, monkeypatch, blocks):
    if blocks:
        for name, value in (("BLOCK", 90), ("FINE_BLOCK", 30), ("TILE", 16), ("TILE_ANCHORS", 3), ("LEAF", 4)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = some_vectors(11, 420, 12) + [(500, [0.5] * 12, 1), (500, [0.5] * 12, 1), (500, [0.5] * 12, 2), (600, [0.25] * 5, 3), (700, [1.0] * 12, None), (800, [1.0] * 12, 77)]
    got = hard_negatives.mine(vectors(spark, rows))
    want = plain_negatives(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100 and got.dtypes[2] == ("rank", "int")
    assert hard_negatives.mine(vectors(spark, [])).count() == 0 and hard_negatives.mine(vectors(spark, [(1, [1.0], 1)])).count() == 0


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (130, 64, 201), (129, 131, 65), (0, 4, 3)])
def test_strassen_is_exact(monkeypatch, shape):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    m, k, n = shape
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 26), 1 << 26, (m, k)), rng.integers(-(1 << 26), 1 << 26, (k, n))
    assert (hard_negatives.strassen(a, b) == a @ b).all()


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_hard_negatives"])
def test_sql_forms(spark, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    order = [got.columns.index(d[0]) for d in want.description]
    assert sorted(tuple(r[k] for k in order) for r in got.collect()) == sorted(want.fetchall())

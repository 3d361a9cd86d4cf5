"""Repeated ids, ties and empty tables of the operators, and the classifier against a plain version."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import line_dedup, packing, quality, shared, substring, token_file
from tidewatch.llm.tokens import _tokenizer, tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, score double"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, 0.5) for i, t, s in rows], SCHEMA)


def test_features_equal_plain_sets():
    for text in (b"", b"a", b"ab", b"one two two two three one one two one two", bytes(range(256)) * 3, b"same " * 40, "ünï 🙂".encode()):
        own = set()
        for n in (1, 2, 3):
            for k in range(len(text) - n + 1):
                h = 0
                for c in text[k : k + n]:
                    h = (h * 263 + c + 1) % 2**32
                own.add((h + ((n - 1) << 24)) % 2**32 * 2654435761 % 2**32 >> 16)
        words = text.split()
        for j, back in enumerate((1, 2, 3)):
            run = longest = 0
            for k in range(back, len(words)):
                run = run + 1 if words[k] == words[k - back] else 0
                longest = max(longest, run)
            own.update((1 << 16) + j * 8 + m for m, least in enumerate((1, 2, 3, 4, 6, 8, 12, 16)) if longest >= least)
        assert set(quality.features(text).tolist()) == own


def test_fit_equals_a_dense_dual_descent(monkeypatch):
    monkeypatch.setattr(quality, "SIZE", 40)
    rng = np.random.default_rng(4)
    y = (rng.random(60) < 0.4).astype(int)
    dense = rng.random((60, 40)) < np.where(y[:, None] == 1, np.linspace(0.1, 0.6, 40), np.linspace(0.5, 0.2, 40))
    got = quality.fit([np.flatnonzero(r).astype(np.uint32) for r in dense], y, epochs=400)
    p, q = 1 + dense[y == 1].sum(axis=0), 1 + dense[y == 0].sum(axis=0)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    x = dense * ratio
    norms = np.linalg.norm(x, axis=1)
    x = np.hstack([x / np.sqrt(norms**2 + np.median(norms) ** 2)[:, None], np.ones((60, 1))])
    sign, upper = np.where(y == 1, 1.0, -1.0), np.where(y == 1, 60 / (2 * (y == 1).sum()), 60 / (2 * (y == 0).sum()))
    alpha = np.zeros(60)
    for _ in range(4000):  # the same problem by projected coordinate steps in order, on the whole kernel
        for i in range(60):
            g = sign[i] * (x[i] @ (x.T @ (alpha * sign))) - 1
            alpha[i] = min(max(alpha[i] - g / (x[i] @ x[i]), 0), upper[i])
    w = x.T @ (alpha * sign)
    assert np.allclose(got.ratio, ratio) and np.allclose(got.weight, w[:-1], atol=2e-2) and abs(got.bias - w[-1]) < 2e-2
    own = np.array([got.margin(np.flatnonzero(r).astype(np.uint32)) for r in dense])
    assert np.abs(own - x @ w).max() < 2e-2 and got.slope > 0


def test_quality_ties_repeats_and_empty_tables(spark):
    even = quality.fit([], np.array([], int))  # scores 0.5
    docs = make(spark, [(1, "a", "s"), (1, "a", "s"), (1, None, "s"), (None, "b", None), (2, "", "s")])
    got = quality.score(docs, even).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "2", "None"] and {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert quality.keep_good(docs, even).count() == 5 and quality.keep_good(docs, even, 0.5000001).count() == 0
    assert quality.score(docs.limit(0), even).count() == 0 and quality.keep_good(docs.limit(0), even).columns == docs.columns
    assert quality.keep_good(docs.limit(0), even).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    assert quality.train(docs.limit(0), labels).margin(quality.features(b"x")) == 0.0


def test_lines_of_repeated_ids(spark):
    spread = [(100 + k, f"shared line here\nown text {k}", f"s{k}") for k in range(line_dedup.MIN_SITES)]
    docs = make(spark, [*spread, (1, "shared line here\nfirst of one", "a"), (1, "shared line here\nsecond of one", "b"), (1, "nothing shared", "b")])
    out = line_dedup.dedup_lines(docs)
    assert sorted(r.text for r in out.where("doc_id = 1").collect()) == ["first of one", "nothing shared", "second of one"] and out.count() == docs.count()


def test_passages_of_repeated_ids(spark):
    words = [f"w{k}" for k in range(60)]
    text = lambda a, b: " ".join(words[a:b])
    rows = [(1, text(0, 20), "s"), (1, text(0, 20), "s"), (2, text(5, 30), "s"), (2, text(0, 14), "s"), (3, text(20, 60), "s"), (3, None, "s")]
    got = substring.digest(substring.cut_repeats(make(spark, rows))).collect()
    ids = lambda t: (t or "").split()
    first = {}
    for i, t, _ in rows:
        for k in range(len(ids(t)) - 12):
            key = tuple(ids(t)[k : k + 13])
            first[key] = min(first.get(key, i), i)
    want = []
    for i, t, _ in rows:
        gone = {j for k in range(len(ids(t)) - 12) if first[tuple(ids(t)[k : k + 13])] < i for j in range(k, k + 13)}
        kept = " ".join(w for k, w in enumerate(ids(t)) if k not in gone)
        want.append((i, len(ids(t)), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def test_token_file_and_packing_of_repeated_ids(spark):
    texts = [(1, "one two three"), (1, "one two three"), (1, "other"), (2, None), (2, ""), (None, "x")]
    docs = make(spark, [(i, t, "s") for i, t in texts])
    path = tokenizer_path("byte_bpe_50k.json")
    ids = lambda p, t, end: np.array([*_tokenizer(p).encode(t or "", add_special_tokens=False).ids, end], "<u4").tobytes()
    got = token_file.token_file(docs, path, end_id=2).collect()
    want = sorted((str(i), len(ids(path, t, 2)) // 4, zlib.crc32(ids(path, t, 2))) for i, t in texts)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert token_file.token_file(docs.limit(0), path, end_id=2).count() == 0
    path = tokenizer_path("word_bpe_49k.json")
    packed = packing.pack(docs, path, 1).collect()
    assert sum(r.length for r in packed) == sum(len(ids(path, t, 1)) // 4 for _, t in texts)
    whole = sorted((str(r.doc_id), r.doc_tokens, r.ids_crc32) for r in packed if r.length == r.doc_tokens)
    assert set(whole) <= {(str(i), len(ids(path, t, 1)) // 4, zlib.crc32(ids(path, t, 1))) for i, t in texts}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    out = stage(spark, docs, SF)
    assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_run_of_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.work_dir(Session())

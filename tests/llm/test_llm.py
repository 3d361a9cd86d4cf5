"""Each operator against its definition on small tables: nulls, empty and long texts, repeats, empty tables, clashing columns."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import chat, decontam, embed_dedup, line_dedup, ngram_join, packing, pii, quality, queries, substring, token_file, words
from tidewatch.llm.shared import components
from tidewatch.llm.tokens import Encoder, _tokenizer, tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, id long, score double"


def make(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[k], None, 7, 8, 0.5) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    base = [word() for _ in range(120)]
    near = list(base)
    near[50] = "changed"
    long = " ".join(word() for _ in range(30_000))
    return [(5, None), (6, ""), (7, "   \n "), (8, "one"), (9, "one"), (10, "one two three"), (3, " ".join(base)), (11, " ".join(near)), (12, " ".join(base).upper()), (13, long), (14, long), (15, "tail " + " ".join(base[:40])), (None, "lost"), (16, "a\x0bb\x1c c ünï 🙂  d")]


def plain_links(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            w = (t or "").encode().lower().split()
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_ngram_join(spark, odd):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(make(spark, odd)).collect()}
    assert got == plain_links(odd)
    assert ngram_join.ngram_join(make(spark, odd[:0])).count() == 0


def test_ngram_join_of_near_copies_in_chains(spark):
    r, rows, words = random.Random(9), [], [f"w{k}" for k in range(60)]
    for i in range(90):
        words = list(words)
        for _ in range(r.choice([0, 1, 2, 3])):
            words[r.randrange(60)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words[: r.choice([60, 60, 55, 50, 7])])))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.ngram_join(make(spark, rows)).collect()}
    assert got == plain_links(rows)


def near_copies(seed, n, words, most=9):
    """Copies of one text, each with a few words changed."""
    r, rows = random.Random(seed), []
    base = [f"w{k}" for k in range(words)]
    for i in range(n):
        own = list(base)
        for _ in range(r.randint(0, most)):
            own[r.randrange(words)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows


def test_ngram_join_in_blocks(spark, monkeypatch):
    """Groups and clusters of several blocks, with and without a component that holds most."""
    monkeypatch.setattr(ngram_join, "CHUNK", 7)
    monkeypatch.setattr(ngram_join, "SHARD", 900)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    rows = near_copies(3, 60, 90) + [(100 + i, "q " + t) for i, t in near_copies(4, 25, 60, 12)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.ngram_join(make(spark, rows)).collect()}
    assert got == plain_links(rows) and len({c for _, c in got.values()}) > 10


def test_ngram_join_of_repeated_ids(spark):
    rows = [(i % 7, t) for i, t in near_copies(5, 20, 60, 4)] + [(3, "another text that shares nothing with the rest of them"), (50, "another text that shares nothing with the rest of them"), (6, None)]
    got = {(x.doc_id, x.n_shingles, x.component_id) for x in ngram_join.ngram_join(make(spark, rows)).collect()}
    sets = [plain_links([(0, t)])[0][0] for _, t in rows]
    joined = plain_links([(i, t) for i, (_, t) in enumerate(rows)])
    label = {i: i for i, _ in rows}
    for _ in rows:  # rows of one id are one document
        for k, (i, _) in enumerate(rows):
            for q, (j, _) in enumerate(rows):
                if joined[k][1] == joined[q][1]:
                    label[i] = label[j] = min(label[i], label[j])
    assert got == {(i, n, label[i]) for (i, _), n in zip(rows, sets, strict=True)}


def test_runs_of_signatures():
    r = np.random.default_rng(1)
    for high in (50, 2**20, 2**33):
        v, w = np.sort(r.integers(0, high, 1000, dtype=np.uint64)), r.integers(0, 2**16, 1000)
        value, row = ngram_join._read_run(ngram_join._run(v, w, 7 << 40))
        assert (value == v).all() and (row == w + (7 << 40)).all()


def test_sketches_never_rule_a_link_out():
    r = np.random.default_rng(2)
    sets = []
    for n in (1, 3, 9, 30, 33, 64, 130, 500, 2100):
        base = r.integers(0, 2**64, n, dtype=np.uint64)
        sets += [np.unique(np.concatenate([base[: n - r.integers(0, n // 8 + 1)], r.integers(0, 2**64, r.integers(0, n // 8 + 1), dtype=np.uint64)])) for _ in range(12)]
    sets.append(np.arange(40, dtype=np.uint64))  # all in one slice: no sketch
    have = ngram_join._Sketches(np.array([len(s) for s in sets]), [ngram_join.sketch(s) for s in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    ok = have.may_link(a, b)
    share = np.array([len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)])
    large = have.n >= 55  # a few hashes can agree by chance
    assert ok[share >= 0.8].all() and not ok[(share < 0.3) & large[a] & large[b]].any()


@pytest.mark.parametrize("n", [1, 4, 5, 6, 9, 15, 17, 40, 41, 130, 700, 2000, 5000])
def test_similar_sets_share_a_signature(n):
    r = np.random.default_rng(n)
    for _ in range(60):
        a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        gone, more = r.integers(0, n // 9 + 1), r.integers(0, n // 9 + 1)
        b = np.unique(np.concatenate([r.permutation(a)[gone:], r.integers(0, 2**64, more, dtype=np.uint64)]))
        if len(b) and 80 * len(np.union1d(a, b)) <= 100 * len(np.intersect1d(a, b)) < 100 * len(np.union1d(a, b)):  # equal sets are one class without it
            assert len(np.intersect1d(ngram_join.signatures(a), ngram_join.signatures(b)))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (None, 1)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_chat_round_trip_and_layouts(spark):
    tricky = ["\\### Assistant: </turn> ok", "", "a\\b\\l<#:\n### user:\n</turn>\n", None]
    rows = [(1, k, role, t) for k, (role, t) in enumerate(zip(["user", "assistant", "assi:st<ant", None], tricky, strict=True))] + [(2, 0, "assistant", "🙂<")]
    c = chat.canonical(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    f = chat.format_chat(c).select("conv_id", chat.read_chat(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("l"))
    got = {r.conv_id: ([tuple(x) for x in r.t], r.l) for r in f.collect()}
    assert got[1] == ([("user", tricky[0]), ("assistant", ""), ("assi:st<ant", tricky[2]), ("", "")], [""]) and got[2] == ([("assistant", "🙂<")], ["🙂<"])
    layouts = {
        "messages": {"conv_id": 1, "messages": [{"role": "user", "content": "q", "x": 1}, {"role": "assistant", "content": "a", "x": 2}]},
        "from-value": {"conv_id": 1, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "turn": 1},
        "instruction": {"conv_id": 1, "instruction": "q", "input": "", "output": "a"},
        "prompt-response": {"conv_id": 1, "prompt": "q", "response": "a"},
    }
    for name, row in layouts.items():
        df = spark.read.json(spark.sparkContext.parallelize([json.dumps(row)]))
        assert chat.layout(df.schema).name == name
        assert [tuple(x) for x in chat.canonical(df).first().turns] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.layout(spark.createDataFrame([(1,)], "z int").schema)
    # files of several layouts read together: each row has its own; nested and other fields that no mapping asks for don't matter
    mixed = [{**row, "conv_id": i, "z.y": 1, "text": "other"} for i, row in enumerate(layouts.values())] + [
        {"conv_id": 4, "instruction": "q", "output": "a"},
        {"conv_id": 5, "prompt": "q", "response": "a", "input": "not asked for"},
        {"conv_id": 6, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "prompt": "other"},
        {"conv_id": 7, "response": "a"},
        {"conv_id": 8},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(row) for row in mixed]))
    got = {r.conv_id: None if r.turns is None else [tuple(x) for x in r.turns] for r in chat.canonical(df).collect()}
    assert got == {**dict.fromkeys(range(7), [("user", "q"), ("assistant", "a")]), 7: [("user", ""), ("assistant", "a")], 8: None}
    assert chat.fingerprint(["a[].b", "a[].c"]) == chat.fingerprint(["a[].c", "a[].b"])


def test_chat_of_rows_by_turn_among_other_layouts(spark):
    mixed = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conv_id": 2, "turn": 1, "role": "assistant", "text": "two"},
        {"conv_id": 2, "turn": 0, "role": "user", "text": "one"},
        {"conv_id": 3, "turn": 0, "role": "user"},
        {"conv_id": 4, "messages": []},
        {"conv_id": 5, "other": 1},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(row) for row in mixed]))
    own = chat.canonical(df)
    got = {r.conv_id: None if r.turns is None else [tuple(x) for x in r.turns] for r in own.collect()}
    assert got == {1: [("user", "q"), ("assistant", "a")], 2: [("user", "one"), ("assistant", "two")], 3: [("user", "")], 4: [], 5: None}
    digests = {r.conv_id: (r.n_turns, r.loss_chars, r.turns_sha256 is None) for r in chat.digest(chat.format_chat(own)).collect()}
    assert digests == {1: (2, 1, False), 2: (2, 3, False), 3: (1, 0, False), 4: (0, 0, False), 5: (0, None, True)}
    assert chat.canonical(df.limit(0)).count() == 0


def test_chat_of_empty_tables_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q", 5, "t"), (1, 0, "user", "q", 6, "t")], "conv_id long, turn long, role string, text string, x int, t string")
    got = chat.digest(chat.format_chat(chat.canonical(rows))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(1, 2, 0)]
    assert chat.digest(chat.format_chat(chat.canonical(rows.limit(0)))).count() == 0


def test_sql_forms(spark):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, SF).toPandas()
        want = con.execute(sql).df()[list(got.columns)]
        key = list(got.columns)
        got, want = (x.sort_values(key).reset_index(drop=True).astype(str) for x in (got, want))
        assert got.equals(want), name


def test_decontamination(spark, odd):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    near = item.replace("kappa", "other")
    docs = [*odd, (20, f"before {item.upper()} after"), (21, item), (22, "x " * 50 + item + " " + item), (23, " ".join(item.split()[:9])), (24, near)]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too few"), (None, item), (4, "what no document holds at all in any place")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_windows for r in decontam.leaks(make(spark, docs), bench).collect()}
    assert got == {(20, 1): 1, (21, 1): 1, (22, 1): 2}
    assert sorted(r.doc_id for r in decontam.decontaminate(make(spark, docs), bench).where("doc_id >= 20").collect()) == [23, 24]
    assert decontam.leaks(make(spark, docs[:0]), bench).count() == 0 and decontam.leaks(make(spark, docs), bench.limit(0)).count() == 0


def test_decontamination_of_short_items(spark):
    docs = [(1, "so it is not a leak and not a Leak"), (2, "not a"), (3, None), (4, ""), (5, "a not"), (5, "it is not a b"), (None, "not a")]
    bench = spark.createDataFrame([(1, "not a leak"), (2, "not a"), (3, "b"), (4, ""), (5, "it is not a leak and not")], "item_id long, text string")
    clash = make(spark, docs).withColumn("__id", F.lit(1)).withColumn("bad_id", F.lit(1)).withColumn("k", F.lit(1))
    got = {(r.doc_id, r.item_id, r.n_windows, r.first_word, r.similarity) for r in decontam.leaks(clash, bench).collect()}
    assert got == {(1, 1, 2, 3, 1.0), (1, 2, 2, 3, 1.0), (1, 5, 1, 1, 1.0), (2, 2, 1, 0, 1.0), (5, 2, 1, 2, 1.0), (5, 3, 1, 4, 1.0)}
    out = decontam.decontaminate(clash, bench)
    assert out.columns == clash.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 3, 4]


def test_fingerprints_of_similar_texts_lie_within_the_radius(spark):
    """Pairs of a similarity of 0.8 and a little more, by words changed: at least 0.9 of them are found by their fingerprints."""
    r, rows = random.Random(3), []
    for k in range(300):
        words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(r.choice([30, 60, 120]))]
        other = list(words)
        for _ in range(max(1, len(words) // 50)):
            other[r.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words), " ".join(other)))
    both = spark.createDataFrame(rows, "k long, a string, b string").select(*[decontam._shingles(decontam._words(F.col(c))).alias(c) for c in "ab"])
    both = both.select(decontam._common(F.col("a"), F.col("b")).alias("c"), F.size("a").alias("n"), F.size("b").alias("m"), F.bit_count(decontam._simhash(F.col("a")).bitwiseXOR(decontam._simhash(F.col("b")))).alias("far"))
    far = [x.far for x in both.collect() if x.c / (x.n + x.m - x.c) >= 0.8]
    assert len(far) > 60 and np.mean([x <= decontam.RADIUS for x in far]) >= 0.9


def plain_leaks(docs, items):
    """Every window start of every document against every item."""
    shingles = lambda t: [tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(max(1, len(w) - 4))]
    out = {}
    for d, text in docs:
        s = shingles(text)
        for i, item in items:
            t = shingles(item)
            c = Counter(t)
            at = []
            for k in range(len(s)):
                w = s[k : k + len(t)]
                common = sum((Counter(w) & c).values())
                if common >= 0.8 * (len(w) + len(t) - common):
                    at.append((k, common / (len(w) + len(t) - common)))
            if at:
                n, end, words = 0, 0, len(t) + 4
                for k, _ in at:
                    n, end = (n + 1, k + words) if k >= end else (n, end)
                first = min((-x, k) for k, x in at if k < at[0][0] + words)[1]
                out[d, i] = (n, first, round(max(x for _, x in at), 9))
    return out


def test_decontamination_of_reordered_items(spark):
    r = random.Random(8)
    words = lambda n, pre="": [pre + "".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    items = [(k, words(n)) for k, n in enumerate((9, 44, 60, 90, 140))] + [(5, ["x"] * 30 + words(16))]
    docs = []
    for i, w in items:
        cut, end = len(w) // 2, len(w) // 3
        swapped, thirds = w[cut:] + w[:cut], w[2 * end :] + w[end : 2 * end] + w[:end]
        near = [*w[:cut], "other", *w[cut + 1 :]]
        for k, held in enumerate((w, swapped, thirds, near, w + w, swapped + words(3) + swapped, w[: -len(w) // 10], w[:cut], w[::-1])):
            docs += [(100 * i + 10 * k, words(25) + held + words(30)), (100 * i + 10 * k + 1, held), (100 * i + 10 * k + 2, words(7) + held)]
    docs.append((990, ["x"] * 200))
    docs, items = ([(i, " ".join(w)) for i, w in rows] for rows in (docs, items))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(q.doc_id, q.item_id): (q.n_windows, q.first_word, round(q.similarity, 9)) for q in decontam.leaks(make(spark, docs), bench).collect()}
    want = plain_leaks(docs, items)
    assert got == want and {(310, 3), (311, 3), (410, 4), (420, 4)} <= set(got)


def test_decontamination_of_an_item_does_not_depend_on_the_others(spark):
    r = random.Random(18)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    item = [word() for _ in range(100)]
    held = [word() for _ in range(20)] + item[:84] + [word() for _ in range(40)]
    docs, items = [(1, " ".join(held)), (2, " ".join(item)), (3, " ".join(item[:10]))], [(1, " ".join(item)), (2, " ".join(item[:84])), (3, " ".join(item[:10]))]
    both = {}
    for some in (items[:1], items[1:], items, items[::2]):
        bench = spark.createDataFrame(some, "item_id long, text string")
        got = {(q.doc_id, q.item_id): (q.n_windows, q.first_word, round(q.similarity, 9)) for q in decontam.leaks(make(spark, docs), bench).collect()}
        assert got == plain_leaks(docs, some)
        for k, v in got.items():
            assert both.setdefault(k, v) == v
    assert (1, 2) in both and (1, 1) not in both


def test_decontamination_at_the_threshold(spark, monkeypatch):
    words = [f"w{k}" for k in range(40)]
    item = words[:13]  # nine shingles; eight of them in eight or ten places
    docs = [(1, " ".join(words[:12])), (2, " ".join(words[:11])), (3, " ".join([*words[:12], "x"] + words[20:]))]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {(q.doc_id, q.item_id): (q.n_windows, q.first_word, round(q.similarity, 9)) for q in decontam.leaks(make(spark, docs), bench, radius=64 - 1).collect()}
    assert got == plain_leaks(docs, [(1, " ".join(item))]) and (3, 1) in got
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    again = {(q.doc_id, q.item_id): (q.n_windows, q.first_word, round(q.similarity, 9)) for q in decontam.leaks(make(spark, docs), bench, radius=64 - 1).collect()}
    assert again == got


def test_line_dedup(spark, odd):
    rows, sources = list(odd), ["a"] * len(odd)
    for k in range(12):
        rows.append((100 + k, f"shared line here\nown text number {k} that is long enough to stay\n\n"))
        sources.append(f"s{k % line_dedup.MIN_SITES}")
    rows.append((200, "shared line here"))
    sources.append(None)
    docs = make(spark, rows, sources)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = {r.doc_id: r.text for r in out.collect()}
    assert all(got[100 + k] == f"own text number {k} that is long enough to stay\n\n" for k in range(12))
    assert got[200] == "shared line here" and all(got[i] == t for i, t in odd)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_boilerplate_heavy_documents(spark):
    rows = [(k, f"the line that all of these many sites show\nown {k}") for k in range(line_dedup.MIN_SITES)]
    rows += [(50, "the line that all of these many sites show\n \n"), (51, "\n \n"), (52, "mine")]
    docs = make(spark, rows, [f"s{k}" for k in range(len(rows))])
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {**{k: f"own {k}" for k in range(line_dedup.MIN_SITES)}, **dict(rows[-3:])}
    clash = docs.withColumn("__id", F.lit("x")).withColumn("__bad", F.lit(1)).withColumn("h", F.lit(2))
    out = line_dedup.dedup_lines(clash)
    assert out.columns == clash.columns and {r.doc_id: r.text for r in out.collect()} == got


def test_substring(spark, odd):
    own = [x for x in odd if x[0] is not None]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digest(substring.cut_repeats(make(spark, odd))).collect()}
    assert got == substring.plain(own)
    assert substring.cut_repeats(make(spark, odd[:0])).count() == 0


# no frequent minimizers; all windows in the broadcast shard; a few of them there and the rest dealt out, whole or by runs
@pytest.mark.parametrize("sample, shard, hot", [(64, 10_000, 5), (1, 10_000, 5), (1, 3, 5), (1, 3, 5000)])
def test_substring_with_hot_passages(spark, monkeypatch, sample, shard, hot):
    for name, value in (("HOT", hot), ("SAMPLE", sample), ("OFTEN", 4), ("SHARD_ROWS", shard)):
        monkeypatch.setattr(substring, name, value)
    r = random.Random(2)
    words = lambda n: [r.choice("abcdef") * r.randint(1, 3) for _ in range(n)]
    common = [words(16), words(40), words(13)]
    rows = []
    for i in range(60):
        text = words(r.randint(0, 30))
        for _ in range(r.randint(0, 3)):
            text += r.choice(common)[r.randint(0, 3) :] + words(r.randint(0, 30))
        rows.append((i, " ".join(text)))
    assert len(substring._frequent(make(spark, rows).withColumn("text", F.col("text").cast("binary")))) > 0 or sample > 1
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in substring.digest(substring.cut_repeats(make(spark, rows))).collect()}
    assert got == substring.plain(rows)


def test_automaton():
    r = random.Random(1)
    for _ in range(200):
        texts = [[r.randrange(3) for _ in range(r.randint(0, 25))] for _ in range(4)]
        a = substring.Automaton()
        for d, t in enumerate(texts):
            a.add(t, d)
        a.close()
        for t in texts:
            want = [next(d for d, u in enumerate(texts) if any(u[q : q + 4] == t[k : k + 4] for q in range(len(u) - 3))) for k in range(len(t) - 3)]
            assert a.firsts(t, 4) == want


def test_quality(spark, odd):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).withColumn("h", quality.held_out(F.col("doc_id"))).join(labels, "doc_id").where("h").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.h for r in got)
    small = make(spark, odd)
    scores = [r.score for r in quality.score(small, model).collect()]
    assert len(scores) == len(odd) and all(0 <= s <= 1 for s in scores)
    assert quality.keep_good(small, model).columns == small.columns
    blank = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(small, blank).collect()} == {0.5}


def test_pii(spark, odd):
    t = "mail a.b@c.de, ip 10.0.0.1 and 300.1.1.1, card 4111 1111 1111 1111 and 4111111111111112, call +49 (30) 1234-5678 or +1"
    assert [(k, t[a:b]) for k, a, b in pii.rules(t)] == [("email", "a.b@c.de"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 1234-5678")]
    long = "x" * 200_000 + "@" + "9" * 50_000
    assert pii.rules(long) == []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tagger = pii.train(docs)
    x, y = pii.labelled([r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 200").collect()])
    tags, _ = tagger.decode(x)
    assert (tags[y > 0] == y[y > 0]).mean() > 0.7 and (tags[y == 0] == 0).mean() > 0.85
    # planted: personal data written in ways that the patterns don't know
    planted = found = extra = 0
    for r in docs.collect():
        base = pii.rules(r.text or "")
        text, spans = pii.varied(r.text or "", base, 1000 + r.doc_id)
        known = pii.rules(text)
        want = {x for x in spans if all(x[2] <= a or x[1] >= b for _, a, b in known)}
        got = set(pii.find(text, tagger.spans([text])[0], known)) - set(known)
        planted, found, extra = planted + len(want), found + len(want & got), extra + len(got - want)
        assert set(known) <= set(pii.find(text, tagger.spans([text])[0], known))
    print(f"planted {planted}, found {found}, others {extra}")
    assert planted > 10 and found >= 0.5 * planted and extra <= 0.2 * planted
    rows = {r.doc_id: r for r in pii.digest(pii.detect(make(spark, [*odd, (30, t), (31, long)]), tagger)).collect()}
    assert (rows[30].n_email, rows[30].n_ip, rows[30].n_phone) == (1, 1, 1) and rows[5].spans == ""
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in pii.rules(t))
    assert rows[30].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert "[email]" in pii.redact(make(spark, [(30, t)]), tagger).first().text


def literal_spans(text):
    """The patterns as they are written, matched from the left."""
    luhn = lambda d: sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0
    digits = lambda t: re.sub("[^0-9]", "", t)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(digits(t)) <= 19 and luhn(digits(t))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
    )
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m.group())]
    return [(kinds[k][0], a, b) for a, k, b in sorted(found)]


def test_rules_equal_the_literal_patterns():
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()]
    r = random.Random(6)
    texts += ["".join(r.choice("1234567890.@ab-+ ()") for _ in range(60)) for _ in range(3000)]
    for t in texts:
        assert pii.rules(t) == literal_spans(t), t[:200]


def test_pii_of_empty_tables_and_repeated_ids(spark):
    tagger = pii.Tagger()
    rows = [(1, "a@b.cd"), (1, "none"), (1, "a@b.cd"), (None, "x@y.zz"), (2, None)]
    docs = make(spark, rows)
    assert sorted((r.doc_id or 0, r.n_email) for r in pii.digest(pii.detect(docs, tagger)).collect()) == [(0, 1), (1, 0), (1, 1), (1, 1), (2, 0)]
    assert pii.detect(docs.limit(0), tagger).count() == 0 and pii.redact(docs.limit(0), tagger).count() == 0
    assert pii.train(docs.limit(0)).spans(["a (at) b.cd"]) == [[]]


def test_network_gradient():
    net, r = pii.Tagger(embed=4, hidden=3), np.random.default_rng(0)
    x, y = r.integers(0, 99, (3, 12)), np.zeros((3, 12), int)
    y[0, 3], y[0, 4:6], y[1, 2] = 1, 2, 5
    _, grad = net.step(x, y)
    for name, p in net.p.items():
        at = (int(x[0, 3]), 1) if name == "E" else tuple(r.integers(0, s) for s in p.shape)
        up, down = [], []
        for side, sign in ((up, 1), (down, -1)):
            p[at] += sign * 1e-5
            side.append(net.step(x, y)[0])
            p[at] -= sign * 1e-5
        assert abs((up[0] - down[0]) / 2e-5 - grad[name][at]) < 1e-5, name


def test_tokens_and_files(spark, odd):
    r = random.Random(1)
    texts = ["".join(r.choice(" \n\t aBé1'!ś\x1c\x85🙂.,|") for _ in range(r.randint(0, 40))) for _ in range(1500)] + [t or "" for _, t in odd] + ["<|endoftext|> x", "a <|endoftext|> b  <|endoftext|>", "x </s> y <unk>", "<pad>"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = tokenizer_path(name)
        texts += [f"a {t.content}b {t.content}" for t in _tokenizer(path).get_added_tokens_decoder().values()][:5]
        for t, raw in zip(texts, Encoder(path, limit=300).encode_all(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == _tokenizer(path).encode(t, add_special_tokens=False).ids, ascii(t)
    path = tokenizer_path("byte_bpe_50k.json")
    rows = token_file.token_file(make(spark, odd), path, 2, ids=True).collect()
    at = 0
    for (i, t), row in zip(sorted(odd, key=lambda x: (x[0] is not None, x[0])), sorted(rows, key=lambda x: x.start), strict=True):
        ids = [*_tokenizer(path).encode(t or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, list(row.ids)) == (i, at, len(ids), ids) and row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_file.token_file(make(spark, odd[:0]), path, 2).count() == 0


@pytest.mark.parametrize("group", [1, 300, 2_000_000])
def test_runs_of_a_batch_are_those_of_its_texts(monkeypatch, group):
    r = random.Random(group)
    texts = [None, b"", b" ", b"a " * 12, b"a " * 13, b"\xff\xfe " * 20, b" x\x0b\x1cy \x85 " * 9]
    texts += ["".join(r.choice(["a", "b", "ü", " ", "  ", "\n", "\t"]) for _ in range(r.randint(0, 300))).encode() for _ in range(200)]
    hashed = Counter()
    digest = words.xxh64_intdigest
    monkeypatch.setattr(words, "xxh64_intdigest", lambda w: hashed.update([w]) or digest(w))
    monkeypatch.setattr(words, "GROUP", group)
    want = []
    for row, t in enumerate(texts):
        cut = (t or b"").split()
        h = np.array([digest(w) for w in cut], np.uint64)
        g = words.grams(h, substring.RUN).tolist()
        last = None
        for i in range(len(cut) - substring.WINDOW + 1):
            place = min(range(i, i + substring.WINDOW - substring.RUN + 1), key=g.__getitem__)
            if place != last:
                want.append([row, g[place], i, 0])
            want[-1][3] += 1
            last = place
    got = [list(x) for part in substring._runs(pa.array([b"first", *texts], pa.binary()).slice(1)) for x in zip(*[c.tolist() for c in part], strict=True)]
    assert got == want and (group < 2_000_000 or max(hashed.values()) == 1)


def test_each_distinct_part_is_looked_up_once(monkeypatch):
    path, met, texts = tokenizer_path("byte_bpe_50k.json"), [], []
    meet, each = Encoder._meet, Encoder._each
    monkeypatch.setattr(Encoder, "_meet", lambda self, parts: met.append(list(parts)) or meet(self, parts))
    monkeypatch.setattr(Encoder, "_each", lambda self, found: texts.extend(found) or each(self, found))
    docs = [f"first w{chr(97 + k % 7)} and {' '.join(chr(97 + i % 26) * (1 + i // 26) for i in range(k, k + 300))}  end <|endoftext|>"[: None if k == 3 else -14] for k in range(40)]
    got = Encoder(path).encode_all(pa.array(docs))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [_tokenizer(path).encode(t, add_special_tokens=False).ids for t in docs]
    assert len(met) == 1 and len(met[0]) == len(set(met[0]))  # not each place of it
    assert max(t.count(" ") for t in texts if t not in docs) <= 100  # short texts, which the library takes less time for


@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 2**32])
def test_blocks(high):
    r = np.random.default_rng(high)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = r.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        ids[r.random(n) < 0.02] = 2**32 - 1
        s = token_file.Segment(token_file.write_segment([None, 4], [n, 0], ids))
        a, b = sorted(r.integers(0, n + 1, 2))
        assert (s.ids() == ids).all() and (s.ids(a, b) == ids[a:b]).all() and s.doc_ids == [None, 4]


def check_pieces(rows, docs, path):
    truth = {i: np.array([*_tokenizer(path).encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(truth)
    for i, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda x: x.start):
            assert (p.start, p.doc_tokens) == (at, len(truth[i])) and p.ids_crc32 == zlib.crc32(truth[i][at : at + p.length].tobytes())
            at += p.length
        assert at == len(truth[i])
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda x: x.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0


def test_packing(spark, odd):
    path = tokenizer_path("word_bpe_49k.json")
    for parts in (1, 5):
        check_pieces(packing.pack(make(spark, odd).repartition(parts), path, 1).collect(), odd, path)
    assert packing.pack(make(spark, odd[:0]), path, 1).count() == 0


def test_embeddings(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(40, 16))
    x = np.concatenate([base, base + 0.1 * r.normal(size=base.shape), base[:10], r.normal(size=(60, 16))])
    labels = r.integers(0, 3, 40)
    labels = np.concatenate([labels, labels, labels[:10], r.integers(0, 3, 60)])
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels, strict=True))]
    bad = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, [float("inf")] * 16, 1), (905, x[0].tolist(), None), (906, [1.0, 2.0], 1), (907, [], 1)]
    got = {q.vec_id: q for q in embed_dedup.near_dedup(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None])
    links = near.sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum() and len(got) == len(x) + len(bad)
    assert all(q.kept == (q.vec_id == q.component_id) for q in got.values()) and all(got[b[0]].n_links == 0 for b in bad)
    none = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embed_dedup.near_dedup(none).count() == 0 and embed_dedup.near_dedup(spark.createDataFrame(bad, none.schema)).count() == len(bad)
    a, b = r.random(5), r.random(6)
    order = embed_dedup.traverse(a, b, 30)
    sums = [a[c // 6] + b[c % 6] for c in order]
    assert sums == sorted(sums) and len(set(order)) == 30


def test_embeddings_of_any_size_in_blocks(spark, monkeypatch):
    """Very small and very large vectors, ties, repeated rows, other columns' names; cells of several blocks; both ends of a link count it."""
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    r = np.random.default_rng(5)
    far = r.normal(size=(3, 8)) * 1e-200
    base = r.normal(size=8)
    near = np.array([base + 0.12 * r.normal(size=8) for _ in range(150)])
    x = np.concatenate([far, far[:1] * 3, near, near[:20] * 1e200, near[5:9]])
    rows = [(i, v.tolist(), "z", i, True, "c") for i, v in enumerate(x)]
    got = {q.vec_id: q for q in embed_dedup.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, cell long, stored boolean, weight string")).collect()}
    u = embed_dedup.unit(x)
    links = (u @ u.T >= 0.93).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum() and found.sum() % 2 == 0
    assert [got[i].component_id for i in range(4)] == [0, 1, 2, 0] and got[0].n_links == got[3].n_links == 1


def test_embeddings_of_repeated_ids(spark):
    one, near, far = [1.0, 0.0, 0.0, 0.0], [0.99, 0.05, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    rows = [(1, one, 1), (1, one, 1), (2, one, 1), (2, far, 1), (3, near, 1), (3, near, 2), (4, far, 1), (4, None, 1), (4, far, None), (None, far, 1)]
    got = embed_dedup.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    links = lambda a, b: a[2] == b[2] and None not in (a[1], b[1], a[2]) and float(np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1])) >= 0.93
    own = [r for r in rows if r[0] is not None]
    label = [r[0] for r in own]
    for _ in own:
        for i, j in ((i, j) for i in range(len(own)) for j in range(len(own)) if i != j and links(own[i], own[j])):
            label[i] = label[j] = min(label[i], label[j])
    want = [(own[i][0], sum(links(own[i], own[j]) for j in range(len(own)) if j != i), label[i], label[i] == own[i][0]) for i in range(len(own))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_embeddings_at_the_threshold(spark):
    # (1, 0) and (c, s) with a cosine of just below, just at and just above the threshold, in double precision
    at = 0.9375
    rows = [(0, [1.0, 0.0, 0.0, 0.0], 1)] + [(k, [float(c), 0.0, float(np.sqrt(1 - c * c)), 0.0], 1) for k, c in ((1, at), (2, np.nextafter(at, 0) - 1e-9), (3, at + 1e-9))]
    got = {r.vec_id: r.n_links for r in embed_dedup.near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=at).collect()}
    u = embed_dedup.unit(np.array([r[1] for r in rows]))
    assert got == {k: int((u[k] @ u.T >= at).sum()) - 1 for k in range(4)}


def test_every_way_of_writing_is_read():
    base = {"email": "john.doe@mail.example.com", "ip": "10.20.30.40", "card": "4111 1111 1111 1111", "phone": "+41 44 123 45 67"}
    r = random.Random(2)
    for kind, text in base.items():
        for seed in range(400):
            pre, post = " ".join(["word"] * r.randint(0, 60)) + " ", " " + " ".join(["more"] * r.randint(0, 60))
            new, spans = pii.varied(pre + text + post, [(kind, len(pre), len(pre) + len(text))], seed)
            read = pii.windows(new)
            for _, a, b in spans:
                assert any(at <= a and b <= at + pii.WINDOW for at in read), (kind, new[a:b])
    for at in pii._AT:
        for dot in (*pii._DOT, "."):
            assert pii.windows(f"write to john{at}example{dot}com today"), (at, dot)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, SF))
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        docs = out
    shingled = plain_links([(r.doc_id, r.text) for r in docs.collect()])
    assert all(i == c for i, (_, c) in shingled.items())
    path = tokenizer_path("word_bpe_49k.json")
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()], path)
    assert Counter(n for n, _ in corpus_pipeline.STAGES).most_common(1)[0][1] == 1


def test_whole_run_against_plain_stages(spark, tmp_path):
    """run() over planted documents, empty and null texts, repeated and missing ids; each stage by its definition on what the one before kept."""
    r = random.Random(12)
    docs = {x.doc_id: (x.text, x.source) for x in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()}
    bench = [(x.item_id, x.text) for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:12]
    good = [t for t, _ in docs.values() if t and len(t.split()) > 60][:20]
    for k in range(10):
        docs[9000 + k] = (f"the one line of all sites\n{good[k]}", f"site{k}")
        docs[9100 + k] = (good[k] + " " + bench[k][1], "a")
        words = good[k].split()
        words[r.randrange(len(words))] = "other"
        docs[9200 + k] = (" ".join(words), "b")
    docs |= {9300: (None, "a"), 9301: ("", "a")}
    rows = [(i, t, "en", s, len(t or ""), "x") for i, (t, s) in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, gone_id string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    # quality: the same model, one text after the other
    model = quality.train(table, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = {i: (t, s) for i, (t, s) in docs.items() if model.score((t or "").encode()) >= 0.5}
    # lines of eight sites or more
    sites = {}
    for t, s in kept.values():
        for line in set((t or "").split("\n")):
            sites.setdefault(line, set()).add(s)
    bad = {x for x, s in sites.items() if x.strip(" ") and len(s) >= line_dedup.MIN_SITES}

    def cut(t):
        good_lines = [x for x in (t or "").split("\n") if x not in bad]
        return "\n".join(good_lines) if t is not None and any(x.strip(" ") for x in good_lines) else t

    texts = {i: cut(t) for i, (t, _) in kept.items()}
    texts = {i: texts[i] for i, (_, c) in plain_links(list(texts.items())).items() if i == c}
    leaking = {d for d, _ in plain_leaks([(i, t or "") for i, t in texts.items() if t and t.split()], bench)}
    texts = {i: t for i, t in texts.items() if i not in leaking}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in out} == set(texts) and 30 < len(texts) < len(docs) - 15
    check_pieces(out, list(texts.items()), tokenizer_path("word_bpe_49k.json"))

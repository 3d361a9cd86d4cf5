"""Benchmark decontamination: windows of a benchmark item's size in documents, fingerprinted and compared with the items.

A window of an item's length is looked at wherever it holds as many of the item's five-word shingles, in any order, as the similarity needs at
least, and is compared with items of that length. Windows and items get 64-bit SimHash fingerprints of their weighted shingles. Fingerprints are cut into eight blocks of eight
bits; two that differ in at most 23 bits differ in at most two bits within some block, so items enter an index under every value within two bits of each of
their blocks, and a window finds all items within the radius by equality. The weighted Jaccard similarity of the shingles then decides exactly.

All of it is DataFrame expressions. The index and the items' shingles grow with the benchmark alone; they are broadcast only after a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, small

N = 5
SIMILARITY = 0.8
BLOCKS, BITS = 8, 8
#: In a block at most RADIUS // BLOCKS = 2 bits differ.
RADIUS = 23
#: What is broadcast of the places to look at, at most.
BROADCAST_BYTES = 32 << 20


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Hash of each run of five words; a shorter text is one run."""
    runs = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, N)]))
    return F.when(F.size(words) <= N, F.slice(runs, 1, 1)).otherwise(F.slice(runs, 1, F.greatest(F.size(words) - (N - 1), F.lit(0))))


def _simhash(shingles: Column) -> Column:
    """64-bit SimHash of a list of shingles, each as often as it occurs."""

    # three bits at a time, each counted in 21 bits of a long
    spread, lanes = 1 | 1 << 20 | 1 << 40, 1 | 1 << 21 | 1 << 42

    def votes(k: int) -> Column:
        three = lambda s: F.shiftrightunsigned(s, k).bitwiseAND(F.lit(7))
        return F.aggregate(shingles, F.lit(0).cast("long"), lambda a, s: a + (three(s) * F.lit(spread)).bitwiseAND(F.lit(lanes)))

    out = F.lit(0).cast("long")
    for k in range(0, 64, 3):
        ones = votes(k)
        for j in range(min(3, 64 - k)):
            more = F.shiftrightunsigned(ones, 21 * j).bitwiseAND(F.lit((1 << 21) - 1)) * 2 > F.size(shingles)
            out = out.bitwiseOR(F.when(more, F.shiftleft(F.lit(1).cast("long"), k + j)).otherwise(F.lit(0).cast("long")))
    return out


def _block(h: Column, k: int) -> Column:
    return F.shiftrightunsigned(h, k * BITS).bitwiseAND(F.lit(255)).cast("int")


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, n (shingles), s (their hashes in order), f (fingerprint). Items without words are left out."""
    b = benchmark.where("item_id is not null").select("item_id", _words(F.col("text")).alias("w")).where("size(w) > 0")
    b = materialize(b.where(F.size("w") >= N).select("item_id", _shingles(F.col("w")).alias("s")))  # else each bit works them out anew
    return b.select("item_id", F.size("s").alias("n"), "s", _simhash(F.col("s")).alias("f"))


def _counts(s: Column) -> Column:
    """How often each value of a sorted list occurs, as a weight: map from hash to count."""
    d = F.array_distinct(s)
    return F.map_from_arrays(d, F.transform(d, lambda x: F.size(F.filter(s, lambda y: y == x))))


def _common(w: Column, t: Column) -> Column:
    """The sum of the smaller counts of the values of two lists."""
    cw, ct = _counts(w), _counts(t)
    least = F.aggregate(F.map_keys(cw), F.lit(0), lambda a, x: a + F.least(F.element_at(cw, x), F.coalesce(F.try_element_at(ct, x), F.lit(0))))
    once = (F.size(F.array_distinct(w)) == F.size(w)) | (F.size(F.array_distinct(t)) == F.size(t))
    return F.when(once, F.size(F.array_intersect(w, t))).otherwise(least)


def _starts(similarity: float) -> Column:
    """Where a window of n shingles may be similar to an item: p has the sorted places of the item's shingles in a document of len shingles.

    A full window needs 2 * similarity / (1 + similarity) * n of them, one that the document's end cuts off similarity * n.
    """
    p, n, size = F.col("p"), F.col("n"), F.size("p")
    need = F.greatest(F.ceil(n * (2 * similarity / (1 + similarity)) - 1e-9).cast("int"), F.lit(1))
    short = F.greatest(F.ceil(n * similarity - 1e-9).cast("int"), F.lit(1))
    none = F.array().cast("array<int>")

    def between(lo: Column, hi: Column) -> Column:
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)

    full = F.transform(
        F.sequence(F.lit(0), size - need),
        lambda i: between(F.greatest(F.get(p, i + need - 1) - n + 1, F.lit(0)), F.least(F.get(p, i), F.col("len") - n)),
    )
    full = F.when(size >= need, F.flatten(full)).otherwise(none)
    cut = F.when(size >= short, between(F.greatest(F.col("len") - n + 1, F.lit(0)), F.get(p, size - short))).otherwise(none)
    return F.array_distinct(F.concat(full, cut))


def _short(texts: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """Items of fewer than five words, which are one shingle each, where they stand in a document; None if there is no such item."""
    items = benchmark.where("item_id is not null").select("item_id", _words(F.col("text")).alias("w"))
    items = materialize(items.where(F.size("w").between(1, N - 1)).select("item_id", F.size("w").alias("k"), F.xxhash64("w").alias("h")))
    sizes = [r.k for r in items.select("k").distinct().collect()]  # four at most
    if not sizes:
        return None
    words = texts.select("doc_id", _words(F.col("text")).alias("w"))

    def runs_of(k: int) -> Column:
        starts = F.when(F.size("w") >= k, F.sequence(F.lit(1), F.size("w") - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(k).alias("k"), (i - 1).alias("at"), F.xxhash64(F.slice("w", i, k)).alias("h")))

    runs = F.flatten(F.array(*[runs_of(k) for k in sizes]))
    found = words.select("doc_id", F.explode(runs).alias("r")).select("doc_id", "r.k", "r.at", "r.h").join(small(items), ["k", "h"])
    at = found.groupBy("doc_id", "item_id", "k").agg(F.sort_array(F.collect_set("at")).alias("at"))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    apart = F.aggregate("at", none, lambda a, x: F.when(x >= a.end, F.struct((x + F.col("k")).alias("end"), (a.n + 1).alias("n"))).otherwise(a))
    return at.select("doc_id", "item_id", apart.n.alias("n_windows"), F.array_min("at").cast("long").alias("first_word"), F.lit(1.0).alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, n_windows, first_word, similarity: the items that stand in a document, and how well the best window fits.

    n_windows is the number of similar windows that do not overlap, from the left; first_word is where the best window of the first place starts.
    Windows of an item are as long as the item, so what is found of it does not depend on the others. A shingle's weight is how often it occurs in the text; similarity is the sum of the smaller weights over the sum of the larger. Words
    are lower-cased. An item of fewer than five words is one shingle, and its windows are runs of as many words; null and empty texts and items hold
    nothing; rows without an id are left out; a similarity of just the threshold counts; rows that repeat an id are one document. Windows that repeat within or across documents are compared once.
    """
    items = materialize(items_of(benchmark))
    own = items.select("item_id", "n", F.explode("s").alias("h"))
    held_by = materialize(own.select("h", "item_id", "n").distinct())
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.select("doc_id", _words(F.col("text")).alias("w"))
    found = found.select("doc_id", _shingles(F.col("w")).alias("s"))  # of a column: an expression would be worked out for each word
    # outer: else the optimizer filters on the whole expression first. The documents' shingles meet the items': only those in common go on
    at = found.select("doc_id", F.size("s").alias("len"), F.posexplode_outer("s").alias("pos", "h"))
    at = materialize(at.join(small(materialize(held_by.select("h").distinct())), "h", "left_semi"))
    places = at.join(small(held_by), "h").groupBy("doc_id", "len", "item_id", "n").agg(F.sort_array(F.collect_list("pos")).alias("p"))
    starts = places.select("doc_id", F.explode(_starts(similarity)).alias("start"), "n").groupBy("doc_id", "start", "n").agg(F.lit(1).alias("one"))
    wanted = materialize(starts.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("at")))
    n_docs, n_starts = wanted.agg(F.count("*"), F.coalesce(F.sum(F.size("at")), F.lit(0))).first()
    held = texts.join(F.broadcast(wanted) if 64 * n_docs + 16 * n_starts <= BROADCAST_BYTES else wanted, "doc_id").select("doc_id", "at", _words(F.col("text")).alias("w"))
    held = held.select("doc_id", "at", _shingles(F.col("w")).alias("s"))
    windows = held.select("doc_id", F.explode("at").alias("a"), "s").select("doc_id", "a.start", "a.n", F.slice("s", F.col("a.start") + 1, F.col("a.n")).alias("w"))
    windows = materialize(windows.where("size(w) > 0").select("doc_id", "start", "n", "w", F.xxhash64("n", "w").alias("k")))
    distinct = materialize(windows.groupBy("k", "n").agg(F.first("w").alias("w")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prints = materialize(distinct.repartition(parts, "k").select("k", "n", _simhash(F.col("w")).alias("f")))

    near = F.array([F.lit(x) for x in range(256) if bin(x).count("1") <= radius // BLOCKS])
    # a window is compared with items of its own length, so an item's result doesn't depend on the others
    index = items.select("item_id", "n", F.col("f").alias("g"), F.col("s").alias("t"), F.posexplode(F.array(*[_block(F.col("f"), k) for k in range(BLOCKS)])).alias("b", "v"))
    index = index.select("item_id", "n", "g", "b", F.explode(F.transform(near, lambda x: x.bitwiseXOR(F.col("v")))).alias("v"))
    probe = prints.select("k", "n", "f", F.posexplode(F.array(*[_block(F.col("f"), k) for k in range(BLOCKS)])).alias("b", "v"))
    pairs = probe.join(small(materialize(index)), ["b", "v", "n"]).where(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius)
    pairs = pairs.select("k", "item_id").distinct()
    both = pairs.join(distinct.drop("n"), "k").join(items.select("item_id", F.col("s").alias("t")), "item_id")
    both = both.select("k", "item_id", _common(F.col("w"), F.col("t")).alias("c"), F.size("w").alias("nw"), F.size("t").alias("nt"))
    both = both.select("k", "item_id", "nt", (F.col("c") / (F.col("nw") + F.col("nt") - F.col("c"))).alias("similarity")).where(F.col("similarity") >= similarity)
    hits = windows.select("doc_id", "start", "k").join(materialize(both), "k")
    hits = hits.groupBy("doc_id", "item_id", "nt").agg(F.sort_array(F.collect_set(F.struct(F.col("start").cast("long").alias("start"), "similarity"))).alias("at"))
    words = F.col("nt") + (N - 1)
    none = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    apart = F.aggregate("at", none, lambda a, x: F.when(x.start >= a.end, F.struct((x.start + words).alias("end"), (a.n + 1).alias("n"))).otherwise(a))
    first = F.filter("at", lambda x: x.start < F.get("at", F.lit(0)).start + words)
    best = F.array_min(F.transform(first, lambda x: F.struct((-x.similarity).alias("least"), x.start.alias("start"))))
    long = hits.select("doc_id", "item_id", apart.n.alias("n_windows"), best.start.alias("first_word"), F.array_max("at.similarity").alias("similarity"))
    few = _short(texts, benchmark)
    return long if few is None else long.unionByName(few)


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no item, columns as they came; rows without an id stay, as do null and empty texts; rows that repeat an id go together."""
    bad = small(materialize(leaks(docs, benchmark, similarity).select(F.col("doc_id").alias("bad_id")).distinct()))
    return docs.join(bad, docs["doc_id"].cast("long") == bad["bad_id"], "left_anti")

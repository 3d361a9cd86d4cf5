"""Line dedup: lines that spread over many sites are boilerplate and go.

A HyperLogLog sketch of the sites is kept for each line's hash; sketches merge as they are aggregated. Where the estimate is clear
of the threshold it decides, near it the sites are counted exactly. Only then are lines taken out of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, small

MIN_SITES = 8
#: The estimate decides where it is further from the threshold than this share of it (about ten standard errors).
NEAR = 0.2
LG_K = 12


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    return F.xxhash64(line)


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """Hashes of the lines that at least `min_sites` distinct sites hold. Blank lines never are; a null site is no site."""
    lines = docs.select(F.col(site).cast("string").alias("site"), F.explode_outer(F.array_distinct(_lines(F.col("text")))).alias("line"))
    lines = lines.where("site is not null and trim(line) <> ''").select("site", _key(F.col("line")).alias("h"))
    spread = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    guess = materialize(
        spread.select("h", F.hll_sketch_estimate("sketch").alias("n")).where(F.col("n") >= min_sites * (1 - near))
    )
    close = guess.where(F.col("n") <= min_sites * (1 + near)).select("h")
    exact = lines.join(small(materialize(close)), "h").groupBy("h").agg(F.count_distinct("site").alias("n"))
    return guess.where(F.col("n") > min_sites * (1 + near)).select("h").union(exact.where(F.col("n") >= min_sites).select("h"))


def _marked(docs: DataFrame, site: str, min_sites: int, near: float) -> DataFrame:
    """The documents' ids with the hashes of their boilerplate lines; documents without any are absent."""
    bad = small(materialize(boilerplate(docs, site, min_sites, near)))
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("__id"), F.explode_outer(F.transform(_lines(F.col("text")), _key)).alias("h"))
    return own.join(bad, "h", "left_semi").groupBy("__id").agg(F.collect_set("h").alias("__bad"))


def _kept(text: Column, bad: Column) -> Column:
    """The lines that stay: all, where nothing but blank lines would be left."""
    lines = _lines(text)
    good = F.filter(lines, lambda x: ~F.array_contains(bad, _key(x)))
    return F.when(F.exists(good, lambda x: F.trim(x) != ""), good).otherwise(lines)


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """The documents without boilerplate lines, columns as they came.

    A null text stays null, an empty one empty. A document in which every non-blank line is boilerplate is a copy as a whole and stays as it
    is, so none is emptied; which copy is kept is for a stage on near duplicates to say. A line is spread or not, so there are no ties. Rows without
    an id stay as they are; rows that repeat an id lose the boilerplate of any of them. Very long texts are cut as any other.
    """
    marked = materialize(_marked(docs, site, min_sites, near)).hint("merge")
    joined = docs.join(marked, docs["doc_id"].cast("long") == marked["__id"], "left")
    cleaned = F.when(marked["__bad"].isNull(), docs["text"]).otherwise(F.array_join(_kept(docs["text"], marked["__bad"]), "\n"))
    return joined.select(*[cleaned.alias(c) if c == "text" else docs[f"`{c}`"] for c in docs.columns])


def digest(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_kept (lines that stay) and a digest of the text that stays, of every document."""
    n = lambda c: F.size(_lines(F.col(c))).cast("long")
    return cleaned.select(
        "doc_id", n("text").alias("n_kept"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), bad AS (
  SELECT line FROM lines WHERE trim(line, ' ') <> '' AND source IS NOT NULL
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM lines WHERE line NOT IN (SELECT line FROM bad) GROUP BY doc_id HAVING bool_or(trim(line, ' ') <> '')
)
SELECT d.doc_id, coalesce(k.n, len(string_split(coalesce(d.text, ''), chr(10))))::BIGINT AS n_kept,
       sha256(coalesce(k.text, d.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

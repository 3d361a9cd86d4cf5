"""From raw documents to packed training sequences, stage by stage; each stage reads what its predecessor kept.

Every stage takes any table with doc_id and text (the first ones source too), further columns under any names, an empty one included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontam, line_dedup, ngram_join, packing, quality
from tidewatch.llm.shared import materialize
from tidewatch.llm.tokens import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored as empty ones; a score of just 0.5 stays; rows that repeat an id, or have none, are judged each for itself.
    """
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that spread over many sites go; n_chars follows the text.

    Null and empty texts stay as they are, as do rows without an id and documents that hold nothing but such lines; rows that repeat an id lose the lines of any.
    """
    cleaned = line_dedup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id.

    Null and empty texts are in no group and stay, as do rows without an id; rows that repeat an id stay or go together.
    """
    return ngram_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay, as do rows without an id; a similarity of just 0.8 goes; rows that repeat an id go together.
    """
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes sequences of token ids.

    A null or empty text is its end id alone; rows that repeat an id, or have none, are documents of their own.
    """
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The classifier and the fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

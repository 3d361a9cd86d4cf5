"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, embed_dedup, hard_negatives, line_dedup, ngram_join, packing, pieces, pii, quality, substring, token_file, vector_codes
from .tokens import tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-7, 0, "user", chat.TRICKY), (-7, 1, "assistant", chat.TRICKY)]
    rows = rows.union(spark.createDataFrame(added, rows.schema))
    return chat.digest(chat.format_chat(chat.canonical(rows)))


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(_table(spark, sf_dir, "documents")))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.cut_repeats(_table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.withColumn("held_out", quality.held_out(scored.doc_id)).select("doc_id", "held_out", "score", "predicted")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.digest(pii.detect(docs, pii.train(docs)))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_file(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op9_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_dedup(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, ids=False)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    return pieces.digest(pieces.decode(pieces.encode(_table(spark, sf_dir, "documents"), model), model))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(*vector_codes.compress(_table(spark, sf_dir, "embeddings")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings").withColumn("label", label))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_chat": op2_chat,
        "op3_decontam": op3_decontam,
        "op4_line_dedup": op4_line_dedup,
        "op5_substring": op5_substring,
        "op6_quality": op6_quality,
        "op7_pii": op7_pii,
        "op8_token_file": op8_token_file,
        "op9_embed_dedup": op9_embed_dedup,
        "op10_packing": op10_packing,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_vector_codes": op12_vector_codes,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": chat.ORACLE_SQL, "op4_line_dedup": line_dedup.ORACLE_SQL, "op12_vector_codes": vector_codes.ORACLE_SQL, "op13_hard_negatives": hard_negatives.ORACLE_SQL}

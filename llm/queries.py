"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    decontaminate, hard_negatives, language_id, lexical_search, line_dedup, near_dedup, neighbours, packing, ppm, quality, token_counts,
    token_output, warc,
)
from llm.common import fold, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 4) == 2
    found = language_id.predict(docs, language_id.fit(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), *found.columns[1:])


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 5) == 0
    positives = quality.trusted(docs.where(~held), table(spark, sf_dir, "labels"))
    found = quality.predict(docs, quality.fit(docs.where(~held), positives))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("fold", fold(F.col("doc_id"), 7))
    scored = ppm.score(docs, train="fold <> 2")
    return scored.select("doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), *scored.columns[1:])


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.top_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language_id": op2_language_id,
    "op3_quality": op3_quality,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_near_dedup": op5_near_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_line_dedup": op8_line_dedup,
    "op9_neighbours": op9_neighbours,
    "op10_token_output": op10_token_output,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc": op12_warc,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES: dict[str, str] = {
    "op8_line_dedup": line_dedup.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE, "op12_warc": warc.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}

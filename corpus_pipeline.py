"""Documents to packed token sequences: quality, line dedup, near-dedup, decontamination, packing.

Every stage works on all rows that its predecessor kept and returns the columns of ``documents``; the last returns
pieces of packed sequences. ``run`` stores each stage's rows in the shared scratch folder before the next one reads them.

Defined cases, of every stage: a null text counts as empty and stays null where the stage returns texts; very long texts are
worked on whole; repeated rows are treated alike, but near-dedup keeps one of those with one id and text; ties go to the least
id (line dedup: the largest keeps the line); a null id never is the one that a group or line is kept for; an empty table
gives no row; further columns are passed on untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, line_dedup, near_dedup, packing, quality
from llm.common import fold, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects (score below 0.3); labels are learnt as in op3. Without any label nothing goes."""
    taught = docs.where(fold(F.col("doc_id"), 5) != 0)
    model = quality.fit(taught, quality.trusted(taught, table(spark, sf_dir, "labels")))
    return quality.keep(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop shared lines; ``n_chars`` follows the text. A null text stays null."""
    done = line_dedup.dedup_lines(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    changed = {"text": text, "n_chars": F.when(F.col("n_dropped") > 0, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))}
    return done.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least id of each group of near-duplicates; rows without id are in no group."""
    return near_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark; without items, and for null texts, nothing goes."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; a null text is the end token alone."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality), ("line_dedup", drop_lines), ("near_dedup", drop_copies), ("decontamination", drop_leaks), ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Drop lines that many documents share, with DataFrame functions only.

Lines are exploded, normalised (ASCII white space stripped at both ends, A-Z lower-cased) and hashed to 128 bits.
Documents per hash are counted after combining before the shuffle; lines over the threshold are dropped everywhere but
in the largest document id that holds them, and the rest is reassembled by position. Only hashes, ids and positions are
shuffled by line; texts meet their dropped positions once, by document. A line that a third of all rows share is one
row after the count; its occurrences are dealt by (hash, salt).

Defined cases: null or empty text is one empty line; an empty table gives no row; repeated rows count as one document
and are all treated alike; rows with one id but other texts count as one document, each with its own lines; a line held
only under a null id counts no document. Very long texts are one row like others; a line held by several is kept in the largest id, so there
are no ties. Other columns are kept untouched by ``dedup_lines``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 16


def line_key(line: Column) -> Column:
    """``lower`` is exact for ASCII and fast; other lines have only A-Z replaced."""
    inner = F.trim(line, F.lit(SPACE))
    ascii_only = F.length(inner) == F.octet_length(inner)
    return F.when(ascii_only, F.lower(inner)).otherwise(F.translate(inner, UPPER, LOWER))


def dropped_positions(texts: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc, body, dropped): positions of the lines to drop, for documents that lose any."""
    lines = texts.select("doc", "body", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(
        "doc", "body", "pos", line_key(F.col("line")).alias("key")
    )
    hashed = lines.where(F.length("key") >= min_chars).select(
        "doc", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    holders = hashed.where(F.col("doc").isNotNull()).groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    shared = (
        holders.groupBy("h1", "h2").agg(F.count("one").alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = hashed.withColumn("salt", F.pmod(F.xxhash64("doc", "pos"), F.lit(SALTS)).cast("int"))
    lost = salted.join(shared, ["h1", "h2", "salt"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc", "body").agg(F.collect_set("pos").alias("dropped"))


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(row, n_lines, n_dropped, kept): ``row`` is the whole input row, ``kept`` its text without the dropped lines."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct("*").alias("row"),
    ).withColumn("body", F.xxhash64("text"))
    lost = dropped_positions(texts.select("doc", "body", "text"), min_chars, min_docs)
    matched = texts.alias("t").join(
        lost.alias("l"), F.col("t.doc").eqNullSafe(F.col("l.doc")) & (F.col("t.body") == F.col("l.body")), "left"
    )
    lines = F.split("text", "\n")
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.concat_ws("\n", F.transform(F.array_except(places, "dropped"), lambda i: F.get(lines, i)))
    return matched.select(
        "row", F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )


ORACLE = """
WITH doc AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM doc
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

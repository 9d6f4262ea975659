"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed letter n-grams (one to three letters, word ends included). Each language
has several centroids, found by spherical k-means on a bounded sample of its labelled texts (about ``sample`` rows a
language, chosen by a hash of the id); document frequencies cover all training texts. A text gets the language of the
centroid nearest by cosine; it is marked ``rejected`` when it lies farther from that centroid than nearly all of the
centroid's own texts. The model has ``languages * clusters * DIMENSIONS`` numbers.

Defined cases: null text, or text without a letter: ``und``, score 0, not rejected; no training text: ``und`` for all;
an empty table gives no row; repeated rows are repeated; very long texts are read whole, one at a time; of equally near
centroids the first by (language, reach) counts; only the id, text and label columns are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tokens import slices

DIMENSIONS = 4096
UNKNOWN = "und"
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(texts: list[str]) -> np.ndarray:
    """Rows of hashed n-gram counts, one per text; a text without a letter has an empty row."""
    pieces = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    out = np.zeros((len(texts), DIMENSIONS))
    for at in range(0, len(texts), 256):
        part = pieces[at : at + 256]
        symbols = np.concatenate([x for p in part for x in (p, np.zeros(1, np.uint32))])
        row = np.repeat(np.arange(len(part)), [len(p) + 1 for p in part])
        letter = _letters()[symbols]
        symbols = np.where(letter, symbols, 0)
        keep = np.append(True, letter[1:] | letter[:-1])  # runs of other characters shrink to one gap
        symbols, row = symbols[keep], row[keep]
        letter = symbols > 0
        total = np.zeros(len(part) * DIMENSIONS)
        code = symbols * _MIX[0]
        for n in range(3):
            if n:
                code = code[:-1] * _MIX[n] + symbols[n:]
                first = letter[: len(code)] | letter[n:]
                good = first & (row[: len(code)] == row[n:])
            else:
                good = letter
            slot = (code[good] ^ (code[good] >> np.uint32(15))) * _MIX[n]
            total += np.bincount(row[: len(code)][good] * DIMENSIONS + (slot >> np.uint32(20)), minlength=len(total))
        out[at : at + len(part)] = total.reshape(len(part), DIMENSIONS)
    return out


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def _prepared(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all texts, summed over tasks: one row of DIMENSIONS counts each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for _, part in slices(batches):
            df += (gram_counts(part) > 0).sum(axis=0)
            n += len(part)
        yield pa.RecordBatch.from_arrays([pa.array([df.tolist()]), pa.array([n])], ["df", "n"])

    partial = texts.select("text").mapInArrow(count, "df array<long>, n long").select("n", F.posexplode("df").alias("slot", "df"))
    sums = partial.groupBy("slot").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).orderBy("slot").toPandas()
    if sums.empty:
        return np.ones(DIMENSIONS)
    return np.log((1 + sums["n"].to_numpy(float)) / (1 + sums["df"].to_numpy(float))) + 1


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out seeds: centroids, and for each the distance that 99.5 % of its texts keep."""
    seeds = [0]
    for _ in range(1, min(k, len(vectors))):
        seeds.append(int(np.argmin((vectors @ vectors[seeds].T).max(axis=1))))
    centres = vectors[seeds].copy()
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        for c in np.unique(nearest):
            mean = vectors[nearest == c].sum(axis=0)
            centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    away = 1 - (vectors @ centres.T)
    nearest = away.argmin(axis=1)
    own = away.min(axis=1)
    reach = [np.quantile(own[nearest == c], 0.995) if (nearest == c).any() else np.quantile(own, 0.995) for c in range(len(centres))]
    return centres, np.array(reach)


def fit(
    docs: DataFrame, clusters: int = 4, sample: int = 600, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
) -> dict:
    """Model from labelled rows; rows without label or text are left out."""
    rows = _prepared(docs, id_col, text_col, F.col(label_col).cast("string").alias("label")).where("label IS NOT NULL AND text IS NOT NULL")
    idf = document_frequencies(rows)
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {"labels": [], "idf": idf, "centres": np.zeros((0, DIMENSIONS), np.float32), "reach": np.zeros(0)}
    draw = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for label, n in sizes.items() for x in (label, min(1.0, sample / n))])
    chosen = rows.where(draw < share[F.col("label")])

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        counts = gram_counts(group.sort_values("doc_id", kind="stable")["text"].tolist())
        counts = counts[counts.any(axis=1)]
        if not len(counts):
            return pd.DataFrame({"label": [], "reach": [], "centre": []})
        centres, reach = cluster(unit_vectors(counts, idf), clusters)
        return pd.DataFrame({"label": group["label"].iloc[0], "reach": reach, "centre": centres.tolist()})

    found = chosen.groupBy("label").applyInPandas(centroids, "label string, reach double, centre array<double>").orderBy("label", "reach").collect()
    return {
        "labels": [r["label"] for r in found], "idf": idf, "reach": np.array([r["reach"] for r in found]),
        "centres": np.array([r["centre"] for r in found], np.float32).reshape(len(found), DIMENSIONS),
    }


def predict(
    docs: DataFrame, model: dict, sharpness: float = 25.0, slack: float = 1.15, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, lang_pred, score, distance, rejected). ``score`` is the share of the nearest language in a softmax of
    the cosines; a text is rejected beyond ``slack`` times the reach of its centroid."""
    languages = sorted(set(model["labels"]))
    column = np.array([languages.index(x) for x in model["labels"]], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            label = np.full(len(texts), UNKNOWN, object)
            score, distance, rejected = np.zeros(len(texts)), np.ones(len(texts)), np.zeros(len(texts), bool)
            counts = gram_counts(texts)
            good = np.flatnonzero(counts.any(axis=1)) if languages else np.zeros(0, int)
            if len(good):
                cosine = unit_vectors(counts[good], model["idf"]) @ model["centres"].T
                best = np.full((len(good), len(languages)), -1.0)
                for c, lang in enumerate(column):
                    best[:, lang] = np.maximum(best[:, lang], cosine[:, c])
                power = np.exp(sharpness * (best - best.max(axis=1, keepdims=True)))
                nearest = cosine.argmax(axis=1)
                label[good] = np.array(languages, object)[column[nearest]]
                score[good] = power.max(axis=1) / power.sum(axis=1)
                distance[good] = 1 - cosine.max(axis=1)
                rejected[good] = distance[good] > slack * model["reach"][nearest]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(label, pa.string()), pa.array(score), pa.array(distance), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "distance", "rejected"],
            )

    return _prepared(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, distance double, rejected boolean")

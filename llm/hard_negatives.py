"""Hard negatives by angular triangle filtering: exact integer scores only where bounds from stored angles allow a hit.

Every vector's angles to ``REFERENCES`` directions are stored once. By the triangle inequality of angles, two vectors with
angles p and q to a direction enclose an angle between ``|p - q|`` and ``p + q``; its cosine times both norms bounds their
inner product. Angles are widened by ``slack`` and products by ``pad`` before they are compared, more than rounding can
amount to, so a row is left out only if its integer score cannot count.

Rows lie in blocks of about ``BLOCK`` rows: cells of (label group, nearest direction, slice of the angle to it) in order,
large ones split by a hash of the id. A block's ranges of angles and norms decide which anchors are sent to it; anchors go in turns of
about ``TURN``, cut along the same cells. In a block, rows are sorted by one angle, an anchor's window of it is found by
binary search, the other angles are checked within the window, and what remains is scored by integer products. A bounded
sample of rows (the one that gives the directions) gives each anchor a first threshold, so blocks answer with few rows.

Two rounds: the best rows of an anchor's own label are its positives; each positive's score sets the window of scores in
which rows of other labels are its negatives. Answers of a block are cut to the rows asked for before they are merged.

What leaves the tasks: the sample (``SAMPLE`` rows, fewer of long vectors), a row per cell (bounded by label groups, directions and
slices) and the ranges of the blocks (``MAX_BLOCKS`` at most; beyond so many, blocks grow).

Defined cases: rows with a null id, label or vector, with a null or non-finite component, or one of 2^17 or more (its
products could leave 64 bits) take no part, nor do vectors of another length than most, or empty ones; rows of one id are
one row, the least by (label, vector); zero vectors score 0; equal scores go by ascending id; fewer rows than asked for:
all of them; an empty table gives no row; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored

REFERENCES = 12
SLICES = 32
GROUPS = 16  # of labels
SAMPLE = 4_096
SAMPLE_CELLS = 1_000_000  # components of the sample at most, about
BLOCK = 16_384
MAX_BLOCKS = 65_536
TURN = 32_768
SIDE = "vec_id long, label long, v array<int>, norm double, angles array<double>"
HIT = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
LEAST = -(1 << 62)


def usable(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, v): one row per id that takes part; ``v`` holds floor(scale * component)."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(_whole("x"), F.lit(False)))
    one = rows.select("vec_id", F.struct("label", F.transform("x", lambda x: F.floor(x * scale).cast("int")).alias("v")).alias("row"))
    return one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def _whole(name: str) -> Column:
    return F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 17))) & (F.size(name) > 0)


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def directions(x: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Unit vectors at the middles of groups of directions."""
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0, None]
    if not len(x):
        return np.zeros((count, x.shape[1]))
    out = x[np.linspace(0, len(x) - 1, count).astype(int)]
    for _ in range(rounds):
        near = np.argmax(x @ out.T, axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        out = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), out)
    return out


def angles_to(x: np.ndarray, norm: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ refs.T / np.maximum(norm, 1e-300)[:, None], -1, 1))


def slack(width: int) -> float:
    """More than an angle from a rounded cosine can be off: arccos turns an error e near 1 into sqrt(2 e)."""
    return 4 * np.sqrt(2 * max(width, 8) * 2.3e-16)


def bounds(near: np.ndarray, far: np.ndarray, least_norm, most_norm, own_norm, off: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score at an angle between ``near`` and ``far`` of a vector with a norm in the given range."""
    high, low = np.cos(np.clip(near - off, 0, np.pi)), np.cos(np.clip(far + off, 0, np.pi))
    pad = 1 + 1e-9 * own_norm * most_norm
    return own_norm * np.where(low >= 0, least_norm, most_norm) * low - pad, own_norm * np.where(high >= 0, most_norm, least_norm) * high + pad


def products(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through doubles where all sums stay below 2^53."""
    if np.abs(x).max(initial=0) * np.abs(a).max(initial=0) * len(a) < 2**53:
        return (x @ a).astype(np.int64)
    return (x.astype(np.int64) * a.astype(np.int64)).sum(axis=1)


def first_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by id."""
    if len(ids) > 4 * k:
        some = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Model:
    """Directions and the sample: what every task knows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.width = x.shape[1]
        self.refs = directions(x.astype(np.float64), REFERENCES)

    def angles(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norm = np.linalg.norm(x, axis=1)
        return norm, angles_to(x, norm, self.refs)


def fit(rows: DataFrame) -> Model | None:
    """From about ``SAMPLE`` rows, drawn by a hash of the id, of the most frequent width."""
    shape = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if shape is None:
        return None
    size = max(64, min(SAMPLE, SAMPLE_CELLS // shape["d"]))
    draw = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where((F.size("v") == shape["d"]) & (draw < min(1.0, size / shape["n"]))).orderBy("vec_id").toArrow()
    return Model(drawn.column("vec_id").to_numpy(), drawn.column("label").to_numpy(), matrix(drawn.column("v"), shape["d"], np.int32))


def with_angles(rows: DataFrame, model: Model) -> DataFrame:
    """Rows with norm, angles and cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm, angles = model.angles(matrix(batch.column("v"), model.width))
            home = angles.argmin(axis=1)
            part = np.minimum(angles.min(axis=1) / np.pi * SLICES * 2, SLICES - 1).astype(np.int64)
            cell = (batch.column("label").to_numpy() % GROUPS * REFERENCES + home) * SLICES + part
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), pa.array(list(angles), pa.list_(pa.float64())), pa.array(cell)],
                ["vec_id", "label", "v", "norm", "angles", "cell"],
            )

    return rows.where(F.size("v") == model.width).mapInArrow(run, SIDE + ", cell long")


def layout(sizes: dict[int, int], block: int) -> tuple[dict[int, tuple[int, int]], int]:
    """(first block, number of blocks) of each cell, and the number of all blocks: neighbouring cells of a label group
    share a block, a large one has several of its own."""
    out, at, room, group = {}, -1, 0, None
    for cell in sorted(sizes):
        n = sizes[cell]
        if n > block:
            parts = -(-n // block)
            out[cell] = (at + 1, parts)
            at, room = at + parts, 0
        else:
            if n > room or cell // (REFERENCES * SLICES) != group:
                at, room = at + 1, block
            out[cell] = (at, 1)
            room -= n
        group = cell // (REFERENCES * SLICES)
    return out, at + 1


class Blocks:
    """Ranges of angles and norms of all blocks, and their label groups."""

    def __init__(self, rows: DataFrame):
        low = [F.min(F.col("angles")[j]) for j in range(REFERENCES)]
        high = [F.max(F.col("angles")[j]) for j in range(REFERENCES)]
        found = rows.groupBy("block").agg(F.min("norm"), F.max("norm"), F.min("cell"), *low, *high).toPandas().to_numpy(np.float64)
        self.names, self.least, self.most = found[:, 0].astype(np.int64), found[:, 1], found[:, 2]
        self.group = found[:, 3].astype(np.int64) // (REFERENCES * SLICES)
        self.low, self.high = found[:, 4 : 4 + REFERENCES], found[:, 4 + REFERENCES :]

    def overlapping(self, norm: float, angles: np.ndarray, need: float, most: float, off: float) -> np.ndarray:
        """Blocks that may hold a score between ``need`` and ``most``."""
        near = np.maximum(self.low - angles, angles - self.high).max(axis=1)
        low, high = bounds(np.maximum(near, 0), (self.high + angles).min(axis=1), self.least, self.most, norm, off)
        return np.flatnonzero((high >= need) & (low <= most))


def windows_of(positives: list[tuple[int, int]], low_pct: int, high_pct: int) -> list[tuple[int, int, int, int]]:
    """(positive, its score, least, most score of its negatives); positives whose window is empty are left out."""
    found = [(p, s, -(-low_pct * s // 100), high_pct * s // 100) for p, s in positives]
    return [w for w in found if w[2] <= w[3]]


class Asker:
    """Chooses, for each anchor, thresholds from the sample and the blocks it is sent to."""

    def __init__(self, model: Model, blocks: Blocks, k: int, window: tuple[int, int] | None):
        self.model, self.blocks, self.k, self.window = model, blocks, k, window

    def wants(self, i: int, label: int, a: np.ndarray, positives: list[dict] | None) -> list[tuple[int, int, int, int]]:
        """Windows (positive, its score, least, most): one of the anchor itself where positives are looked for."""
        m = self.model
        score = products(m.x.astype(np.float64), a)
        if self.window is None:
            rest = score[(m.labels == label) & (m.ids != i)]
            return [(i, 0, int(np.partition(rest, -self.k)[-self.k]) if len(rest) >= self.k else LEAST, -LEAST)]
        rest, out = score[m.labels != label], []
        for p, s, low, high in windows_of([(x["vec_id"], x["score"]) for x in positives or []], *self.window):
            inside = rest[(rest >= low) & (rest <= high)]
            out.append((p, s, max(low, int(np.partition(inside, -self.k)[-self.k]) if len(inside) >= self.k else low), high))
        return out

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        off = slack(self.model.width)
        for batch in batches:
            x, angles = matrix(batch.column("v"), self.model.width), matrix(batch.column("angles"), REFERENCES)
            ids, labels, norms = (batch.column(c).to_pylist() for c in ("vec_id", "label", "norm"))
            given = batch.column("positives").to_pylist() if self.window else [None] * len(ids)
            row, block, wants = [], [], []
            for i in range(len(ids)):
                mine = self.wants(ids[i], labels[i], x[i], given[i])
                if not mine:
                    continue
                hit = self.blocks.overlapping(norms[i], angles[i], min(w[2] for w in mine), max(w[3] for w in mine), off)
                if self.window is None:
                    hit = hit[self.blocks.group[hit] == labels[i] % GROUPS]
                row += [i] * len(hit)
                block.append(self.blocks.names[hit])
                wants += [[list(w) for w in mine]] * len(hit)
            columns = [batch.column(c).take(pa.array(row, pa.int64())) for c in ("turn", "vec_id", "label", "v", "norm", "angles")]
            columns += [pa.array(np.concatenate([np.zeros(0, np.int64), *block])), pa.array(wants, pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, ["turn", "vec_id", "label", "v", "norm", "angles", "block", "wants"])


def answer_block(model: Model, k: int, same: bool):
    off = slack(model.width)

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 5]
        if rows.num_rows and anchors.num_rows:
            ids, labels, norm = (rows.column(c).to_numpy() for c in ("vec_id", "label", "norm"))
            x, angles = matrix(rows.column("v"), model.width), matrix(rows.column("angles"), REFERENCES)
            pivot = int(np.ptp(angles, axis=0).argmax())
            order = np.argsort(angles[:, pivot], kind="stable")
            ids, labels, norm, x, angles = ids[order], labels[order], norm[order], x[order], angles[order]
            line, longest = angles[:, pivot].copy(), norm.max()
            a, towards = matrix(anchors.column("v"), model.width), matrix(anchors.column("angles"), REFERENCES)
            for n, (i, label, own, wants) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("vec_id", "label", "norm", "wants")), strict=True)):
                need, most = min(w[2] for w in wants), max(w[3] for w in wants)
                # Rows further off than ``reach`` on one direction score less than needed.
                best = own * longest
                reach = np.arccos(min(1.0, (need - 1 - 1e-9 * best) / best)) + 2 * off if need > -best and best > 0 else np.pi + 1
                s, e = np.searchsorted(line, [towards[n, pivot] - reach, towards[n, pivot] + reach])
                low, high = bounds(
                    np.abs(angles[s:e] - towards[n]).max(axis=1), (angles[s:e] + towards[n]).min(axis=1), norm[s:e], norm[s:e], own, off
                )
                mine = (labels[s:e] == label) & (ids[s:e] != i) if same else labels[s:e] != label
                left = s + np.flatnonzero((high >= need) & (low <= most) & mine)
                score = products(x[left], a[n])
                for p, given, least, top in wants:
                    inside = np.flatnonzero((score >= least) & (score <= top))
                    inside = inside[first_of(ids[left[inside]], score[inside], k)]
                    size = len(inside)
                    out.append([np.full(size, i), np.full(size, p), np.full(size, given), ids[left[inside]], score[inside]])
        return pa.table([np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)], names=[c.split()[0] for c in HIT.split(", ")])

    return run


def best_rows(rows: DataFrame, anchors: DataFrame, model: Model, blocks: Blocks, k: int, window: tuple[int, int] | None = None) -> DataFrame:
    """Rows (``HIT``) that are the ``k`` best of an anchor's window: of its own label without ``window``, else of others."""
    more = "" if window is None else ", positives array<struct<score: long, vec_id: long>>"
    chosen = anchors.select("turn", *[c.split()[0] for c in SIDE.split(", ")], *(["positives"] if more else []))
    sent = chosen.mapInArrow(Asker(model, blocks, k, window), "turn long, " + SIDE + ", block long, wants array<array<long>>")
    sent = stored(sent, "op11-sent")
    pairs = sent.select(F.col("block").alias("block"), F.col("turn").alias("turn")).distinct()
    met = rows.join(pairs, "block").select("block", "turn", *[c.split()[0] for c in SIDE.split(", ")])
    key = ["block", "turn"]
    hits = met.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(answer_block(model, k, window is None), HIT)
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90,
    scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor (``is_anchor``, over vec_id)
    and each of its ``positives`` best rows of its own label, the ``negatives`` best rows of other labels whose score is at least
    ``low_pct`` and at most ``high_pct`` percent of the positive's."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    taking_part = stored(usable(vectors, scale, id_col, label_col, vector_col), "op11-vectors")
    model = fit(taking_part)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    placed = stored(with_angles(taking_part, model), "op11-angles")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    cells, count = layout(sizes, max(BLOCK, -(-sum(sizes.values()) // MAX_BLOCKS)))
    spots = pd.DataFrame([(c, first, parts) for c, (first, parts) in cells.items()], columns=["cell", "first", "parts"])
    spots = vectors.sparkSession.createDataFrame(spots, "cell long, first long, parts long")
    block = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    rows = stored(placed.join(F.broadcast(spots), "cell").withColumn("block", block).drop("first", "parts"), "op11-rows")
    blocks = Blocks(rows)
    asking = rows.where(is_anchor)
    turns = -(-asking.count() // TURN) or 1
    # A turn holds anchors of neighbouring blocks.
    asking = asking.withColumn("turn", F.floor(F.col("block") * turns / count).cast("long"))
    near = stored(best_rows(rows, asking, model, blocks, positives), "op11-positives")
    listed = near.groupBy("anchor_id").agg(F.collect_list(F.struct("score", "vec_id")).alias("positives"))
    taught = asking.join(listed, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found = best_rows(rows, taught, model, blocks, negatives, (low_pct, high_pct))
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pair USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""

"""Approximate nearest neighbours by inner product with balanced posting lists.

Centroids are fitted on a bounded sample (about ``sample`` vectors, drawn by a hash of the vector) by halving along the
direction of most spread at the median, so the lists are balanced. Every vector goes to its nearest centroid's list and,
near a boundary, to those of other centroids whose distance is within the ratio ``overlap`` (at most ``copies`` lists).
Centroids are found by best-first search in an in-memory graph of their neighbours. A query visits the lists whose
centroid is within a ratio of its nearest centroid's distance; that ratio is set on the sample so that the measured
recall reaches ``recall``. Inner product becomes distance by the usual extra coordinate, sqrt(longest norm^2 - norm^2).

Neighbouring lists form ``SHARDS`` shards; a shard is dealt into blocks of bounded size by a hash of the vector id, and
so are its queries, so a list with a third of all rows is many tasks' work. Each block answers each of its queries with
at most ``k`` rows from the lists that the query visits, merged per query after combining. Scores are sums of products
in double precision in the order of the components, the same for equal vectors wherever they lie; a matrix product only
sorts out vectors that cannot be among the ``k``.

Defined cases: vectors that are null, all zero, or hold a null or non-finite component take no part, as query or
candidate, nor do those of another length than most; fewer candidates than ``k``: all of them; an empty table gives no
row; rows with a null id take no part, an id with several rows is
as near as its nearest and comes once; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored

SHARDS = 16
BLOCK = 32_768
QUERY_BLOCK = 512


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows that take part, once each, ``v`` as doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept


class Graph:
    """Centroids with links to their nearest others; ``search`` walks it for many vectors at once."""

    def __init__(self, centres: np.ndarray, links: int = 24):
        self.centres = centres
        self.norms = (centres**2).sum(axis=1)
        near = self.norms[None, :] - 2 * centres @ centres.T + self.norms[:, None]
        np.fill_diagonal(near, np.inf)
        links = min(links, max(len(centres) - 1, 1))
        self.links = np.argsort(near, axis=1, kind="stable")[:, :links]
        # Far links make the graph one piece.
        hops = 1 + np.arange(3) * max(len(centres) // 3, 1)
        self.links = np.concatenate([self.links, (np.arange(len(centres))[:, None] + hops) % len(centres)], axis=1)

    def _distance(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        dots = np.einsum("qd,qnd->qn", x, self.centres[ids])
        return np.sqrt(np.maximum(self.norms[ids] - 2 * dots + (x**2).sum(axis=1)[:, None], 0))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of about ``width`` nearest centroids per row of ``x``, nearest first."""
        n = len(self.centres)
        width = min(width, n)
        rng = np.random.default_rng(7)
        start = np.sort(rng.choice(n, min(n, max(width, 8)), replace=False))
        ids = np.tile(start, (len(x), 1))
        dist = self._distance(x, ids)
        seen = np.zeros((len(x), n), bool)
        seen[:, start] = True
        order = np.argsort(dist, axis=1, kind="stable")
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        opened = np.zeros(ids.shape, bool)
        rows = np.arange(len(x))
        while True:
            # Open the nearest unopened centroid of each row, among its ``width`` best.
            waiting = np.where(opened[:, :width], np.inf, dist[:, :width])
            pick = waiting.argmin(axis=1)
            active = np.flatnonzero(np.isfinite(waiting[rows, pick]))
            if not len(active):
                return ids[:, :width], dist[:, :width]
            opened[active, pick[active]] = True
            fresh = self.links[ids[active, pick[active]]]
            known = seen[active[:, None], fresh]
            seen[active[:, None], fresh] = True
            away = self._distance(x[active], fresh)
            away[known] = np.inf
            # A centroid linked twice from one node counts once.
            twice = np.zeros(fresh.shape, bool)
            order = np.argsort(fresh, axis=1, kind="stable")
            ranked = np.take_along_axis(fresh, order, 1)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            away[twice] = np.inf
            more = np.full((len(x), fresh.shape[1]), np.inf)
            more[active] = away
            who = np.zeros(more.shape, ids.dtype)
            who[active] = fresh
            ids, dist = np.concatenate([ids, who], axis=1), np.concatenate([dist, more], axis=1)
            opened = np.concatenate([opened, np.zeros(more.shape, bool)], axis=1)
            order = np.argsort(dist, axis=1, kind="stable")[:, : max(width, 8)]
            ids, dist, opened = (np.take_along_axis(y, order, 1) for y in (ids, dist, opened))


def halved(x: np.ndarray, size: int) -> np.ndarray:
    """Centres of balanced groups of at most ``size`` rows."""
    groups, done = [x], []
    while groups:
        g = groups.pop()
        if len(g) <= size or not np.ptp(g, axis=0).any():
            done.append(g.mean(axis=0))
            continue
        middle = g - g.mean(axis=0)
        axis = middle[np.argmax((middle**2).sum(axis=1))]
        for _ in range(8):
            axis = middle.T @ (middle @ axis)
            axis /= max(np.linalg.norm(axis), 1e-300)
        order = np.argsort(middle @ axis, kind="stable")
        groups += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
    return np.array(done)


def augmented(x: np.ndarray, longest: float) -> np.ndarray:
    """Candidates: the extra coordinate makes the nearest by distance the largest by inner product."""
    return np.column_stack([x, np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added in the order of the components."""
    out = np.zeros(np.broadcast_shapes(q.shape[:-1], x.shape[:-1]))
    for d in range(q.shape[-1]):
        out += q[..., d] * x[..., d]
    return out


def best_of(asks: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the ``k`` nearest other ids of each query; an id counts by its nearest vector."""
    spare = len(ids) - len(np.unique(ids))
    rough = q @ x.T
    rough[asks[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k + spare:
        least = np.partition(rough, -(k + spare), axis=1)[:, -(k + spare), None]
        margin = 1e-11 * np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1).max()
        row, col = np.nonzero(np.isfinite(rough) & (rough >= least - margin))
    else:
        row, col = np.nonzero(np.isfinite(rough))
    score, found = products(q[row], x[col]), ids[col]
    order = np.lexsort((found, -score, row))
    row, found, score = row[order], found[order], score[order]
    if spare:
        _, first = np.unique(np.stack([row, found]), axis=1, return_index=True)
        keep = np.sort(first)
        row, found, score = row[keep], found[keep], score[keep]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return asks[row[place < k]], found[place < k], score[place < k]


def fit(rows: DataFrame, k: int, sample: int, lists: int, copies: int, overlap: float, recall: float) -> dict | None:
    """Index parameters from a bounded sample: width of the vectors, longest norm, centroids, visiting ratio."""
    shape = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm")
    ).orderBy(F.desc("n"), "d").first()
    if shape is None:
        return None
    draw = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where((F.size("v") == shape["d"]) & (draw < min(1.0, sample / shape["n"]))).dropDuplicates(["v"]).orderBy("vec_id").limit(4 * sample)
    x = np.array([r["v"] for r in drawn.select("v").toLocalIterator()], np.float64).reshape(-1, shape["d"])
    longest = float(np.sqrt(shape["norm"])) * (1 + 1e-12)
    if not len(x):
        return {"d": shape["d"], "longest": longest, "centres": np.zeros((1, shape["d"] + 1)), "ratio": np.inf, "copies": 1, "overlap": overlap, "width": 1}
    model = {"d": shape["d"], "longest": longest, "copies": copies, "overlap": overlap}
    model["centres"] = halved(augmented(x, longest), max(1, -(-len(x) // lists)))
    # The sample as its own queries and candidates: the least ratio that reaches the recall.
    graph, a = Graph(model["centres"]), augmented(x, longest)
    asked = np.arange(0, len(x), max(1, len(x) // 500))[:500]
    queries = x[asked]
    at, _ = homes(graph, a, model)
    owner = np.repeat(np.arange(len(x)), [len(h) for h in at])
    house = np.concatenate(at)
    score = queries @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    top = np.argsort(-score, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    q = np.column_stack([queries, np.zeros(len(queries))])
    away = np.sqrt(np.maximum(graph.norms - 2 * q @ graph.centres.T + (q**2).sum(axis=1)[:, None], 0))
    ratio_to = away / np.maximum(away.min(axis=1, keepdims=True), 1e-12)
    first = np.full((len(queries), len(x)), np.inf)
    for c in np.unique(house):
        mine = owner[house == c]
        first[:, mine] = np.minimum(first[:, mine], ratio_to[:, c : c + 1])
    needed = np.sort(np.take_along_axis(first, top, 1), axis=None)
    model["ratio"] = float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1e-9 if len(needed) else np.inf
    # Lists that a query may visit: half as many again as any query of the sample needs.
    model["width"] = int(1.5 * (ratio_to <= model["ratio"]).sum(axis=1).max()) + 1
    return model


def homes(graph: Graph, a: np.ndarray, model: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """Lists of each vector: its nearest centroid's, and near boundaries further ones."""
    ids, dist = graph.search(a, max(8, model["copies"]))
    near = dist <= model["overlap"] * dist[:, :1]
    near[:, model["copies"] :] = False
    return [i[n] for i, n in zip(ids, near, strict=True)], dist


def top_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 20, sample: int = 20_000, list_size: int = 1000, copies: int = 3,
    overlap: float = 1.03, recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row where ``is_query`` (over vec_id) holds."""
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vector_col)
    total = rows.count()
    lists = max(1, min(sample // 16, total // list_size))
    model = fit(rows, k, sample, lists, copies, overlap, recall)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows, lists_ = rows.where(F.size("v") == model["d"]), len(model["centres"])

    def vectors_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        v = batch.column("v")
        return (v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v).flatten().to_numpy(zero_copy_only=False).reshape(-1, model["d"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph(model["centres"])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found, _ = homes(graph, augmented(vectors_of(part), model["longest"]), model)
                row = np.repeat(np.arange(part.num_rows), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).astype(np.int32)), *(part.column(c).take(pa.array(row)) for c in ("vec_id", "v"))],
                    ["list", "vec_id", "v"],
                )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph(model["centres"])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = vectors_of(part)
                ids, dist = graph.search(np.column_stack([x, np.zeros(len(x))]), model["width"])
                row, col = np.nonzero(dist <= model["ratio"] * np.maximum(dist[:, :1], 1e-12))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row, col].astype(np.int32)), *(part.column(c).take(pa.array(row)) for c in ("vec_id", "v"))],
                    ["list", "vec_id", "v"],
                )

    schema_listed = "list int, vec_id long, v array<double>"
    posted = stored(rows.mapInArrow(assign, schema_listed), "op9-lists")
    asked = stored(rows.where(is_query).mapInArrow(visit, schema_listed), "op9-visits")
    # A shard and its queries become blocks of about BLOCK rows each; SHARDS rows at most are broadcast.
    shard = F.floor(F.col("list") * min(SHARDS, lists_) / lists_).cast("int").alias("shard")
    posted, asked = posted.select(shard, "*"), asked.select(shard, "*")
    sizes = posted.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    visits = asked.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns"))
    plan = F.broadcast(stored(sizes.join(visits, "shard"), "op9-plan"))
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int").alias(n)
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(n)
    dealt = posted.join(plan, "shard").select("shard", spread("blocks"), all_of("turns"), "list", "vec_id", "v")
    asked = asked.join(plan, "shard").select("shard", all_of("blocks"), spread("turns"), "list", "vec_id", "v")

    def answer(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if candidates.num_rows and queries.num_rows:
            at, ids, x = candidates.column("list").to_numpy(), candidates.column("vec_id").to_numpy(), vectors_of(candidates)
            visit_at, asks, q = queries.column("list").to_numpy(), queries.column("vec_id").to_numpy(), vectors_of(queries)
            for c in np.unique(visit_at):
                mine, ours = at == c, np.flatnonzero(visit_at == c)
                if mine.any():
                    for part in range(0, len(ours), QUERY_BLOCK):
                        some = ours[part : part + QUERY_BLOCK]
                        out.append(best_of(asks[some], q[some], ids[mine], x[mine], k))
        query, found, value = (np.concatenate(c) for c in zip(*out, strict=True))
        # A vector in several lists comes once; then the k best of each query.
        order = np.lexsort((found, -value, query))
        query, found, value = query[order], found[order], value[order]
        _, first = np.unique(np.stack([query, found]), axis=1, return_index=True)
        keep = np.sort(first)
        query, found, value = query[keep], found[keep], value[keep]
        top = np.arange(len(query)) - np.searchsorted(query, query) < k
        return pa.table({"query_id": query[top], "vec_id": found[top], "score": value[top]})

    keys = ["shard", "blocks", "turns"]
    hits = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(answer, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(ranked))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

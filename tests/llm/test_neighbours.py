"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import neighbours, queries


def brute(ids, x, asked, k):
    out = {}
    for i in np.flatnonzero(asked):
        score = neighbours.products(x[i], x)
        order = sorted((j for j in range(len(ids)) if ids[j] != ids[i]), key=lambda j: (-score[j], ids[j]))
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) / max(len(w), 1) for q, w in want.items()])


@pytest.mark.parametrize("blocks", [32_768, 300])
def test_recall_and_exact_scores(spark, blocks, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", blocks)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(4000, 16)) + 2 * rng.normal(size=(8, 16))[rng.integers(0, 8, 4000)]) * rng.uniform(0.5, 2, (4000, 1))
    x = x.astype(np.float32).astype(float)
    data = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(5)
    got = found(neighbours.top_neighbours(data, F.col("vec_id") % 20 == 0, k=10, list_size=150))
    want = brute(np.arange(4000), x, np.arange(4000) % 20 == 0, 10)
    assert recall(got, want) >= 0.9
    for q, hits in got.items():
        score = neighbours.products(x[q], x)
        assert [s for _, s in hits] == [score[v] for v, _ in hits] and len(hits) == 10


def test_equal_vectors_and_ties(spark):
    same = [0.6, 0.8, 0.0]
    rows = [(i, same) for i in range(300)] + [(300 + i, [0.0, 0.0, float(i + 1)]) for i in range(5)]
    data = spark.createDataFrame(rows + rows[:40], "vec_id long, embedding array<float>")
    got = found(neighbours.top_neighbours(data, F.col("vec_id") % 100 == 0, k=5, list_size=20))
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5] and [v for v, _ in got[100]] == [0, 1, 2, 3, 4]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [1.0]), (7, [0.5, 0.5]), (20, []), (None, [1.0, 1.0]), (40, [0.0, 2.0])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit("x")).withColumn("v", F.lit(1)).withColumn("block", F.lit(2))
    got = found(neighbours.top_neighbours(data, F.col("vec_id") % 20 == 0))
    assert got == {0: [(7, 0.5), (40, 0.0)], 40: [(7, 1.0), (0, 0.0)]}
    assert neighbours.top_neighbours(data.where("false"), F.lit(True)).count() == 0


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(9)
    centres, x = rng.normal(size=(300, 8)), rng.normal(size=(50, 8))
    graph = neighbours.Graph(centres)
    ids, dist = graph.search(x, 20)
    true = np.linalg.norm(x[:, None] - centres[None], axis=2)
    assert np.mean([len(set(i) & set(np.argsort(t)[:10])) / 10 for i, t in zip(ids, true, strict=True)]) > 0.9
    assert np.allclose(dist, np.take_along_axis(true, ids, 1)) and all(len(set(i)) == 20 for i in ids)


def test_halves_are_balanced():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1024, 6)) ** 3
    centres = neighbours.halved(x, 64)
    assert len(centres) == 16 and neighbours.halved(np.ones((50, 3)), 4).shape == (1, 3)


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = found(queries.op9_neighbours(spark, sf))
    assert recall(got, brute(ids, x, ids % 20 == 0, 20)) >= 0.9

"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import hard_negatives, queries

SCHEMA = "vec_id long, label long, embedding array<float>"


def brute(rows, is_anchor, positives=5, negatives=10):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(x)) for x in v])
        kept[i] = min(row, kept.get(i, row))
    out = []
    for a, (label, v) in kept.items():
        if not is_anchor(a):
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in kept.items() if i != a)
        for s, p, _ in [x for x in scores if x[2] == label][:positives]:
            inside = [(n, i) for n, i, other in scores if other != label and 30 * -s <= 100 * -n <= 90 * -s]
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def f32(x):
    return np.asarray(x, np.float32).astype(float).tolist()


def found(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize(("block", "sample", "turn"), [(16_384, 4_096, 32_768), (120, 100, 7)])
def test_equals_brute_force(spark, block, sample, turn, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "SAMPLE", sample)
    monkeypatch.setattr(hard_negatives, "TURN", turn)
    rng = np.random.default_rng(5)
    label = rng.integers(0, 6, 900)
    x = (rng.normal(size=(900, 12)) * 0.4 + rng.normal(size=(6, 12))[label]) * rng.uniform(0.05, 1.5, (900, 1))
    rows = [(i, int(c), f32(v)) for i, (c, v) in enumerate(zip(label, x))]
    data = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = hard_negatives.mine(data, F.col("vec_id") % 20 == 0)
    assert found(got) == brute(rows, lambda i: i % 20 == 0)


def test_hot_label_of_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    same, near = [0.6, 0.8, 0.0], [0.3, 0.5, 0.1]
    rows = [(i, 1, f32(same)) for i in range(300)] + [(300 + i, 2, f32(near)) for i in range(200)] + [(600, 3, f32([0.0, 0.0, 0.0]))]
    data = spark.createDataFrame(rows, SCHEMA)
    assert found(hard_negatives.mine(data, F.col("vec_id") % 100 == 0)) == brute(rows, lambda i: i % 100 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, None), (2, 1, [nan, 1.0]), (3, 1, [inf, 0.0]), (4, 1, [0.0, 0.0]), (5, 1, [None, 1.0]), (6, None, [1.0, 1.0]),
        (7, 1, [0.5, 0.5]), (8, 2, [0.25, 0.0]), (9, 2, [0.25, 0.0]), (None, 2, [0.3, 0.0]), (100, 2, [-1.0, 0.5]), (8, 2, [0.2, 0.0]), (8, 2, [0.2, 0.0]),
    ]
    data = spark.createDataFrame([(*r, "x", 3, 4) for r in rows], SCHEMA + ", cell string, norm int, turn int")
    want = brute(rows, lambda i: i % 100 == 0)
    assert want and found(hard_negatives.mine(data, F.col("vec_id") % 100 == 0)) == want
    assert hard_negatives.mine(data.where("false"), F.lit(True)).count() == 0
    short = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [1.0, 2.0]), (2, 1, [2.0, 2.0]), (3, 2, [1.0, 1.0])], SCHEMA)
    assert {r["anchor_id"] for r in hard_negatives.mine(short, F.lit(True)).collect()} <= {1, 2, 3}


def test_bounds_enclose_all_products():
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(size=(400, 24)) * rng.uniform(0, 3, (400, 1)))
    x[0] = 0
    x[1] = 3 * x[2]
    model = hard_negatives.Model(np.arange(400), np.zeros(400), x)
    norm, angles = model.angles(x)
    off = hard_negatives.slack(24)
    for i in range(400):
        low, high = hard_negatives.bounds(np.abs(angles - angles[i]).max(axis=1), (angles + angles[i]).min(axis=1), norm, norm, norm[i], off)
        true = hard_negatives.products(x, x[i])
        assert (low <= true).all() and (true <= high).all()


def test_blocks_are_balanced():
    cells, count = hard_negatives.layout({0: 10, 1: 25, 2: 95, 3: 20, 384: 5}, 40)
    assert cells == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 384: (5, 1)} and count == 6


def test_given_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert found(queries.op11_hard_negatives(spark, sf)) == brute(rows, lambda i: i % 100 == 0)

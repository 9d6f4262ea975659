"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import make

from llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in asked.items():
        scored = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def asked(spark, texts):
    return spark.createDataFrame(texts, "item_id long, text string")


@pytest.mark.parametrize(("docs_per_tree", "leaf"), [(8_192, 48), (60, 3)])
def test_equals_brute_force(spark, given, docs_per_tree, leaf, monkeypatch):
    monkeypatch.setattr(lexical_search, "TREE_DOCS", docs_per_tree)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in given.collect()]
    want = brute(rows, [tuple(r) for r in items.collect()])
    assert found(lexical_search.search(given.repartition(3), items)) == want


def test_item_blocks_are_whole(spark, given, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    whole = found(lexical_search.search(given, items))
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 3_000)
    blocks = list(lexical_search.item_blocks(items, "item_id", "text"))
    assert len(blocks) > 2 and sum(map(len, blocks)) == items.count()
    assert found(lexical_search.search(given, items)) == whole


def test_many_equal_documents_go_by_id(spark):
    texts = ["red fox", "red fox", "blue fox jumps"] * 200 + ["green"]
    got = found(lexical_search.search(make(spark, texts), asked(spark, [(1, "Red, FOX!"), (2, "unseen")]), k=5))
    assert [(r[1], r[2]) for r in sorted(got, key=lambda r: r[1])] == [(1, 0), (2, 1), (3, 3), (4, 4), (5, 6)]


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "word5 the same TEXT"), (1, "twice é"), (2, None), (3, "...!?"), (None, "over 日本 a"), (4, "")]
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    want = brute(rows, [i for i in items if terms(i[1])])
    assert found(lexical_search.search(odd_docs, asked(spark, items))) == want
    assert lexical_search.search(no_docs, asked(spark, items)).count() == 0
    assert lexical_search.search(odd_docs, asked(spark, items[2:4])).count() == 0
    assert lexical_search.search(odd_docs, asked(spark, items).where("false")).count() == 0


def test_bounds_hold_and_leaves_partition(monkeypatch):
    monkeypatch.setattr(lexical_search, "LEAF", 4)
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 9, 300)
    terms_ = np.concatenate([rng.choice(30, s, replace=False) for s in sizes])
    times = rng.integers(1, 20, len(terms_))
    tree = lexical_search.Tree(np.arange(300), rng.integers(10, 400, 300), terms_, times, sizes, 30)
    leaves = sorted(tree.nodes[n] for n in range(len(tree.nodes)) if not tree.children[n])
    assert leaves[0][0] == 0 and leaves[-1][1] == 300 and all(a[1] == b[0] for a, b in zip(leaves, leaves[1:]))
    for n, (lo, hi) in enumerate(tree.nodes):
        a, b = tree.starts[lo], tree.starts[hi - 1] + tree.sizes[hi - 1]
        assert (tree.gain[a:b] <= tree.most_gain[n][tree.terms[a:b]]).all()

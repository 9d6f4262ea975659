"""Ranked lexical search: the best documents of each item, by branch and bound in trees of documents.

A term is a maximal run of characters other than ASCII controls, space and punctuation, A-Z lower-cased. Documents are
restricted to the terms of the items at hand and their terms put in order of document frequency, most frequent first;
sorted so, documents with a common beginning share a path of a trie (a document FP-tree). A node is a contiguous range of
the sorted documents; it keeps, over its subtree, the largest number of occurrences of each term and the least length
norm ``m``, hence for any item an upper bound of the score of every document below. Per item the tree is walked depth
first, the child of the highest bound first, and a subtree is left out where its bound cannot reach the item's ``k``
best so far. Siblings of few documents share a leaf; the documents of a leaf are scored exactly.

Two passes over the documents: the first stores the restricted vectors (document frequencies, number and length of all
documents are aggregates of them), the second builds trees of at most ``TREE_DOCS`` documents and ``TREE_TERMS`` of their
terms, whatever the input, and each task answers with at most ``k`` documents an item. Items are a query set: they pass in
blocks of about ``BLOCK_BYTES`` of text, chosen by a hash of their id, so what a task holds of them does not grow.

Scores are integers, by the formula of the operator's contract: a term's weight is floor(1000 * ln((2N + 2) / (2df + 1))),
a document's norm m = 10 + 90 * n * N div L, its score the sum of weight * (10^9 * tf div (1000 * tf + 8 * m)).

Defined cases: null text has no term; documents without a term do not count in N; very long texts are cut into terms
whole; equal scores go by ascending id, a null id last; repeated rows are documents of their own, repeated rows of an
item's id are one item of all their terms, as is a null item id; items without a term, and empty tables, give no row; only the
id and text columns are read, whatever else the tables hold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored
from llm.tokens import slices

BLOCK_BYTES = 1_000_000
TREE_DOCS = 8_192
TREE_TERMS = 2_000_000
LEAF = 48
CELLS = 4_000_000  # of the table of bounds, nodes times terms, about
HIT = "item_id long, doc_id long, score long"
_LOWER = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[dict[int | None, list[bytes]]]:
    """Distinct terms of each item, block by block; one block is on the driver at a time."""
    rows = items.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    blocks = 1 + int(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // BLOCK_BYTES
    for b in range(blocks):
        block: dict[int | None, set[bytes]] = {}
        for r in rows.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).toLocalIterator():
            block.setdefault(r["i"], set()).update(terms_of(r["t"]))
        yield {i: sorted(t) for i, t in block.items() if t}


def vectors(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, times) of each document with a term: all its terms counted, and those in ``numbers``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            n, terms, times = [], [], []
            for text in texts:
                words = terms_of(text)
                found = Counter(filter(numbers.__contains__, words))
                n.append(len(words))
                terms.append([numbers[w] for w in found])
                times.append(list(found.values()))
            columns = [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"]).filter(pa.array(np.array(n, np.int64) > 0))

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<long>")


class Tree:
    """Documents sorted by their frequency-ordered terms, and the nodes of their trie as ranges of that order.

    ``terms`` are ranks by document frequency; ``sizes`` says how many each document has (at least one)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, terms: np.ndarray, times: np.ndarray, sizes: np.ndarray, width: int):
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((terms, owner))
        owner, terms, times = owner[order], terms[order], times[order]
        cuts = np.cumsum(sizes)
        spelled = terms.astype(">u4").tobytes()
        paths = [spelled[4 * a : 4 * b] for a, b in zip((cuts - sizes).tolist(), cuts.tolist(), strict=True)]
        ranked = sorted(range(len(ids)), key=paths.__getitem__)
        place = np.empty(len(ids), np.int64)
        place[ranked] = np.arange(len(ids))
        order = np.argsort(place[owner], kind="stable")
        self.owner, self.terms, self.times = place[owner][order], terms[order], times[order]
        self.ids, self.m, self.sizes = ids[ranked], m[ranked], sizes[ranked]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.gain = gain(self.times, self.m[self.owner])
        self.nodes: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._grow([paths[r] for r in ranked], max(LEAF, 2 * len(ids) * width // CELLS))
        self._bound(width)

    def _grow(self, paths: list[bytes], leaf: int) -> None:
        waiting = [(0, len(paths), 0, -1)]
        while waiting:
            lo, hi, depth, parent = waiting.pop()
            node = len(self.nodes)
            self.nodes.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo <= leaf:
                continue
            first, last = paths[lo], paths[hi - 1]
            while first[depth : depth + 4] == last[depth : depth + 4] and depth < len(first):
                depth += 4
            if depth >= len(first) and first == last:
                # Equal vectors: slices of their documents.
                waiting += [(a, min(a + leaf, hi), depth, node) for a in range(lo, hi, leaf)]
                continue
            begin = at = lo
            while at < hi:
                stop, symbol = at + 1, paths[at][depth : depth + 4]
                while stop < hi and paths[stop][depth : depth + 4] == symbol:
                    stop += 1
                if stop - at > leaf:
                    if at > begin:
                        waiting.append((begin, at, depth, node))
                    waiting.append((at, stop, depth + 4, node))
                    begin = stop
                elif stop - begin > leaf:
                    waiting.append((begin, at, depth, node))
                    begin = at
                at = stop
            if hi > begin:
                waiting.append((begin, hi, depth, node))

    def _bound(self, width: int) -> None:
        """Per node and term the most that a document below can gain: most occurrences with the least norm."""
        most = np.zeros((len(self.nodes), width), np.int64)
        self.least_m, self.least_id = np.zeros(len(self.nodes), np.int64), np.zeros(len(self.nodes), np.int64)
        for node in range(len(self.nodes) - 1, -1, -1):
            lo, hi = self.nodes[node]
            if self.children[node]:
                most[node] = most[self.children[node]].max(axis=0)
            else:
                a, b = self.starts[lo], self.starts[hi - 1] + self.sizes[hi - 1]
                np.maximum.at(most[node], self.terms[a:b], self.times[a:b])
            self.least_m[node], self.least_id[node] = self.m[lo:hi].min(), self.ids[lo:hi].min()
        self.most_gain = gain(most, self.least_m[:, None]).astype(np.float64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores, ids) of earlier trees with what this one adds; k at most, in order."""
        weight = np.zeros(self.most_gain.shape[1], np.int64)
        weight[terms] = weights
        bound = self.most_gain[:, terms] @ weights.astype(np.float64)
        stack = [0]
        while stack:
            node = stack.pop()
            if bound[node] <= 0:
                continue
            if len(best[0]) == k and (bound[node] < best[0][-1] or (bound[node] == best[0][-1] and self.least_id[node] > best[1][-1])):
                continue
            if self.children[node]:
                stack += sorted(self.children[node], key=bound.__getitem__)
                continue
            lo, hi = self.nodes[node]
            a, b = self.starts[lo], self.starts[hi - 1] + self.sizes[hi - 1]
            score = np.add.reduceat(weight[self.terms[a:b]] * self.gain[a:b], self.starts[lo:hi] - a)
            good = np.flatnonzero(score >= (best[0][-1] if len(best[0]) == k else 1))
            if len(good):
                scores, ids = np.concatenate([best[0], score[good]]), np.concatenate([best[1], self.ids[lo:hi][good]])
                top = np.lexsort((ids, -scores))[:k]
                best = scores[top], ids[top]
        return best


def gain(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 8 * m)


def _searcher(asked: dict, rank: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    last = np.iinfo(np.int64).max  # stands for a null id, which comes last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        best, held, terms_held = {i: none for i in asked}, [], 0

        def answer() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows.column("doc_id").fill_null(int(last)).to_numpy()
            m = 10 + 90 * rows.column("n").to_numpy() * n_docs // n_terms
            lists = rows.column("terms").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            flat = rank[lists.flatten().to_numpy()]
            tree = Tree(ids, m, flat, rows.column("times").combine_chunks().flatten().to_numpy(), sizes, len(rank))
            for i, terms in asked.items():
                best[i] = tree.search(terms, weight[terms], best[i], k)
            held.clear()

        for batch in batches:
            at, ends = 0, np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()))
            while at < batch.num_rows:
                room = TREE_TERMS - terms_held + (ends[at - 1] if at else 0)
                stop = min(at + TREE_DOCS - sum(h.num_rows for h in held), int(np.searchsorted(ends, room, "right")))
                stop = max(stop, at + (not held))
                if stop > at:
                    held.append(batch.slice(at, stop - at))
                    terms_held += int(ends[stop - 1] - (ends[at - 1] if at else 0))
                    at = stop
                if at < batch.num_rows:
                    answer()
                    terms_held = 0
        if held:
            answer()
        size = [len(b[0]) for b in best.values()]
        ids = np.concatenate([none[1], *(b[1] for b in best.values())])
        items = pa.array(list(best), pa.int64()).take(pa.array(np.repeat(np.arange(len(best)), size)))
        scores = np.concatenate([none[0], *(b[0] for b in best.values())])
        yield pa.RecordBatch.from_arrays([items, pa.array(ids, mask=ids == last), pa.array(scores)], ["item_id", "doc_id", "score"])

    return run


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest positive score for each item."""
    found = []
    for block in item_blocks(items, item_col, item_text):
        if not block:
            continue
        words = sorted({t for terms in block.values() for t in terms})
        numbers = {w: i for i, w in enumerate(words)}
        rows = stored(vectors(docs, numbers, id_col, text_col), "op13-vectors")
        total = rows.agg(F.count("*"), F.sum("n")).first()
        if not total[0]:
            continue
        df = np.zeros(len(words), np.int64)
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r["t"]] = r["count"]
        order = np.lexsort((np.arange(len(words)), -df))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        weight = np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * int(d) + 1))) for d in df[order]], np.int64)
        asked = {i: np.sort(rank[[numbers[t] for t in terms]]) for i, terms in block.items()}
        # Neighbouring files together, so that a task has about one tree of documents: no shuffle.
        some = rows.where(F.size("terms") > 0).coalesce(1 + total[0] // TREE_DOCS)
        found.append(some.mapInArrow(_searcher(asked, rank, weight, int(total[0]), int(total[1]), k), HIT))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return reduce(DataFrame.union, found).withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH word AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM word GROUP BY doc_id, term
), size AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), norm AS (
  SELECT doc_id, 10 + (90 * n * docs) // words AS m FROM size, total
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN norm USING (doc_id)
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

"""Language-model score of whole texts: prediction by partial matching over bytes, pretrained on the corpus.

A text is its token stream: ASCII-lower-cased words, each followed by a space, then an end symbol (also the padding
before the first byte). The byte-context trie is the table of all (order + 1)-grams of the training streams: shorter
contexts are sums over it. The code length of a symbol starts at the longest context and, while the symbol was never
seen there, pays an escape (method D: each distinct symbol leaves half an occurrence to the unseen) and goes one byte
shorter; symbols of the longer context are excluded from the counts below. Under the empty context all symbols not yet excluded are equal.

Since the model is fixed while scoring, the code length depends on the gram alone. So documents are dealt to chunks of
bounded size by id; a chunk reports each distinct gram and token once with its training count; counts are summed over
all chunks, code lengths are computed per context suffix, and each chunk gets back exactly the part of the trie and of
the token table that it needs. Nothing is broadcast but the order-1 table (at most 257 * 257 rows).

Defined cases: null or empty text is the end symbol alone; an empty table gives no row; with no training text at all
every symbol has probability 1/257 and the base is 0; repeated rows are scored as often as they occur and count that
often in training; very long texts are worked on in batches of 2 MB or of one text; scores of equal texts are equal, so there
are no ties; only the id and text columns are read, whatever others are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored

BITS = 9  # a symbol is a byte + 1, or 0 for the boundary
ALPHABET = 257
ORDER = 4
CHUNK_BYTES = 16_000_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs without the six ASCII white-space bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def grams_of(streams: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """One gram per symbol of all streams (each stream ends with the boundary), and the number of grams of each stream."""
    sizes = np.array([len(s) + 1 for s in streams], np.int64)
    pad = order + 1  # boundaries between streams; the first of them is the end symbol of the stream before
    symbols = np.zeros(int(sizes.sum()) + pad * (len(streams) + 1), np.int64)
    raw = np.frombuffer(b"".join(streams), np.uint8)
    lengths = sizes - 1
    where = np.arange(len(raw)) + np.repeat(pad + np.arange(len(streams)) * pad, lengths)
    symbols[where] = raw.astype(np.int64) + 1
    ends = pad + np.cumsum(lengths) + np.arange(len(streams)) * pad
    used = np.zeros(len(symbols), bool)
    used[where] = True
    used[ends] = True
    gram = np.zeros(len(symbols) - order, np.int64)
    for k in range(order + 1):
        gram = (gram << BITS) | symbols[k : k + len(gram)]
    return gram[used[order:]], sizes


def chunked(docs: DataFrame, train: str, id_col: str, text_col: str) -> DataFrame:
    """(chunk, doc_id, text, train): chunks of about ``CHUNK_BYTES``; their number follows the size of the input."""
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.expr(train).alias("train"),
    )
    total = chosen.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    chunks = 1 + int(total) // CHUNK_BYTES
    # Rows without id, or many rows with one id, are spread by their text as well.
    return chosen.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(chunks)).cast("int"))


class _Tally:
    """Distinct values with their training counts, merged batch by batch."""

    def __init__(self):
        self.values = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, values: np.ndarray, weights: np.ndarray) -> None:
        both = np.concatenate([self.values, values])
        self.values, place = np.unique(both, return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, weights]), len(self.values)).astype(np.int64)


def _batches(group: pa.Table, step: int = 2_000_000) -> Iterator[tuple[pa.Table, list[list[bytes]]]]:
    """Rows of a chunk in batches of about ``step`` bytes, with their words."""
    at, sizes = 0, np.cumsum([len(x) for x in group.column("text").cast(pa.binary()).to_pylist()])
    while at < group.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + step, "right")))
        rows = group.slice(at, end - at)
        yield rows, [words_of(t) for t in rows.column("text").to_pylist()]
        at = end


class _Table:
    """Values by key: one slot per hash, and a sorted list of the few keys whose slot another key has."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        slot = self._slot(keys)
        self.keys[slot], self.values[slot] = keys, values
        lost = np.flatnonzero(self.keys[slot] != keys)
        lost = lost[np.argsort(keys[lost])]
        self.more, self.more_values = keys[lost], values[lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that all are in the table."""
        slot = self._slot(keys)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != keys)
        out[miss] = self.more_values[np.searchsorted(self.more, keys[miss])]
        return out


class _Counts(dict):
    """Training counts; 0 for a token that training has not."""

    def __missing__(self, token: bytes) -> float:
        return 0.0


def _stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b" " if words else b""


def tallies(chunks: DataFrame, order: int) -> DataFrame:
    """(chunk, gram, token, n): each distinct gram (token null) and each distinct token (gram null) of a chunk."""

    def count(group: pa.Table) -> pa.Table:
        grams, learnt, other = _Tally(), Counter(), set()
        for rows, words in _batches(group):
            taught = rows.column("train").to_numpy(zero_copy_only=False).astype(bool)
            new = []
            for learn in (True, False):
                mine = [w for w, t in zip(words, taught, strict=True) if t == learn]
                found, n = np.unique(grams_of([_stream(w) for w in mine], order)[0], return_counts=True)
                new.append((found, n * learn))
                for w in mine:
                    learnt.update(w) if learn else other.update(w)
            grams.add(*map(np.concatenate, zip(*new, strict=True)))
        rest = [w for w in other if w not in learnt]
        g, t = len(grams.values), len(learnt) + len(rest)
        return pa.table({
            "chunk": pa.array(np.full(g + t, group.column("chunk")[0].as_py(), np.int32)),
            "gram": pa.concat_arrays([pa.array(grams.values), pa.nulls(t, pa.int64())]),
            "token": pa.concat_arrays([pa.nulls(g, pa.binary()), pa.array([*learnt, *rest], pa.binary())]),
            "n": pa.array(np.concatenate([grams.counts, np.fromiter(learnt.values(), np.int64, len(learnt)), np.zeros(len(rest), np.int64)])),
        })

    return chunks.groupBy("chunk").applyInArrow(count, "chunk int, gram long, token binary, n long")


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Value of each wanted key among sorted ``keys``, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0).astype(np.float64)


def _counts(codes: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of ``order`` + 1 last symbols, sorted, with their counts."""
    grams, place = np.unique(codes & ((1 << BITS * (order + 1)) - 1), return_inverse=True)
    return grams, np.bincount(place, counts, len(grams))


def code_lengths(codes: np.ndarray, counts: np.ndarray, order: int, low: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Code length in log10 units of each gram in ``codes``. ``codes`` must hold every counted gram that shares the last
    two context symbols of any of them; ``low`` has the counted grams of orders 1 and 0."""
    tables = {j: low[j] if j < 2 else _counts(codes, counts, j) for j in range(order, -1, -1)}
    length, coding = np.zeros(len(codes)), np.ones(len(codes), bool)
    # Of the context one symbol longer: its distinct symbols, and how often these occur in the context at hand.
    excluded, excluded_mass = np.zeros(len(codes)), np.zeros(len(codes))
    for j, (grams, n) in tables.items():
        contexts, of = np.unique(grams >> BITS, return_inverse=True)
        total, distinct = np.bincount(of, n, len(contexts)), np.bincount(of, n > 0, len(contexts))
        gram = codes & ((1 << BITS * (j + 1)) - 1)
        here = gram >> BITS
        seen, symbols = _find(grams, n, gram), _find(contexts, distinct, here)
        fresh = symbols - excluded
        room = _find(contexts, total, here) - excluded_mass
        coded, escaped = coding & (seen > 0), coding & (seen == 0) & (room > 0)
        length[coded] += np.log10(room[coded] / (seen[coded] - 0.5))
        length[escaped] += np.log10(room[escaped] / (0.5 * fresh[escaped]))
        coding &= ~coded
        if j:
            below = _find(*tables[j - 1], grams & ((1 << BITS * j) - 1))
            excluded_mass = _find(contexts, np.bincount(of, below * (n > 0), len(contexts)), here)
        excluded = symbols
    length[coding] += np.log10(np.maximum(ALPHABET - excluded[coding], 1))
    return length


def low_orders(grams: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counted grams of orders 1 and 0: at most 257 * 257 rows reach the driver."""
    pairs = grams.where("n > 0").groupBy(F.col("gram").bitwiseAND((1 << 2 * BITS) - 1).alias("gram")).agg(F.sum("n").alias("n")).toPandas()
    return {j: _counts(pairs["gram"].to_numpy(np.int64), pairs["n"].to_numpy(np.int64), j) for j in (1, 0)}


def score(
    docs: DataFrame, train: str = "true", order: int = ORDER, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score); ``train`` is an SQL condition on ``docs``."""
    chunks = chunked(docs, train, id_col, text_col)
    parts = stored(tallies(chunks, order), "op4-tallies")
    grams = stored(parts.where("token IS NULL").groupBy("gram").agg(F.sum("n").alias("n")), "op4-grams")
    tokens = stored(parts.where("gram IS NULL").groupBy("token").agg(F.sum("n").alias("n")).where("n > 0"), "op4-words")
    ends, n_words, distinct = _totals(chunks, tokens)
    n_train, v = n_words + ends, distinct + (ends > 0)
    low = low_orders(grams)

    def lengths(group: pd.DataFrame) -> pd.DataFrame:
        codes, n = group["gram"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        return pd.DataFrame({"gram": codes, "value": code_lengths(codes, n, order, low)})

    tail = F.shiftright("gram", BITS).bitwiseAND((1 << 2 * BITS) - 1)
    costs = grams.groupBy(tail.alias("tail")).applyInPandas(lengths, "gram long, value double")
    back = (
        parts.where("token IS NULL").select("chunk", "gram").join(costs, "gram")
        .select("chunk", "gram", F.lit(None).cast("binary").alias("token"), "value")
        .unionByName(
            parts.where("gram IS NULL").select("chunk", "token").join(tokens, "token")
            .select("chunk", F.lit(None).cast("long").alias("gram"), "token", F.col("n").cast("double").alias("value"))
        )
    )

    def apply(texts: pa.Table, model: pa.Table) -> pa.Table:
        is_gram = model.column("gram").is_valid()
        g = model.filter(is_gram)
        cost = _Table(g.column("gram").to_numpy(), g.column("value").to_numpy())
        w = model.filter(pc.invert(is_gram))
        count = _Counts(zip(w.column("token").to_pylist(), w.column("value").to_pylist(), strict=True))
        out: dict[str, list] = {x: [] for x in ("doc_id", "n_tokens", "n_known", "base_score", "score")}
        floor = -np.log10(n_train + v + 1)
        end = np.log10(ends + 1)
        for rows, words in _batches(texts):
            found, sizes = grams_of([_stream(x) for x in words], order)
            total = np.add.reduceat(cost.of(found), np.cumsum(sizes) - sizes)
            out["score"].append(-total)
            out["doc_id"].append(rows.column("doc_id").combine_chunks())
            tokens_n = np.array([len(x) for x in words], np.int64)
            seen = np.fromiter(map(count.__getitem__, chain.from_iterable(words)), np.float64, int(tokens_n.sum()))
            doc = np.repeat(np.arange(len(words)), tokens_n)
            gain = np.bincount(doc, np.log10(seen + 1), len(words))
            out["n_tokens"].append(tokens_n + 1)
            out["n_known"].append(np.bincount(doc, seen > 0, len(words)).astype(np.int64) + (ends > 0))
            out["base_score"].append(gain + end + floor * (tokens_n + 1))
        return pa.table({
            "doc_id": pa.concat_arrays(out["doc_id"]),
            "n_tokens": np.concatenate(out["n_tokens"]), "n_known": np.concatenate(out["n_known"]),
            "train_tokens": np.full(texts.num_rows, n_train, np.int64),
            "base_score": np.concatenate(out["base_score"]), "score": np.concatenate(out["score"]),
        })

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(apply, schema)


def _totals(chunks: DataFrame, tokens: DataFrame) -> tuple[int, int, int]:
    """Ends (one per training text), training words, distinct training words."""
    ends = chunks.where("train").count()
    n = tokens.agg(F.sum("n"), F.count("*")).first()
    return ends, int(n[0] or 0), int(n[1])

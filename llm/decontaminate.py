"""Benchmark passages in documents, by edit distance over words.

The CGK random walk turns edit distance into Hamming distance: it reads a word, repeats or passes it by a random bit of
(step, word), and so on; two strings that differ by few edits give outputs that agree in most places. Each repetition
draws its own walk, the share of the item at which it begins (so no fixed word has to be unchanged), and two more places
of its output; an item and an item-sized window around a word of a document that agree on all sampled places are a
candidate. The places are compared one after another, so most windows leave after the first. From an inner word on the walk reads
towards the further end of the item. As places lie near the beginning of the walk, long items are found as well as
short ones: walks drift apart with the edits between.

How many repetitions reach the target recall is measured, per class of item lengths, on mutated random strings with the
most edits that ``similarity`` allows. Only where ``MOST`` repetitions do not reach it, or where no edit is allowed (items of
fewer than five words at 0.8), an item is cut into one segment more than edits are allowed: one stands unchanged, and each
place that spells the first words of a segment is a candidate. Candidates are verified by exact edit distance (best
substring around the window, Sellers' recurrence).

``similarity`` is 1 - edits / words of the item. Items are a query set: they go to the tasks in blocks of about
``BLOCK_BYTES``, one scan of the documents a block, and each task builds its block's index. Defined cases: null or empty texts match
nothing, items without a word neither; very long texts are searched whole, in slices of memory that do not grow with
them; ties go to the first position; repeated items each match, repeated rows give one row per (doc_id, item_id), the best
(a null id counts as one id); empty tables give no row; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tokens import slices
from llm.words import mixed, word_hashes

BLOCK_BYTES = 1_000_000
SEED = 20240229
STEPS = 20  # of a walk
NEAR, FAR = (3, 7), (8, 15)  # steps between which the two sampled places lie
MOST = 64  # repetitions
Table = tuple[bool, np.ndarray, np.ndarray, np.ndarray, list]
SEGMENT_WORDS = 8  # words of a segment that are compared at most
CANDIDATES = 100_000  # candidates that are verified together, about
_STEP = np.uint64(0x9E3779B97F4A7C15)
MATCH = "doc_id long, item_id long, position long, edits int, similarity double"


def draw(repetition: int) -> tuple[float, int, int, np.ndarray]:
    """Of a repetition: the share of the item where the walk begins, two steps at which words are compared besides the
    first, and odd multipliers: the top bit of multiplier * word says whether the walk goes on to the next word."""
    rng = np.random.default_rng(SEED + repetition)
    bits = rng.integers(0, 1 << 63, STEPS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return float(rng.random()), int(rng.integers(*NEAR)), int(rng.integers(*FAR)), bits


def walk(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Index of the word that each step of the embedding reads, up to the last word."""
    out, at = [], 0
    for bit in bits:
        if at == len(words):
            break
        out.append(at)
        at += int((int(words[at]) * int(bit) >> 63) & 1)
    return np.array(out)


class Index:
    """Items of one block, as sampled places of their embeddings, for every repetition.

    Words of the items are numbered from 1; any other word is 0 and agrees with none. A repetition anchors the walk at a
    random share of the item, and reads on from there: forward in its first half, else backward. ``repetitions`` says for
    how many each item takes part; items with 0 are found by their unchanged segments."""

    def __init__(self, ids: list, items: list[np.ndarray], repetitions: np.ndarray, similarity: float):
        self.ids, self.items = ids, items
        self.repetitions = np.asarray(repetitions, np.int64)
        self.vocabulary = np.unique(np.concatenate([np.zeros(1, np.uint64), *items]))
        self.sizes = np.array([len(w) for w in items], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([np.zeros(0, np.uint64), *items])
        self.spelled = np.searchsorted(self.vocabulary, self.flat)
        owners = np.repeat(np.arange(len(items)), self.sizes)
        self.members, self.times = np.unique(owners * len(self.vocabulary) + self.spelled, return_counts=True)
        self.segments = self._segments(similarity)
        self.tables = [self._table(r) for r in range(int(self.repetitions.max(initial=0)))]

    def _table(self, r: int) -> Table:
        """The sampled words of every item of repetition ``r``, by the step of the first of them."""
        share, near, far, bits = draw(r)
        k = np.flatnonzero(self.repetitions > r)
        anchor, back = (share * self.sizes[k]).astype(np.int64), share >= 0.5
        sign, room = (-1, anchor + 1) if back else (1, self.sizes[k] - anchor)
        first = self.begins[k] + anchor
        at, path = np.zeros(len(k), np.int64), []
        for bit in bits:
            path.append(at)
            moved = at + ((self.flat[first + sign * at] * bit) >> np.uint64(63)).astype(np.int64)
            at = np.minimum(moved, room)  # past the last word: the walk has ended
            at = np.where(at == room, room - 1, at)
        path = np.array(path).reshape(len(bits), -1)
        # Where the item ends before a place, its last step counts.
        ended = (path == room - 1).argmax(axis=0) + np.where((path == room - 1).any(axis=0), 0, len(bits))
        b, c = np.minimum(near, ended), np.minimum(far, ended)
        column = np.arange(len(k))
        word = lambda step: self.spelled[first + sign * path[np.minimum(step, len(bits) - 1), column]]
        key, last = self.spelled[first] * len(self.vocabulary) + word(b), word(c)
        known = np.zeros(len(self.vocabulary), bool)
        known[self.spelled[first]] = True
        groups = []
        for step in np.unique(b):
            mine = np.flatnonzero(b == step)
            mine = mine[np.argsort(key[mine], kind="stable")]
            groups.append((int(step), key[mine], last[mine], c[mine], k[mine]))
        return back, bits, known, _spread(k, anchor, len(self.sizes)), groups

    def _segments(self, similarity: float) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By the words compared: hashes of segments in order, their items, and where they begin in these."""
        rows: dict[int, list] = {}
        for k in np.flatnonzero(self.repetitions == 0).tolist():
            words = self.items[k]
            parts = int(allowed_edits(len(words), similarity)) + 1
            size = min(len(words) // parts, SEGMENT_WORDS)
            if size:
                hashes = spelled_hashes(words, size)
                rows.setdefault(size, []).extend((hashes[at], k, at) for at in (i * len(words) // parts for i in range(parts)))
        out = {}
        for size, found in rows.items():
            key, item, at = (np.array(x, t) for x, t in zip(zip(*found, strict=True), (np.uint64, np.int64, np.int64), strict=True))
            order = np.argsort(key, kind="stable")
            out[size] = key[order], item[order], at[order]
        return out

    def unchanged(self, words: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, first word of the window, first word of the segment) where a segment stands unchanged, in parts."""
        for size, (key, item, offset) in self.segments.items():
            if len(words) < size:
                continue
            known = np.append(0, np.cumsum(numbers > 0))
            spot = np.flatnonzero(known[size:] - known[:-size] == size)
            hashes = spelled_hashes(words, size)[spot]
            lo, hi = np.searchsorted(key, hashes, "left"), np.searchsorted(key, hashes, "right")
            some = hi > lo
            spot, lo, times = spot[some], lo[some], (hi - lo)[some]
            ends = np.cumsum(times)
            at = 0
            while at < len(spot):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, "right")))
                n = times[at:stop]
                here = np.repeat(spot[at:stop], n)
                entry = np.arange(len(here)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[at:stop], n)
                yield item[entry], here - offset[entry], here
                at = stop

    def numbered(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, 0)

    def candidates(self, words: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first word of the window, word where the walk began) that agree on all sampled places of some repetition."""
        found, pad = [np.zeros((3, 0), np.int64)], np.zeros(STEPS + 1, np.int64)
        lines = []
        for back in (0, 1):
            way = slice(None, None, -1) if back else slice(None)
            lines.append((np.append(words[way], pad.astype(np.uint64)), np.append(numbers[way], pad)))
        for back, bits, known, anchor, groups in self.tables:
            line, number = lines[int(back)]
            starts = np.flatnonzero(known[number[: len(words)]])
            at, done = starts, 0
            for b, key, last, c, item in groups:
                at = _forward(line, at, bits[done:b])
                done = b
                seen = number[starts] * len(self.vocabulary) + number[at]
                some = np.flatnonzero(number[at] > 0)
                lo, hi = np.searchsorted(key, seen[some], "left"), np.searchsorted(key, seen[some], "right")
                row = np.repeat(some, hi - lo)
                entry = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - hi, hi - lo)
                start, here = starts[row], at[row]
                for s in range(b, int(c[entry].max(initial=-1)) + 1):
                    if not len(entry):
                        break
                    due = c[entry] == s
                    hit = due & (last[entry] == number[here])
                    if hit.any():
                        k, p = item[entry[hit]], start[hit]
                        place = len(words) - 1 - p if back else p
                        found.append(np.stack([k, place - anchor[k], place]))
                    start, here, entry = start[~due], here[~due], entry[~due]
                    here = _forward(line, here, bits[s : s + 1])
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def _spread(k: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    out[k] = values
    return out


def _forward(line: np.ndarray, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    for bit in bits:
        at = at + ((line[at] * bit) >> np.uint64(63)).astype(np.int64)
    return at


def spelled_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each ``size`` words in a row."""
    out = words
    for k in range(1, size):
        out = out[:-1] * _STEP + words[k:]
    return out


def allowed_edits(sizes, similarity: float) -> np.ndarray:
    return np.floor((1 - similarity) * np.asarray(sizes) + 1e-9).astype(np.int64)


def substring_edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between ``item`` and any substring of ``text``, and where that substring ends."""
    row, step = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(new - step) + step
    return int(row.min()), int(row.argmin())


def search(index: Index, words: np.ndarray, counts: np.ndarray, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(row, item, position, edits, similarity) of verified passages, the best of each row and item."""
    numbers, ends = index.numbered(words), np.cumsum(counts)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for item, place, inside in chain([index.candidates(words, numbers)], index.unchanged(words, numbers)):
        found = np.unique(np.stack([item, place, np.searchsorted(ends, inside, "right")]), axis=1)
        _verify(index, words, numbers, ends - counts, ends, *found, similarity, best)
    return [(r, k, p, e, 1 - e / int(index.sizes[k])) for (r, k), (e, p) in best.items()]


def _verify(
    index: Index, words: np.ndarray, numbers: np.ndarray, begins: np.ndarray, ends: np.ndarray,
    item: np.ndarray, place: np.ndarray, row: np.ndarray, similarity: float, best: dict[tuple[int, int], tuple[int, int]],
) -> None:
    """Put into ``best`` (edits, position) of the candidates that are passages and better than what it holds."""
    allowed = allowed_edits(index.sizes[item], similarity)
    begin = np.maximum(place - allowed, begins[row])
    end = np.minimum(place + index.sizes[item] + allowed, ends[row])
    # A passage within the allowed edits has all but so many of the item's words, each as often, around the window.
    size = np.maximum(end - begin, 0)
    owner = np.repeat(np.arange(len(item)), size)
    spot = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + begin[owner]
    wanted = item[owner] * len(index.vocabulary) + numbers[spot]
    at = np.minimum(np.searchsorted(index.members, wanted), len(index.members) - 1)
    ok = (index.members[at] == wanted) & (numbers[spot] > 0)
    pairs, times = np.unique(owner[ok] * len(index.members) + at[ok], return_counts=True)
    shared = np.bincount(pairs // len(index.members), np.minimum(times, index.times[pairs % len(index.members)]), len(item))
    for i in np.flatnonzero(shared >= index.sizes[item] - allowed):
        pair = int(row[i]), int(item[i])
        if best.get(pair, (1, 0))[0] == 0:
            continue
        edits, stop = substring_edits(index.items[pair[1]], words[begin[i] : end[i]])
        if edits <= allowed[i] and (pair not in best or edits < best[pair][0]):
            best[pair] = edits, max(int(begin[i] + stop - index.sizes[item[i]] - begins[row[i]]), 0)


def edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``item`` after random deletions, insertions and replacements."""
    text = list(item)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(text) + 1))
        text[at : at + (kind < 2)] = [] if kind == 0 else [np.uint64(rng.integers(1, 1 << 62))]
    return np.array(text, np.uint64)


def length_class(sizes) -> np.ndarray:
    """Items of one class have up to twice as many words as its shortest; those of 512 and more are one class."""
    return np.minimum(np.log2(np.maximum(np.asarray(sizes), 1)).astype(np.int64), 9)


@lru_cache(maxsize=256)
def repetitions_for(length: int, recall: float, similarity: float, trials: int = 300, most: int = MOST) -> int:
    """Fewest repetitions that find the share ``recall`` of random passages of this class of lengths with the most edits that
    ``similarity`` allows, measured on the walk alone; 0 if ``most`` do not, or if no edit is allowed."""
    rng, needed = np.random.default_rng(SEED + length), []
    if not allowed_edits((2 << length) - 1, similarity):
        return 0
    for _ in range(trials):
        n = int(rng.integers(1 << length, 2 << length)) if length < 9 else int(rng.integers(512, 1024))
        item = rng.integers(1, 1 << 62, n).astype(np.uint64)
        probe = edited(item, int(allowed_edits(n, similarity)), rng)
        index = Index([0], [item], np.zeros(1), similarity)
        index.repetitions[0] = most
        numbers = index.numbered(probe)
        for used in range(most):
            index.tables = [index._table(used)]
            if len(index.candidates(probe, numbers)[0]):
                break
        else:
            used = most
        needed.append(used + 1)
    enough = int(np.quantile(needed, recall, method="higher"))
    return enough if enough <= most else 0


def item_blocks(items: DataFrame, item_col: str, item_text: str) -> Iterator[list]:
    """(id, text) of the items in blocks of about ``BLOCK_BYTES``, chosen by a hash; one block is on the driver at a time."""
    rows = items.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("t IS NOT NULL")
    blocks = 1 + int(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // BLOCK_BYTES
    for b in range(blocks):
        yield [(r["i"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).toLocalIterator()]


def find_passages(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, recall: float = 0.99,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per (document, item) with the best passage (``MATCH``); position is in words of the document."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _found(texts, items, similarity, recall, item_col, item_text, "doc_id")
    if found is None:
        return docs.sparkSession.createDataFrame([], MATCH)
    best = found.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("position", "edits", "similarity"), F.struct("similarity", -F.col("position"))).alias("best")
    )
    return best.select("doc_id", "item_id", "best.*")


def _found(
    texts: DataFrame, items: DataFrame, similarity: float, recall: float, item_col: str, item_text: str, key: str,
) -> DataFrame | None:
    """Passages of all blocks of items in ``texts`` (key, text), one scan a block; None if no item has a word."""
    found = []
    for block in item_blocks(items, item_col, item_text):
        words = [word_hashes([t])[0] for _, t in block]
        kept = [(i, w) for (i, _), w in zip(block, words, strict=True) if len(w)]
        if kept:
            classes = length_class([len(w) for _, w in kept])
            per_class = {c: repetitions_for(int(c), recall, similarity) for c in np.unique(classes).tolist()}
            run = _Searcher([i for i, _ in kept], [w for _, w in kept], [per_class[c] for c in classes.tolist()], similarity, key)
            found.append(texts.mapInArrow(run, MATCH.replace("doc_id long", f"{key} {dict(texts.dtypes)[key]}")))
    return reduce(DataFrame.union, found) if found else None


class _Searcher:
    """Carries the words of a block's items to the tasks; each builds the index for itself."""

    def __init__(self, ids: list, items: list[np.ndarray], repetitions: list[int], similarity: float, key: str):
        self.ids, self.items, self.repetitions, self.similarity, self.key = ids, items, repetitions, similarity, key

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(self.ids, self.items, np.array(self.repetitions), self.similarity)
        for rows, texts in slices(batches):
            hits = search(index, *word_hashes(texts), self.similarity)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(self.key).take(pa.array([h[0] for h in hits], pa.int64())),
                    pa.array([index.ids[h[1]] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int64()),
                    pa.array([h[3] for h in hits], pa.int32()), pa.array([h[4] for h in hits], pa.float64()),
                ],
                [self.key, "item_id", "position", "edits", "similarity"],
            )


def clean(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, recall: float = 0.99,
    text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Rows of ``docs``, whole, without those whose text holds a passage; ids play no part, so null and repeated ones do no harm."""
    of = F.md5(F.col(f"`{text_col}`").cast("string").cast("binary"))
    texts = docs.select(of.alias("of"), F.col(f"`{text_col}`").cast("string").alias("text")).where("of IS NOT NULL")
    found = _found(texts, items, similarity, recall, item_col, item_text, "of")
    if found is None:
        return docs
    leaked = found.select(F.col("of").alias("_leaked")).distinct()
    return docs.join(leaked, of == leaked["_leaked"], "left_anti")

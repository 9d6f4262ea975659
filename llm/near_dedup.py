"""Near-duplicates by weighted Jaccard similarity of word shingles: BagMinHash, bands, exact check, components.

A document is a bag of five-word shingles (fewer words: one shingle of all). Per shingle, a Poisson process of points
runs over time, registers and weight; the weight axis is cut at 0, 1, 2, 4, 8, ..., each cell a process of its own, and a
point counts where its weight level is at most the shingle's multiplicity. The first point of each register is its
value, so two bags agree on a register with the probability of their weighted Jaccard similarity. Points come in
order of time and a process stops as soon as it is later than every register of its document.

``BANDS`` bands of ``ROWS`` registers propose candidates: a pair at 0.8 is missed with probability 3e-6. Texts with the
same words are one class first. In a bucket every class is compared with the bucket's first, and links join components.
Classes in buckets that still hold several components are then compared exactly by their rarest shingles (prefix and
positional filter of set-similarity joins): two bags at 0.8 share a shingle so early in the order of rarity that the
rest of both still reaches the overlap. Shingles of passages that many texts share come last in that order. Pairs found
so, across components only and the largest component of a shingle against the rest, are checked. So linked groups are
never expanded into pairs, nor are texts that only share a passage. Values meet within bands of sizes that allow the
similarity. The exact check is the multiset overlap of the
shingles of whole texts.

Defined cases: null text is empty text; texts without a word are alike only if equal; an empty table gives no row;
repeated rows are repeated in the result; of rows
with one id but other texts, one is compared; rows with a null id get null class and group and count for none; very long
texts are compared whole, one at a time; ties go to the least id; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import join_groups, stored
from llm.tokens import slices
from llm.words import mixed, word_hashes

SHINGLE = 5
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
NEARBY = 16
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of SHINGLE words of one text; of the whole text if it is shorter."""
    size = min(SHINGLE, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = (total ^ words[k : k + len(total)]) * _GOLD
        total ^= total >> np.uint64(29)
    return mixed(total)


def bag(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(words), return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """Point identities per (bag, register); empty bags keep 0."""
    owner = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    element = np.concatenate([np.zeros(0, np.uint64), *[b[0] for b in bags]])
    weight = np.concatenate([np.zeros(0, np.int64), *[b[1] for b in bags]])
    first = np.full(len(bags) * registers, np.inf)
    name = np.zeros(len(bags) * registers, np.uint64)
    # One process per (shingle, cell of the weight axis below its multiplicity).
    cells = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    owner, weight = np.repeat(owner, cells), np.repeat(weight, cells)
    cell = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mixed(np.repeat(element, cells) + cell.astype(np.uint64) * _GOLD)
    low = np.where(cell > 0, 1 << np.maximum(cell - 1, 0), 0)
    width = np.where(cell > 0, low, 1)
    time = np.zeros(len(owner))
    while len(owner):
        seed = mixed(seed + _GOLD)
        point = mixed(seed ^ _GOLD)
        time = time - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (width * registers)
        level = low + 1 + (((point >> np.uint64(40)) * width.astype(np.uint64)) >> np.uint64(24)).astype(np.int64)
        counts = level <= weight
        slot = owner * registers + ((point & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        late = time >= first[slot]
        hit = np.flatnonzero(counts & ~late)
        np.minimum.at(first, slot[hit], time[hit])
        won = hit[time[hit] == first[slot[hit]]]
        name[slot[won]] = point[won]
        latest = first.reshape(-1, registers).max(axis=1)
        alive = time < latest[owner]
        owner, weight, seed, low, width, time = (x[alive] for x in (owner, weight, seed, low, width, time))
    return name.reshape(len(bags), registers)


def band_keys(names: np.ndarray) -> np.ndarray:
    """One 64-bit key per (bag, band)."""
    parts = names.reshape(len(names), BANDS, ROWS)
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed((key ^ parts[:, :, k]) * _GOLD)
    return key.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, same, bands): ``same`` is a 128-bit hash of the words (of the text, without words), then no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            words, counts = word_hashes(texts)
            each = np.split(words, np.cumsum(counts)[:-1])
            keys = band_keys(signatures([bag(w) for w in each]))
            same = [xxhash.xxh3_128_digest(w.tobytes() if len(w) else b"text:" + t.encode("utf-8", "surrogatepass")) for w, t in zip(each, texts, strict=True)]
            bands = [k.tolist() if n else [] for k, n in zip(keys, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(same, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "same", "bands"]
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id IS NOT NULL")
    return chosen.mapInArrow(run, "doc_id long, same binary, bands array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / max(int(a[1].sum()) + int(b[1].sum()) - common, 1)


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose whole texts reach the similarity. ``texts`` has one row (doc, text) per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                left, right = rows.column("text_a"), rows.column("text_b")
                # Rows of one partition share many texts on the left.
                seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                keep = []
                for k, (a, b) in enumerate(zip(rows.column("a").to_pylist(), rows.column("b").to_pylist(), strict=True)):
                    if a not in seen:
                        seen[a] = bag(word_hashes([left[k].as_py()])[0])
                    keep.append(similarity(seen[a], bag(word_hashes([right[k].as_py()])[0])) >= least - 1e-12)
                yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (
        pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return joined.mapInArrow(run, "a long, b long")


def rare_shingles(texts: DataFrame, least: float) -> DataFrame:
    """(value, doc, root, size, place, before): of each text (doc, text, root) its rarest shingles, as many as another text of at
    least ``least`` its size may need to share; ``place`` counts from 1, ``size`` is the number of all, ``before``
    holds up to NEARBY values of the text just before this one. The n-th occurrence of a shingle is a value of its own. Values that only one text has come first and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, part in slices(batches):
            words, counts = word_hashes(part)
            values = []
            for own in np.split(words, np.cumsum(counts)[:-1]):
                found, times = bag(own)
                nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                values.append(mixed(np.repeat(found, times) + nth.astype(np.uint64) * _GOLD).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc"), rows.column("root"), pa.array([len(v) for v in values], pa.int32()), pa.array(values, pa.list_(pa.int64()))],
                ["doc", "root", "size", "values"],
            )

    listed = texts.select("doc", "root", "text").mapInArrow(run, "doc long, root long, size int, values array<long>")
    values = stored(listed.select("doc", "root", "size", F.explode("values").alias("value")), "op5-values")
    shared = values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    common = values.join(shared, "value").groupBy("doc", "root", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "value"))).alias("common")
    )
    alone = F.col("size") - F.size("common")
    last = F.col("size") - F.ceil(least * F.col("size") - 1e-9) + 1
    kept = F.transform(F.slice("common", F.lit(1), F.greatest(last - alone, F.lit(0)).cast("int")), lambda c: c["value"])
    early = common.select("doc", "root", "size", alone.alias("alone"), kept.alias("kept"))
    # Each value with its place and the few before it, before rows are made: no row carries the whole list.
    near = F.transform("kept", lambda v, at: F.struct(
        v.alias("value"), (F.col("alone") + at + 1).alias("place"),
        F.slice("kept", F.greatest(at - NEARBY, F.lit(0)) + 1, F.least(at, F.lit(NEARBY))).alias("before"),
    ))
    return early.select("doc", "root", "size", F.inline(near)).select("value", "doc", "root", "size", "place", "before")


def size_band(size: Column, least: float) -> Column:
    """Texts whose sizes allow the similarity lie in the same band or in neighbouring ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.log(F.lit(1 / least)) + 1e-9).cast("int")


def cross_pairs(early: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of different roots that share a value early enough to reach ``least``."""
    parts = early.groupBy("value", "root").agg(F.count("*").alias("n")).groupBy("value").agg(
        F.count("*").alias("parts"), F.max_by("root", F.struct("n", "root")).alias("major")
    ).where("parts > 1")
    mixed_ = stored(early.join(parts.select("value", "major"), "value").withColumn("band", size_band(F.col("size"), least)), "op5-mixed")
    bands = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")
    rest = mixed_.where("root <> major").select("value", bands, *[F.col(c).alias(f"x_{c}") for c in ("doc", "root", "size", "place", "before")])
    # Against the largest component, and among the rest once. What lies behind both places must still hold the overlap.
    overlap = F.ceil(least / (1 + least) * (F.col("size") + F.col("x_size")) - 1e-9)
    behind = F.least(F.col("size") - F.col("place"), F.col("x_size") - F.col("x_place")) + 1
    pairs = rest.join(mixed_, ["value", "band"]).where(
        F.expr("x_root <> root AND (root = major OR x_doc < doc)") & (behind >= overlap)
        # Not where both just had another value in common: the first common value always stays.
        & ~F.arrays_overlap("before", "x_before")
    )
    return pairs.select(F.least("x_doc", "doc").alias("a"), F.greatest("x_doc", "doc").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(doc, root) of all ends of ``edges`` (a, b). Each round every node joins its least neighbour by a hash that
    changes with the round, and edges are contracted; so chains of any shape shrink by a constant factor a round."""
    left = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = left.select(F.explode(F.array("a", "b")).alias("doc")).distinct().withColumn("root", F.col("doc"))
    step = 0
    while not left.isEmpty():
        step += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(step), c).alias("h"), F.col(c).alias("to"))  # noqa: E731, B023
        both = left.select(F.col("a").alias("node"), rank("b").alias("best"), rank("a").alias("own")).union(
            left.select(F.col("b").alias("node"), rank("a").alias("best"), rank("b").alias("own"))
        )
        moved = stored(
            both.groupBy("node").agg(F.least(F.min("best"), F.min("own")).alias("best")).select("node", F.col("best.to").alias("to")), "moves"
        )
        roots = stored(
            roots.join(moved, roots["root"] == moved["node"], "left").select("doc", F.coalesce("to", "root").alias("root")), "roots"
        )
        for end in ("a", "b"):
            other = "b" if end == "a" else "a"
            left = left.join(moved.select(F.col("node").alias(end), "to"), end).select(F.col("to").alias(end), other)
        left = stored(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    least = roots.groupBy("root").agg(F.min("doc").alias("least"))
    return roots.join(least, "root").select("doc", F.col("least").alias("root"))


def near_duplicates(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, group_id, linked_to) per row: least id with the same words, least id linked by chains of
    near-duplicates, and the least class that this one's text was compared with and found alike (null: none)."""
    prints = stored(fingerprints(docs, id_col, text_col), "op5-prints")
    classes = stored(prints.groupBy("same").agg(F.min("doc_id").alias("class_id"), F.min("bands").alias("bands"), F.count("*").alias("n")), "op5-classes")
    bands = classes.select(F.col("class_id").alias("doc"), F.explode("bands").alias("bucket"))
    leads = bands.groupBy("bucket").agg(F.min("doc").alias("lead"), F.count("*").alias("size")).where("size > 1").select("bucket", "lead")
    members = stored(bands.join(leads, "bucket").select("bucket", "doc", "lead"), "op5-members")
    whole = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = stored(whole.join(members.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"]), "op5-texts")

    stars = members.where("doc <> lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()
    links = stored(verified(stars, texts, least), "op5-links")
    roots = components(links)
    labelled = members.join(roots, "doc", "left").select("bucket", "doc", F.coalesce("root", "doc").alias("root"))
    mixed_ = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    unsure = stored(labelled.join(mixed_, "bucket").groupBy("doc").agg(F.min("root").alias("root")), "op5-unsure")
    early = stored(rare_shingles(texts.join(unsure, "doc"), least), "op5-early")
    found = verified(stored(cross_pairs(early, least), "op5-pairs"), texts, least)
    links = stored(links.union(found), "op5-all-links")
    roots = components(links)
    ends = links.select(F.col("a").alias("doc"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = ends.where("doc <> other").groupBy("doc").agg(F.min("other").alias("linked_to"))
    facts = roots.join(linked, "doc", "left").select(F.col("doc").alias("class_id"), "root", "linked_to")
    known = join_groups(prints.select("doc_id", "same"), classes.select("same", "class_id", "n"), "same", "n")
    sizes = classes.groupBy("class_id").agg(F.sum("n").alias("n"))
    known = join_groups(known, sizes.join(facts, "class_id"), "class_id", "n")
    known = known.select("doc_id", "class_id", F.coalesce("root", "class_id").alias("group_id"), "linked_to")
    none = F.lit(None).cast("long")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NULL")
    return known.unionByName(own.select("doc_id", none.alias("class_id"), none.alias("group_id"), none.alias("linked_to")))


def keep_one(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, whole: of each group those with its least id, and of several rows with one id and text one (the first by
    its other columns). Rows without id take part in no group; equal ones shrink to one."""
    groups = near_duplicates(docs, least, id_col, text_col)
    out = stored(groups.where("doc_id <> group_id").select(F.col("doc_id").alias("_copy")).distinct(), "op5-out")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = [F.col(f"`{id_col}`").cast("long").alias("_id"), F.md5(text.cast("binary")).alias("_text")]
    twice = docs.groupBy(*named).agg(F.count("*").alias("n")).where("n > 1").select(F.col("_id").alias("_i"), F.col("_text").alias("_t"))
    twice = stored(twice, "op5-twice")
    kept = docs.select(F.struct("*").alias("_row"), *named).join(out, F.col("_id") == F.col("_copy"), "left_anti")
    again = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_text") == F.col("_t"))
    one = kept.join(twice, again, "left_semi").groupBy("_id", "_text").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return kept.join(twice, again, "left_anti").select("_row.*").unionByName(one.select("_row.*"))

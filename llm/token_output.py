"""Packed token-id output: best-fit-decreasing packing of whole documents into rows of ``window`` ids.

Documents longer than a row are split into full rows and a rest, without loss. Best fit decreasing looks at lengths
only, so a plan is made exactly from the histogram of lengths (at most ``window`` numbers): from
the longest length down, as many pieces as there are rows with the least room that fits take their place together; a
segment tree over the room left finds that room. The plan is a list of runs (length, first rank, first row, offset), and
a piece finds its place by its rank among the pieces of its length.

``token_output`` plans group by group within the tasks that encode the texts, and writes the matrices there: no shuffle, no
table that grows but one row a task. ``pack_best_fit`` plans the whole input at once and returns pieces: ranks come from two
passes, running counts within tasks and sums per (task, length); only the histogram and the plan pass through the
driver, whose size follows ``window``, not the data.

Defined cases: null or empty text is the end token alone; very long texts are split as they are encoded; an empty table
gives no rows; repeated rows are packed as often as they occur; pieces of equal length go in the order of their rows; only
the id and text columns are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored
from llm.tokens import crc_of, default_tokenizer, encoder, slices

#: Padded ids as unsigned 32-bit bytes, cumulative segment lengths, positions that start again at each segment; of each
#: segment its document, the first token of the document that it holds, the crc of its ids, the tokens of the document.
MATRIX = (
    "sequence_id long, ids binary, segment_ends array<long>, positions array<int>,"
    " doc_ids array<long>, starts array<long>, ids_crc32 array<long>, doc_tokens array<long>"
)
ROWS_AT_ONCE = 256
PIECE = "part int, doc_id long, start long, length int, ids_crc32 long, doc_tokens long, rank long"


class RoomTree:
    """Segment tree over room sizes 0..n: which sizes exist, and the least existing size of at least x."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, size: int, exists: bool) -> None:
        at = size + self.leaves
        self.any[at] = exists
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def least(self, size: int) -> int | None:
        at = size + self.leaves
        if self.any[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], window: int) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, count, first row, offset), sorted by length and rank, and the number of rows."""
    tree, room = RoomTree(window), {}  # room: size -> [(first row, count)]
    runs, rows = [], 0

    def take(length: int, rank: int, n: int, first: int, size: int, each: int) -> None:
        """``n`` rows with ``size`` left take ``each`` pieces."""
        for k in range(each):
            runs.append((length, rank + k * n, n, first, window - size + k * length))
        rest = size - each * length
        room.setdefault(rest, []).append((first, n))
        tree.set(rest, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            size = tree.least(length)
            # A row that took a piece has the least room that fits, so it takes all that fit before the next row does.
            per = (size or window) // length
            full, some = divmod(left, per)
            if size is None:
                first, n = rows, full + (some > 0)
                rows += n
            else:
                first, n = room[size].pop()
            full = min(n, full)
            if full:
                take(length, rank, full, first, size or window, per)
                rank, left = rank + full * per, left - full * per
            if full < n and left:
                take(length, rank, 1, first + full, size or window, left)
                full, left = full + 1, 0
            if size is not None:
                if full < n:
                    room[size].append((first + full, n - full))
                tree.set(size, bool(room[size]))
    plan = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return plan, rows


def _pieces(docs: DataFrame, path: str, eos: int, window: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """``PIECE`` rows; ``rank`` counts the earlier pieces of the same length in the same task."""
    names = [x.split()[0] for x in PIECE.split(", ")] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        end, used = np.array([eos], "<u4").tobytes(), np.zeros(window + 1, np.int64)
        for rows, texts in slices(batches):
            out: list[list] = [[] for _ in names]
            for doc, ids in zip(rows.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    row = [part, doc, start, length, crc_of(ids, start, length), total, int(used[length])]
                    used[length] += 1
                    for column, value in zip(out, row + [ids[4 * start : 4 * (start + length)]] * with_ids, strict=True):
                        column.append(value)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=False)], names)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECE + ", ids binary" * with_ids)


def pack_best_fit(
    docs: DataFrame, window: int = 2048, eos: int = 1, tokenizer: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece; ``with_ids`` adds ids."""
    return _placed(docs, window, eos, tokenizer, id_col, text_col, with_ids)[0]


def _placed(
    docs: DataFrame, window: int, eos: int, tokenizer: str | None, id_col: str, text_col: str, with_ids: bool,
) -> tuple[DataFrame, int]:
    """The pieces with their places, and the number of sequences."""
    pieces = stored(_pieces(docs, tokenizer or default_tokenizer(), eos, window, id_col, text_col, with_ids), "op10-pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, sequences = best_fit_decreasing(histogram, window)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("part", "base")
    begin = np.searchsorted(plan[:, 0], np.arange(window + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # all texts are encoded, so the worker need not remember words while rows are built
        for rows in batches:
            length, rank = rows.column("length").to_numpy(), rows.column("rank").to_numpy()
            run = np.zeros(len(length), np.int64)
            for size in np.unique(length):
                mine = length == size
                run[mine] = begin[size] + np.searchsorted(plan[begin[size] : begin[size + 1], 1], rank[mine], "right") - 1
            sequence = pa.array(plan[run, 3] + rank - plan[run, 1])
            fixed = rows.select([n for n in rows.schema.names if n != "rank"])
            fixed = fixed.set_column(fixed.schema.get_field_index("length"), "length", pa.array(length.astype(np.int64)))
            yield fixed.append_column("sequence_id", sequence).append_column("offset", pa.array(plan[run, 4]))

    names = ["length", "doc_id", "start", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in [*names, "sequence_id", "offset"])
    return ranked.select(*names[:5], "rank", *names[5:]).mapInArrow(place, schema), sequences


def matrices(pieces: DataFrame, window: int = 2048, pad: int = 0) -> DataFrame:
    """``MATRIX`` rows from pieces with ids. A row has at most ``window`` pieces."""
    return pieces.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(_builder(window, pad), MATRIX)


def _build(window: int, pad: int):
    """Turns pieces in order of sequence and offset into ``MATRIX`` rows."""

    def build(rows: pa.Table) -> pa.RecordBatch:
        sequence, length, offset = (rows.column(c).to_numpy() for c in ("sequence_id", "length", "offset"))
        first = np.flatnonzero(np.diff(sequence, prepend=sequence[0] - 1))
        bounds = np.append(first, len(sequence)).astype(np.int32)
        nth = np.repeat(np.arange(len(first)), np.diff(bounds))
        tokens = np.append(0, np.cumsum(length))
        positions = np.arange(tokens[-1]) - np.repeat(tokens[:-1], length)
        ids = np.full((len(first), window), pad, "<u4")
        ids.ravel()[positions + np.repeat(nth * window + offset, length)] = np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u4")
        size = pa.py_buffer((np.arange(len(first) + 1) * 4 * window).astype(np.int32))
        columns = [pa.array(sequence[first]), pa.Array.from_buffers(pa.binary(), len(first), [None, size, pa.py_buffer(ids)])]
        columns += [
            pa.ListArray.from_arrays(pa.array(bounds), pa.array((offset + length).astype(np.int64))),
            pa.ListArray.from_arrays(pa.array(tokens[bounds].astype(np.int32)), pa.array(positions.astype(np.int32))),
        ]
        for name in ("doc_id", "start", "ids_crc32", "doc_tokens"):
            columns.append(pa.ListArray.from_arrays(pa.array(bounds), rows.column(name).combine_chunks()))
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in MATRIX.split(", ")])

    return build


def _builder(window: int, pad: int):
    """Sequences from pieces in order of sequence and offset; the last sequence of a batch waits for the next one."""
    build = _build(window, pad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            sequence = batch.column("sequence_id").to_numpy()
            cut = int(np.searchsorted(sequence, sequence[-1]))
            if waiting and (cut or waiting[0].column("sequence_id")[0].as_py() != sequence[-1]):
                yield build(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
            elif cut:
                yield build(pa.Table.from_batches([batch.slice(0, cut)]))
            waiting.append(batch.slice(cut))
        if waiting:
            yield build(pa.Table.from_batches(waiting))

    return run


def write_matrices(
    pieces: DataFrame, path: str, rows_per_file: int = 65_536, window: int = 2048, pad: int = 0, sequences: int | None = None,
) -> None:
    """Write ``MATRIX`` rows as parquet, in order of sequence_id within files of ``rows_per_file`` rows; sequences are
    numbered without gaps, so the number gives the file."""
    if sequences is None:
        last = pieces.agg(F.max("sequence_id")).first()[0]
        sequences = 0 if last is None else last + 1
    files = max(1, -(-sequences // rows_per_file))
    dealt = pieces.repartitionById(files, F.floor(F.col("sequence_id") / rows_per_file).cast("int"))
    rows = dealt.sortWithinPartitions("sequence_id", "offset").mapInArrow(_builder(window, pad), MATRIX)
    # Rows are long: small row groups keep the buffers of writers and readers small.
    rows.write.option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(path)


def _packed(docs: DataFrame, path: str, eos: int, window: int, pad: int, group_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """``MATRIX`` rows numbered within the task (``part``, ``row``): a task packs its documents in groups of about
    ``group_tokens`` tokens, each by a plan of its own."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    out = [x.split()[0] for x in MATRIX.split(", ")][1:]
    build = _build(window, pad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        end, made, held, tokens = np.array([eos], "<u4").tobytes(), 0, [[] for _ in names], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal made
            length = np.array(held[2], np.int64)
            sequence, offset, rows = assigned(length, window)
            order = np.lexsort((offset, sequence))
            table = pa.table([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=names).take(pa.array(order))
            table = table.append_column("sequence_id", pa.array(sequence[order])).append_column("offset", pa.array(offset[order]))
            cuts = np.searchsorted(sequence[order], np.arange(0, rows + ROWS_AT_ONCE, ROWS_AT_ONCE))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                found = build(table.slice(lo, hi - lo))
                row = pa.array(found.column("sequence_id").to_numpy() + made)
                parts = pa.array(np.full(found.num_rows, part, np.int32))
                yield pa.RecordBatch.from_arrays([parts, row, *(found.column(c) for c in out)], ["part", "row", *out])
            made += rows
            for column in held:
                column.clear()

        for batch, texts in slices(batches):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    values = [doc, start, length, crc_of(ids, start, length), total, ids[4 * start : 4 * (start + length)]]
                    for column, value in zip(held, values, strict=True):
                        column.append(value)
                    tokens += length
                    if tokens >= group_tokens:
                        yield from close()
                        tokens = 0
        if held[0]:
            yield from close()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "part int, row long, " + MATRIX.split(", ", 1)[1])


def assigned(length: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences, by best fit decreasing."""
    sizes, times = np.unique(length, return_counts=True)
    plan, rows = best_fit_decreasing(dict(zip(sizes.tolist(), times.tolist(), strict=True)), window)
    order = np.argsort(length, kind="stable")
    # The plan's runs cover the ranks of each length in order, as the sorted pieces do.
    nth = np.arange(len(length)) - np.repeat(np.cumsum(plan[:, 2]) - plan[:, 2], plan[:, 2])
    sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    sequence[order] = np.repeat(plan[:, 3], plan[:, 2]) + nth
    offset[order] = np.repeat(plan[:, 4], plan[:, 2])
    return sequence, offset, rows


def token_output(
    docs: DataFrame, window: int = 2048, eos: int = 1, pad: int = 0, tokenizer: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", group_tokens: int = 4_000_000,
) -> DataFrame:
    """``MATRIX`` rows of all documents, stored in a new folder of the shared scratch space and read back.

    Texts are encoded, packed and written in one pass without a shuffle: what a task packs together is a group of
    ``group_tokens`` tokens, whose last rows are all that a plan of the whole input could fill better. The files number
    their rows by task; ids without gaps follow from the rows of each task, one line a task.
    """
    rows = stored(_packed(docs, tokenizer or default_tokenizer(), eos, window, pad, group_tokens, id_col, text_col), "op10-matrices", 8 << 20)
    totals = rows.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    columns = [x.split()[0] for x in MATRIX.split(", ")][1:]
    return rows.join(F.broadcast(base), "part").select((F.col("row") + F.col("base")).alias("sequence_id"), *columns)

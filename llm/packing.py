"""Concatenate and cut: documents follow each other without gaps and fixed windows are cut from the whole.

Two passes. The first turns texts into ids and keeps running token counts inside each partition; partition totals, one
row per task, give every partition its global offset. The second cuts each document where windows end; a piece that
a window boundary cuts carries ``cut_before`` / ``cut_after``.

Defined cases: null or empty text is the end token alone; an empty table gives no piece; repeated rows are packed as
often as they occur; null ids stay null; very long texts are cut like others, one row in memory at a time; the order is that of
the partitions' rows, so there are no ties; only the id and text columns are read, whatever others are called. Only the last
sequence is short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import stored
from llm.tokens import crc_of, default_tokenizer, token_table

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " cut_before boolean, cut_after boolean"
)


def global_offsets(tokens: DataFrame) -> DataFrame:
    """First global position of each part. One row per task of the first pass, 16 bytes each."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))


def pack(
    docs: DataFrame, window: int = 2048, eos: int = 1, tokenizer: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece (``PIECE``); ``with_ids`` adds its ids as unsigned 32-bit bytes in ``ids``."""
    tokens = stored(token_table(docs, tokenizer or default_tokenizer(), eos, id_col, text_col), "op1-tokens")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            first = rows.column("first").to_numpy()
            total = rows.column("doc_tokens").to_numpy()
            # Windows that each document touches, one piece each.
            pieces = (first + total - 1) // window - first // window + 1
            row = np.repeat(np.arange(len(first)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[row] // window + nth
            begin = np.maximum(sequence * window, first[row])
            end = np.minimum((sequence + 1) * window, first[row] + total[row])
            start, length = begin - first[row], end - begin
            ids = rows.column("ids").to_pylist()
            crc = [crc_of(ids[r], s, k) for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = [
                rows.column("doc_id").take(pa.array(row)), start, length, pa.array(crc, pa.int64()), total[row], sequence,
                begin - sequence * window, start > 0, start + length < total[row],
            ]
            names = [x.split()[0] for x in PIECE.split(", ")]
            if with_ids:
                columns.append(pa.array([ids[r][4 * s : 4 * (s + k)] for r, s, k in zip(row, start, length, strict=True)], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    placed = tokens.join(F.broadcast(global_offsets(tokens)), "part").select(
        "doc_id", "doc_tokens", "ids", (F.col("before") + F.col("base")).alias("first")
    )
    return placed.mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def windows(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, segment_starts) from ``pack(with_ids=True)``: a window has at most ``window`` pieces."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(ordered.alias("parts"))
    return grouped.select(
        "sequence_id",
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("parts", lambda x: x["offset"]).alias("segment_starts"),
    )

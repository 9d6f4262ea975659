"""Token ids of whole texts with a public tokenizer file, encoded once per distinct word of a worker.

Tokens of the supported files never span ASCII white space, so a text's ids are those of its words one after another.
A worker remembers the ids of up to ``MEMO_WORDS`` words of at most ``MEMO_CHARS`` characters; that saves time only.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO_WORDS = 800_000
MEMO_CHARS = 48
SLICE_CHARS = 2_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# The split pattern of the default tokenizer, and the words on which its steps are these simple ones:
# lower-case, split by the pattern, spell UTF-8 bytes as the byte-level characters, apply the merges.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_level() -> dict[int, int]:
    """Printable Latin-1 bytes stand for themselves, the others for characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 0x100 + k for k, b in enumerate(hidden)}


class WordMemo(dict):
    """Values of words; misses are computed. The older half is forgotten when the younger is full."""

    def __init__(self, compute: Callable[[str], Any], empty: Any):
        super().__init__({"": empty})
        self.compute, self.empty, self.old = compute, empty, {}

    def __missing__(self, word: str) -> Any:
        found = self.old.get(word)
        if found is None:
            found = self.compute(word)
        if len(word) <= MEMO_CHARS:
            self[word] = found
        return found

    def trim(self) -> None:
        if len(self) > MEMO_WORDS // 2:
            self.old = dict(self)
            self.clear()
            self[""] = self.empty


def words_of(text: str) -> list[str]:
    """Words between the six ASCII white-space characters; some are empty."""
    for space in "\n\t\r\x0b\x0c":
        if space in text:
            text = text.replace(space, " ")
    return text.split(" ")


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.spelling = self.tokenizer.model, _byte_level()
        said = json.loads(self.tokenizer.to_str())
        steps = [(said["normalizer"] or {}).get("normalizers") or [], (said["pre_tokenizer"] or {}).get("pretokenizers") or []]
        self.simple = [[x["type"] for x in kind] for kind in steps] == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and (
            steps[1][0]["pattern"] == {"Regex": _PATTERN} and not steps[1][1]["add_prefix_space"]
        )
        self.memo = WordMemo(self.word, b"")

    def word(self, word: str) -> bytes:
        if self.simple and _PLAIN.fullmatch(word) and "<|" not in word:
            pieces = _SPLIT.findall(word.lower())
            if not word.isascii():
                pieces = [p.encode().decode("latin-1").translate(self.spelling) for p in pieces]
            return array("I", [t.id for p in pieces for t in self.model.tokenize(p)]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out, ids_of = [], self.memo.__getitem__
        for text in texts:
            out.append(b"".join(map(ids_of, words_of(text))))
            self.memo.trim()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut batches into pieces of at most ``SLICE_CHARS`` bytes of text, but one row at least; null text is empty."""
    for batch in batches:
        sizes = np.cumsum(batch.column(column).cast(pa.binary()).to_pandas().str.len().fillna(0).to_numpy(dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + SLICE_CHARS, "right")))
            part = batch.slice(at, end - at)
            yield part, [t or "" for t in part.column(column).to_pylist()]
            at = end


def token_table(docs: DataFrame, path: str, eos: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, before, doc_id, doc_tokens, ids): ``ids`` are the document's ids and ``eos`` as unsigned 32-bit bytes,
    ``before`` the tokens of earlier rows of the same part. Store it before use: parts are tasks of this pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([eos], "<u4").tobytes()
        for rows, texts in slices(batches):
            ids = [x + end for x in enc.encode(texts)]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            start = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(start), rows.column("doc_id"), pa.array(n), pa.array(ids, pa.binary())],
                ["part", "before", "doc_id", "doc_tokens", "ids"],
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "part int, before long, doc_id long, doc_tokens long, ids binary")


def crc_of(ids: bytes, start: int, length: int) -> int:
    return zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])

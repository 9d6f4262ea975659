"""Word-piece counts of whole texts by greedy longest match, in time linear in the text, without building pieces.

The vocabulary is a trie. Each node has a failure link, the node of the text that is left once the longest matches at
the front of its string are taken off, and the number of tokens taken off on the way; both are computed once, so the
automaton never looks back. A character that no piece begins with counts as its UTF-8 bytes (byte fallback).

Defined cases: null or empty text has no words and no tokens; an empty table gives no row; repeated rows are counted as
often as they occur; very long texts are read in slices of about 2 MB or one text; there is nothing to tie; only the id and
text columns are read, whatever others are called.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tokens import WordMemo, slices, words_of

MARK = "▁"  # stands before every word


class Automaton:
    def __init__(self, pieces: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    whole.append(False)
                node = self.children[node][c]
            whole[node] = node > 0
        self.failure, self.popped = [0] * len(whole), [0] * len(whole)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, node in self.children[parent].items():
                if whole[node]:
                    self.popped[node] = 1
                elif parent:
                    to, tokens = self._next(self.failure[parent], c)
                    self.failure[node], self.popped[node] = to, self.popped[parent] + tokens
                else:
                    self.popped[node] = len(c.encode("utf-8", "surrogatepass"))
                queue.append(node)

    def _next(self, node: int, c: str) -> tuple[int, int]:
        """State after ``c``, and the tokens taken off before it."""
        tokens = 0
        while c not in self.children[node]:
            if not node:
                return 0, tokens + len(c.encode("utf-8", "surrogatepass"))
            tokens += self.popped[node]
            node = self.failure[node]
        return self.children[node][c], tokens

    def count(self, text: str) -> int:
        node = total = 0
        for c in text:
            node, tokens = self._next(node, c)
            total += tokens
        while node:
            total += self.popped[node]
            node = self.failure[node]
        return total


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[str]:
    """Text pieces of a sentence-piece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


@lru_cache(maxsize=2)
def counter(path: str) -> WordMemo:
    automaton = Automaton(vocabulary(path))
    return WordMemo(lambda word: automaton.count(MARK + word), 0)


def count_tokens(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_bytes) of every row."""
    path = model or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = counter(path)
        for rows, texts in slices(batches):
            words, tokens = [], []
            for text in texts:
                found = words_of(text)
                words.append(len(found) - found.count(""))
                tokens.append(sum(map(memo.__getitem__, found)))
                memo.trim()
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, size))], ["doc_id", "n_words", "n_tokens", "n_bytes"]
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_bytes long")

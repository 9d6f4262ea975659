"""Words of texts as 64-bit hashes, computed on whole batches of bytes.

A word is a run of bytes that are neither ASCII punctuation nor ASCII white space or control characters, after the text
is lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _pieces(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Runs of about ``PIECE`` bytes that end between words, with their places; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data):
            gaps = np.flatnonzero(_GAP[np.frombuffer(data, np.uint8, min(PIECE, len(data) - end), end)])
            if len(gaps):
                end += int(gaps[0])
                break
            end += PIECE
        end = min(end, len(data))
        yield at, np.frombuffer(data, np.uint8, end - at, at)
        at = end


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of each text. Needs some 50 bytes per byte of a piece, not of the texts."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    limits = np.cumsum([len(r) + 1 for r in raw])
    hashes, begins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, data in _pieces(b" ".join(raw) + b" "):
        up, down = _powers(1 << max(20, int(len(data)).bit_length()))
        inside = ~_GAP[data]
        edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if len(data) and inside[-1]:
            ends = np.append(ends, len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)] * inside, out=sums[1:])
        hashes.append(mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        begins.append(starts + at)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(begins), limits), prepend=0)

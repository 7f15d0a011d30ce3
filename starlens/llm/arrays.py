"""Whole batches of texts as arrays: words, hashes of spans, shared by the operators.

Texts come as Arrow columns, are looked at in slices of bounded size, and are hashed
without a Python loop over words. The hash of a span is a polynomial in its symbols
modulo 2**64, taken from prefix sums and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 2**64)
SLICE_BYTES = 1_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(factor: int) -> np.ndarray:
        steps = np.full(size + 1, factor, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(BASE), run(INVERSE)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the usual slice size."""
    usual = 1 << 20
    if size <= usual:
        return _powers(usual)
    return _powers.__wrapped__(size)


class Spans:
    """Hashes of any spans of one array of symbols (bytes or code points)."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = powers(len(symbols))
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        length = (ends - starts).astype(np.uint64) + np.uint64(salt << 40)
        return mix(value ^ mix(length + np.uint64(0x9E3779B97F4A7C15)))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets between them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row and the offsets between them."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), offsets


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def is_letter(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    found = _letters()[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        kinds, which = np.unique(codes[high], return_inverse=True)
        found[high] = np.array([chr(c).isalpha() for c in kinds])[which]
    return found


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked symbols that don't cross texts: starts, ends, text numbers."""
    size = len(inside)
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    edge = np.zeros(size + 1, dtype=bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def letter_words(texts: list[str | None]) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters of all texts in lower case: hashes of spans, starts, ends, text numbers."""
    codes, offsets = code_points([(t or "").lower() for t in texts])
    return Spans(codes), *runs(is_letter(codes), offsets)


def grams(starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each n-gram of each word, and the word's number."""
    counts = np.maximum(ends - starts - n + 1, 0)
    owner = np.repeat(np.arange(len(starts)), counts)
    first = np.cumsum(counts) - counts
    return starts[owner] + np.arange(len(owner)) - first[owner], owner


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (A-Z lowered, split at white space of ASCII), and
    how many words lie before each text."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, owner = runs(~SPACE[data], offsets)
    before = np.searchsorted(owner, np.arange(len(offsets)), side="left")
    return Spans(data).hash(starts, ends), before


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part holds about ``limit`` bytes of text at most.

    A text longer than that is a part of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end

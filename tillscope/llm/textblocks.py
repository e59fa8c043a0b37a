"""Whole texts as numpy bytes: blocks of an Arrow batch, words, shingles and their hashes.

A block is some rows of a batch with their texts in one byte array. It is bounded in
bytes, but for a single text that is longer; such a text is a block of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SHINGLE_WORDS = 5

# Fixed seeds: every run and every executor must hash alike.
_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_WORD_FACTORS = _RANDOM.integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_GAP = re.compile(rb"[\x20\x09-\x0D]")
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Block(NamedTuple):
    rows: pa.RecordBatch
    data: np.ndarray  # uint8
    starts: np.ndarray  # int64, one more than rows


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, values = texts.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if values is None or starts[-1] == starts[0]:
        return np.zeros(0, dtype=np.uint8), starts - starts[0]
    data = np.frombuffer(values, dtype=np.uint8)[starts[0] : starts[-1]]
    return data, starts - starts[0]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, block_bytes: int = BLOCK_BYTES
) -> Iterator[Block]:
    """Cut batches into blocks; every row is in exactly one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, starts = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + block_bytes, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield Block(
                batch.slice(first, last - first),
                data[starts[first] : starts[last]],
                starts[first : last + 1] - starts[first],
            )
            first = last
        del batch, data
    # Idle workers would hold what their last task needed.
    pa.default_memory_pool().release_unused()


class _Powers:
    """Powers of the base and of its inverse, as many as a block of the usual size needs."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
            up[0] = down[0] = 1
            made = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
            if n > BLOCK_BYTES + 1:  # a larger block or a long text; workers keep no such table
                return made
            cls.up, cls.down = made
        return cls.up, cls.down


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64 bits evenly (the finaliser of the public-domain splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def substring_hashes(
    values: np.ndarray, begins: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """64-bit hashes of values[begin:end], from prefix sums of one polynomial."""
    up, down = _Powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:], dtype=np.uint64)
    return mix((sums[ends] - sums[begins]) * down[begins])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def words(
    data: np.ndarray, starts: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word ``[^\\x20\\x09-\\x0D]+``, and how many each text has.

    Other ``separators``, one truth value for each byte, make other words.
    """
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    begins = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(begins, starts))
    return begins, ends, counts


def word_lists(text: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, as lists of bounded size, so that a very long text needs no more."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + size)
        end = cut.start() if cut else len(text)
        if found := text[at:end].split():
            yield found
        at = end


def spread_starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def shingles(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, as 64-bit hashes; and how many each has.

    A shingle is five consecutive words with A-Z lower-cased. A text of fewer words has
    one, its whole sequence; a text without words has none.
    """
    begins, ends, counts = words(data, starts)
    hashes = substring_hashes(byte_values(LOWER[data]), begins, ends)
    n = len(hashes)
    if not n:
        return hashes, np.zeros(len(counts), dtype=np.int64)
    # The words from each position on, as far as the text goes.
    stop = np.repeat(spread_starts(counts)[1:], counts)
    position = np.arange(n)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        at = position + k
        there = at < stop
        term = hashes[np.minimum(at, n - 1)] * _WORD_FACTORS[k]
        total += np.where(there, term, np.uint64(0))
    first = np.repeat(spread_starts(counts)[:-1], counts)
    full = (position + SHINGLE_WORDS <= stop) | (position == first)
    total = mix(total)[full]
    owner = np.repeat(np.arange(len(counts)), counts)[full]
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    new = np.ones(len(total), dtype=bool)
    new[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    return total[new], np.bincount(owner[new], minlength=len(counts))

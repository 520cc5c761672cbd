"""Words and word windows of Arrow text columns as NumPy arrays of 64-bit hashes.

Used inside Arrow tasks by the operators that look at every word. A batch is taken in
pieces of a megabyte, so memory depends on the longest text, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# About 20 bytes of arrays stand beside each byte of a piece.
PIECE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_random = np.random.default_rng(20240607)
_BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values; different seeds give unrelated orders."""
    h = h + np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        have = _powers[base] = (tables[0], tables[1])
    return have


class Words(NamedTuple):
    """Words of consecutive texts; those of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def windows(self, length: int) -> np.ndarray:
        """Whether ``length`` words of one text start at each word."""
        ok = np.zeros(len(self.hashes), bool)
        left = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self.hashes))
        np.greater_equal(left, length, out=ok)
        return ok


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of at most ``most`` bytes (a longer text is alone), with the first row."""
    offsets = _offsets(texts)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, texts.slice(start, end - start)
        start = end


def _offsets(texts: pa.Array) -> np.ndarray:
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    raw = np.frombuffer(texts.buffers()[1], kind)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def words(texts: pa.Array, fold: bool = False) -> Words:
    """Hashes of all words; null texts have none. ``fold`` lower-cases A-Z first."""
    if len(texts) == 0:
        empty = np.zeros(0, np.int64)
        return Words(empty.astype(np.uint64), np.zeros(1, np.int64), empty.astype(np.uint8), empty, empty)
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = _offsets(texts)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inner = np.unique(offsets[1:-1])
    inner = inner[(inner > 0) & (inner < len(data))]
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[inner] = solid[inner]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    if len(inner):
        stops[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _power_table(_BASE, len(data) + 1)
    totals = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[_FOLD[data] if fold else data] * up[: len(data)], out=totals[1:])
    hashes = mixed((totals[ends] - totals[starts]) * down[starts])
    return Words(hashes, np.searchsorted(starts, offsets), data, starts, ends)


def window_hashes(hashes: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """Hash of the ``length`` words from each word on; the last ``length - 1`` are missing."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    values = mixed(hashes, seed)
    base = (_BASE * (2 * seed + 1)) % 2**64 | 1
    if length <= 8:
        total, factor = np.zeros(n, np.uint64), 1
        for i in range(length):
            total += values[i : i + n] * np.uint64(factor)
            factor = factor * base % 2**64
    else:
        up, down = _power_table(base, len(hashes))
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(values * up[: len(hashes)], out=sums[1:])
        total = (sums[length:] - sums[:n]) * down[:n]
    return mixed(total, seed + 77)


def shingles(table: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, and where each text's begin; sorted in a text.

    A text of fewer words has one shingle, its whole sequence; without words it has none.
    """
    counts = np.diff(table.bounds)
    all_hashes = window_hashes(table.hashes, length)
    at = np.flatnonzero(table.windows(length))
    owner, found = table.owners[at], all_hashes[at]
    for short in range(1, length):
        whole = np.flatnonzero(counts == short)
        if len(whole):
            owner = np.concatenate([owner, whole])
            found = np.concatenate([found, window_hashes(table.hashes, short, seed=9)[table.bounds[whole]]])
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    owner, found = owner[fresh], found[fresh]
    return found, np.searchsorted(owner, np.arange(len(counts) + 1))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """A list column whose row ``i`` is ``values[bounds[i]:bounds[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))

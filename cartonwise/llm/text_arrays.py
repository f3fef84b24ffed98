"""Words of whole Arrow batches as numpy arrays: no loop over words.

A word is a maximal run of bytes other than ASCII white space, so it never crosses a text. A word's hash is a polynomial
over a random 64-bit value for each byte, taken modulo 2**64 and mixed; it depends on the word alone, never on its place,
task or process.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


@cache
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20_240_601).integers(1, 2**63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


@cache
def _space_flags() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(SPACES)] = True
    return flags


_KEPT_POWERS = 1 << 20
_kept: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to `size`. One table serves the usual sizes; a longer one is made anew and not
    kept, so that a worker does not hold tables of the longest texts it has met."""
    if size <= _KEPT_POWERS and _kept:
        return tuple(table[:size + 1] for table in _kept[0])
    made = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(size, _KEPT_POWERS), b, np.uint64), dtype=np.uint64)])
                 for b in (_BASE, pow(_BASE, -1, 2**64)))
    if size <= _KEPT_POWERS:
        _kept.append(made)
    return tuple(table[:size + 1] for table in made)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts. starts, ends: byte places in `data`; first[i]:first[i + 1]: the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data, self.offsets, self.lower = data, offsets, lower
        solid = ~_space_flags()[data]
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        opens[edges] = solid[edges]
        closes[edges - 1] = solid[edges - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        size = len(self.data)
        up, down = _powers(1 << max(12, (size - 1).bit_length()))
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        with np.errstate(over="ignore"):
            np.cumsum(_byte_values(self.lower)[self.data] * up[:size], out=sums[1:])
            word = (sums[self.ends] - sums[self.starts]) * down[self.starts]
            return mix(word + (self.ends - self.starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of `width` words; empty when there are fewer words."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for place in range(width):
            total = total * np.uint64(_BASE) + words[place:place + count]
    return mix(total)


def texts_of(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows whose texts have about most_bytes together, so that the
    arrays made from them stay small; one longer text comes alone and whole. A null text has no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    rows = len(column)
    if not rows:
        return
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + rows + 1]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        end = min(end, rows)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end

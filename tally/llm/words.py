"""Words of many texts at once: bounds, 64-bit hashes and n-grams, in numpy.

Words are found on UTF-8 bytes. Every separator is an ASCII byte, so no character is cut.
Hashes are polynomials over a table of 64-bit values, taken modulo 2**64 and mixed; two
different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on together; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 18

BASE = 0x9E3779B97F4A7C15 | 1
GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)
_U64 = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a 64-bit finalizer)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _byte_table(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if fold:
        values[65:91] = values[97:123]
    return values


_VALUES = {fold: _byte_table(fold) for fold in (False, True)}


def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _not_alphanumeric() -> np.ndarray:
    table = np.zeros(256, bool)
    table[:128] = True
    for first, last in ("09", "az", "AZ"):
        table[ord(first) : ord(last) + 1] = False
    return table


#: Separators: white space, and every ASCII byte but digits and letters.
SPACES = _spaces()
NOT_ALPHANUMERIC = _not_alphanumeric()

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base & _U64, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


@dataclass
class Words:
    """Words of a run of texts. Text ``i`` of the run has words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, fold: bool) -> np.ndarray:
        """One value a word; with ``fold``, A-Z count as a-z."""
        n = len(self.data)
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[fold][self.data] * up[:n], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def runs(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut texts into runs of at most ``most`` bytes, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words of the texts between ``offsets``, none of which crosses into the next text."""
    data = data[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
    ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def each_run(column: pa.Array, separators: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    data, offsets = buffers(column)
    for i, j in runs(offsets):
        yield i, j, words_of(data, offsets[i : j + 1], separators)


def grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """Unmixed values of all runs of ``length`` words, whatever text they lie in."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * GRAM_BASE + hashes[i : i + n]
    return out


def longer(short: np.ndarray, length: int) -> np.ndarray:
    """Values of runs of twice ``length`` words from those of ``length`` words."""
    n = len(short) - length
    if n <= 0:
        return np.zeros(0, np.uint64)
    return short[:n] * np.uint64(pow(int(GRAM_BASE), length, 1 << 64)) + short[length:]

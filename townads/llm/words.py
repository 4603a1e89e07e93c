"""Words of Arrow text columns as arrays of fingerprints, without a Python object per word.

A word is a maximal run of the bytes that a table of 256 entries maps to non-zero; the mapped bytes
are what is hashed, so a table can also fold letters. Work on the bytes goes in slices, so memory
beyond the text itself stays small for texts of any length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_SLICE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def _table(is_word, fold) -> np.ndarray:
    return np.array([fold(b) if is_word(fold(b)) else 0 for b in range(256)], dtype=np.uint8)


def _lower(b: int) -> int:
    return b + 32 if 0x41 <= b <= 0x5A else b


# Letters and digits of ASCII, lower-cased, and all bytes of other characters.
FOLDED = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80, _lower)
# All but ASCII white space; byte 0 belongs to words as well and gets the otherwise unused value 9.
UNCHANGED = _table(lambda b: b not in (0x20, 0x0A, 0x0B, 0x0C, 0x0D), lambda b: b)
UNCHANGED[9], UNCHANGED[0] = 0, 9


class Words(NamedTuple):
    """Words of a batch in order: fingerprint, byte span in the text buffer, row."""

    prints: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray  # of each row, and one more: where its words begin


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base to the power 0, 1, ... n-1, modulo 2 to the power 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, _SLICE), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each row, with one more at the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def parts(batch: pa.RecordBatch | pa.Table, column: str, limit: int) -> Iterator[pa.Table]:
    """The batch in pieces of consecutive rows whose texts have about ``limit`` bytes, whole rows each."""
    rows = batch if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])
    _, offsets = buffers(rows[column])
    at = 0
    while at < rows.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield rows.slice(at, to - at)
        at = to
        pa.default_memory_pool().release_unused()
    give_back()


def give_back() -> None:
    """Returns memory that is free to the system; a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def thrifty(run):
    """A function of one group that gives its memory back after each."""

    def given_back(group: pa.Table) -> pa.Table:
        out = run(group)
        give_back()
        return out

    return given_back


def words_of(texts: pa.Array | pa.ChunkedArray, table: np.ndarray) -> Words:
    """The words of a text column; a null text has none."""
    if not len(texts):
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, none, np.zeros(1, dtype=np.int64))
    data, offsets = buffers(texts)
    low, high = int(offsets[0]), int(offsets[-1])
    inside = table[data[low:high]] != 0
    edges = np.zeros(len(inside) + 1, dtype=bool)
    edges[:-1] = inside
    opens = edges.copy()
    opens[1:] &= ~edges[:-1]
    begins = offsets[(offsets < high)] - low
    opens[begins] = edges[begins]
    closes = np.zeros(len(edges), dtype=bool)
    closes[1:] = inside & (~edges[1:] | opens[1:])
    starts, ends = np.flatnonzero(opens) + low, np.flatnonzero(closes) + low
    first = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(_prints(data, starts, ends, table), starts, ends, rows, first)


def _prints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _SLICE, side="right")))
        span = table[data[low : ends[to - 1]]].astype(np.uint64)
        sums = np.zeros(len(span) + 1, dtype=np.uint64)
        np.cumsum(span * powers(_BASE, len(span)), out=sums[1:])
        begin, end = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[end] - sums[begin]) * powers(_INVERSE, len(span))[begin]
        at = to
    return mixed(out + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def rolling(prints: np.ndarray, length: int, base: int = _BASE) -> np.ndarray:
    """Rabin-Karp values of all runs of ``length`` fingerprints, modulo 2 to the power 64."""
    n = len(prints) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    inverse = pow(base, -1, 1 << 64)
    for at in range(0, n, _SLICE):
        to = min(n, at + _SLICE)
        span = prints[at : to + length - 1]
        sums = np.zeros(len(span) + 1, dtype=np.uint64)
        np.cumsum(span * powers(base, len(span)), out=sums[1:])
        out[at:to] = (sums[length:] - sums[:-length]) * powers(inverse, to - at)
    return mixed(out)

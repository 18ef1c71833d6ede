"""Words of Arrow string columns as numpy arrays, without a Python string for each word.

A word's 64-bit hash takes its bytes in steps of eight through a bijection that spreads them, so
words of one length up to eight bytes never share a hash; words and lines of more than ``LONG``
bytes are hashed by BLAKE2. Runs of words are hashed by doubling: two runs of p words give one of 2p,
with the bijection after each step, so no algebra of the words' hashes (as of polynomials,
where the Thue-Morse words of a power of two letters agree) survives.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
#: Bytes handled at a time, unless one text is longer.
SLICE = 1 << 20
#: Bytes of a word or line up to which it is hashed by steps.
LONG = 512

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads them (splitmix)."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PART = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end) of each word or line."""
    n = end - start
    out = mix(n.astype(U), 5)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each position on
    live = np.flatnonzero(n <= LONG)
    at, left = start[live], n[live]
    while len(live):
        out[live] = mix(out[live] ^ (eight[at] & _PART[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(n > LONG).tolist():
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` values in a row."""
    out, done, p, power = None, 0, 1, h
    while True:
        if size & p:
            if out is None:
                out = power
            else:
                m = max(0, min(len(out), len(power) - done))
                out = mix(out[:m] * ODD + power[done : done + m], p)
            done += p
        if done == size:
            return mix(out[: max(0, len(h) - size + 1)], size)
        power, p = mix(power[: max(0, len(power) - p)] * ODD + power[p:], 11), 2 * p


@dataclass
class Words:
    """The words of rows [row, row + n) of a batch."""

    row: int
    n: int
    data: np.ndarray  # bytes of the slice
    text: np.ndarray  # n + 1 byte offsets of the texts in data
    start: np.ndarray  # byte offset of each word in data
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # n + 1 indexes of the texts' words

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.first))


def texts(column: pa.Array):
    """Offsets and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def words(column: pa.Array, lower: bool = False, white: np.ndarray = _WHITE):
    """Yield Words over slices of a column; white tells which bytes part words."""
    at, data = texts(column)
    row = 0
    while row < len(at) - 1:
        n = max(1, int(np.searchsorted(at, at[row] + SLICE, "right")) - 1 - row)
        yield hashed(data[at[row] : at[row + n]], at[row : row + n + 1] - at[row], row, lower, white)
        row += n


def hashed(data: np.ndarray, text: np.ndarray, row: int, lower: bool, white: np.ndarray = _WHITE) -> Words:
    white = white[data]
    edge = np.ones(len(data) + 1, bool)  # the byte before each position ends a word
    edge[1:] = white
    edge[text] = True
    solid = ~white
    start = np.flatnonzero(solid & edge[:-1])
    ends = np.ones(len(data) + 1, bool)
    ends[:-1] = white
    ends[text] = True
    end = np.flatnonzero(solid & ends[1:]) + 1
    h = hashes(_LOWER[data] if lower else data, start, end)
    return Words(row, len(text) - 1, data, text, start, end, h, np.searchsorted(start, text).astype(np.int64))


def shingles(w: Words, size: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words, and n + 1 indexes of the texts' first runs.

    A text with fewer words (one at least) has its whole sequence as one run if whole_if_short.
    """
    count = np.diff(w.first)
    h = runs(w.hash, size)
    begin, row = np.arange(len(h)), w.row_of[: len(h)]
    keep = begin + size <= w.first[1:][row]
    h, row = h[keep], row[keep]
    if whole_if_short and (short := np.flatnonzero((count > 0) & (count < size))).size:
        extra = mix(count[short].astype(U), 7)
        for k in range(size - 1):
            has = count[short] > k
            extra[has] = mix(extra[has] * ODD + w.hash[w.first[short[has]] + k], 13)
        h, row = np.concatenate([h, extra]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        h, row = h[order], row[order]
    return h, np.searchsorted(row, np.arange(w.n + 1)).astype(np.int64)


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The bytes [start, end) of each word as one string array."""
    n = end - start
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    taken = data[np.repeat(start - at[:-1], n) + np.arange(at[-1])]
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(taken))

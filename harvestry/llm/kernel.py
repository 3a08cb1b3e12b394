"""Vectorised text kernels on the bytes of Arrow string columns.

A batch is cut into blocks of whole rows (about a megabyte, or one row if it is longer), and each block is handled by a
fixed number of numpy passes; there is no Python loop over words. Each byte of a word, and each word of a sequence, is mixed
with its place before the sum is taken modulo 2**64, so a word has the same hash wherever it stands, and no order of two
letters or words cancels out, as it does in a polynomial modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEY = np.uint64(0x3C6EF372FE94F82A)
_NEAR = 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with full avalanche."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _placed(code: np.ndarray) -> np.ndarray:
    return mix(code.astype(np.uint64) * _ODD + _KEY)


_BYTES = _placed(np.arange(_NEAR * 256))  # a byte at one of the first _NEAR places
_PLACES = _placed(np.arange(1 << 12) | 1 << 40)


@dataclass
class Block:
    """Rows first .. first+len(offsets)-2 of a batch; offsets are into data."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    """The UTF-8 bytes of a string column (null: empty), in blocks of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield Block(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


@dataclass
class Tokens:
    """Words of a block: byte spans, the row of each, and a 64-bit hash; `bounds` gives the words of row r as bounds[r]:bounds[r+1]."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def spans_of(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that stay within a row: starts and ends."""
    n = len(keep)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.empty(n, dtype=bool)
    first[0] = True
    np.logical_not(keep[:-1], out=first[1:])
    last = np.empty(n, dtype=bool)
    last[-1] = True
    np.logical_not(keep[1:], out=last[:-1])
    cuts = offsets[1:-1]
    first[cuts[cuts < n]] = True
    last[cuts[cuts > 0] - 1] = True
    return np.flatnonzero(first & keep), np.flatnonzero(last & keep) + 1


def _expanded(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index and place of every element of ranges, and where each range begins among them."""
    first = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(first[-1]) - np.repeat(first[:-1], size)
    return np.repeat(start, size) + place, place, first


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return mix(total[first[1:]] - total[first[:-1]])


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes data[start:end] for each pair."""
    index, place, first = _expanded(start, end - start)
    code = place << 8 | data[index]
    value = _BYTES[np.minimum(code, len(_BYTES) - 1)]
    far = np.flatnonzero(place >= _NEAR)
    value[far] = _placed(code[far])
    return _sums(value, first)


def sequence_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 1 << 21) -> np.ndarray:
    """64-bit hash of the sequence values[start:end] for each pair; ranges may overlap and are handled `most` elements (or one range) at a time."""
    size, out, at = end - start, np.zeros(len(start), dtype=np.uint64), 0
    total = np.cumsum(size)
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        index, place, first = _expanded(start[at:to], size[at:to])
        key = _PLACES[np.minimum(place, len(_PLACES) - 1)]
        far = np.flatnonzero(place >= len(_PLACES))
        key[far] = _placed(place[far] | 1 << 40)
        out[at:to] = _sums(mix(values[index] + key), first)
        at = to
    return out


def chained(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of `width` values, each mixed with those before it."""
    n = max(0, len(h) - width + 1)
    value = np.zeros(n, dtype=np.uint64)
    for k in range(width if n else 0):
        value = mix(value * _ODD + h[k : n + k])
    return value


def tokens(block: Block, lower: bool = True) -> Tokens:
    """Words: runs without ASCII white space, A-Z folded to a-z if `lower`."""
    data = LOWER[block.data] if lower else block.data
    start, end = spans_of(~SPACE[block.data], block.offsets)
    return Tokens(start, end, np.searchsorted(start, block.offsets), range_hash(data, start, end))


def shingles(tok: Tokens, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each run of `width` words; a row with fewer words, but any, has its whole sequence as one."""
    h, n = tok.hash, np.diff(tok.bounds)
    row = tok.row
    if len(h) >= width:
        value = chained(h, width)
        inside = row[: len(value)] == row[width - 1 :]
        rows, values = row[: len(value)][inside], value[inside]
    else:
        rows, values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        own = np.array([_whole(h[tok.bounds[r] : tok.bounds[r + 1]]) for r in short], dtype=np.uint64)
        rows, values = np.concatenate([rows, short]), np.concatenate([values, own])
        order = np.argsort(rows, kind="stable")
        rows, values = rows[order], values[order]
    return rows, values


def _whole(h: np.ndarray) -> np.uint64:
    return mix(chained(h, len(h)) + np.uint64(len(h)))[0]


def sets(tok: Tokens, width: int) -> list[np.ndarray]:
    """For each row the sorted distinct shingles."""
    rows, values = shingles(tok, width)
    where = np.searchsorted(rows, np.arange(len(tok.bounds)))
    return [np.unique(values[where[r] : where[r + 1]]) for r in range(len(where) - 1)]


def binary_column(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())

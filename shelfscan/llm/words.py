"""Vectorised word splitting and hashing over Arrow text columns, used inside tasks.

Everything works on the UTF-8 buffer of a column: no Python object per word. Word
hashes are 64-bit polynomials over the word's bytes, mixed; sequences of words are
hashed from those again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 21
_powers: dict[int, np.ndarray] = {}


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(members, dtype=np.uint8)] = True
    return table


#: Bytes of words: all but ASCII white space; and letters, digits and everything non-ASCII.
NOT_SPACE = ~byte_table(b" \t\n\v\f\r")
ALPHANUMERIC = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1024), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class RangeHash:
    """Hashes of value ranges, each in constant time, from one running sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self.sums[1:])
        self.inverse = powers(pow(_BASE, -1, 1 << 64), n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and each row's offsets into them; a null has no bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    held = np.frombuffer(data, dtype=np.uint8)[first:last] if data is not None else np.empty(0, dtype=np.uint8)
    return held, offsets - first


class Words:
    """The words of a text column: byte ranges, row ranges and hashes."""

    def __init__(self, column: pa.Array, members: np.ndarray = NOT_SPACE, lower: bool = False):
        data, offsets = buffers(column)
        self.data = LOWER[data] if lower else data
        inside = members[self.data]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[:-1][np.diff(offsets) > 0]
        begins[edges] = inside[edges]
        lasts = offsets[1:][np.diff(offsets) > 0] - 1
        closes[lasts] = inside[lasts]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(closes) + 1
        #: row i has the words rows[i] to rows[i + 1] - 1
        self.rows = np.searchsorted(self.starts, offsets)
        self.row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(self.rows))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), dtype=np.uint64)
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + _CHUNK)))
            base = self.starts[at]
            part = RangeHash(self.data[base : self.ends[to - 1]].astype(np.uint64) + np.uint64(1))
            out[at:to] = part(self.starts[at:to] - base, self.ends[at:to] - base)
            at = to
        return out

    def whole(self, length: int) -> np.ndarray:
        """Starts of the sequences of ``length`` words that lie in one row."""
        if len(self) < length:
            return np.empty(0, dtype=np.int64)
        return np.flatnonzero(self.row_of[: len(self) - length + 1] == self.row_of[length - 1 :])


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` positions lie in one of the ranges."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of ``counts`` values each, cut from one flat array."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(values, type=kind))


class Lines(Words):
    """The lines of a text column, cut at newlines, empty lines included; every row has one at least."""

    def __init__(self, column: pa.Array):
        self.data, offsets = buffers(column)
        breaks = np.flatnonzero(self.data == 10)
        row = np.searchsorted(offsets, breaks, side="right") - 1
        n = len(offsets) - 1
        starts = np.concatenate([offsets[:-1], breaks + 1])
        rows = np.concatenate([np.arange(n), row])
        order = np.lexsort((starts, rows))
        self.starts, self.row_of = starts[order], rows[order]
        self.rows = np.searchsorted(self.row_of, np.arange(n + 1))
        self.ends = np.append(self.starts[1:] - 1, 0)
        self.ends[self.rows[1:] - 1] = offsets[1:]

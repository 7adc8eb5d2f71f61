"""Periodic runs of words, by the branching tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at least
``min_length`` words and ``min_exponent`` periods, that no neighbouring word extends.

Method, for all texts of a batch in one array:

* Words get exact numbers (a dictionary of the batch), and suffixes of each text are sorted by prefix doubling.
  A run has ``min_exponent`` suffixes that share its period, so groups of fewer suffixes
  are never sorted further; what stays is only what can hold a run.
* LCP values come from the ranks of the doubling rounds. LCP intervals are found by
  previous and next smaller values, as index ranges: there are no tree nodes.
* Branching tandem test: in an interval of depth d, every suffix i outside the largest child asks the inverse suffix array
  whether i + d or i - d lies in the interval, but in another child. If so, a square of period d
  stands there whose next word breaks the period: the last square of a run.
* Squares are rotated to the left as long as words d apart are identical, which gives the whole run. Squares of a
  multiple of the period end at the same word and merge into the run of the smallest period.

A word is dropped if a run holds it after that run's first period; the others are kept.

* null text, empty text, text without a word: no words, no run, nothing kept (an empty text)
* null id: like any other; repeated rows and equal texts: one result row each
* ties and overlaps: runs that overlap are all reported, by start, then period
* very long texts: a batch holds a few MB of text or one row; a text of n words takes about 4 n bytes
  per doubling round (as many rounds as its longest often repeated passage has binary digits) and 100 n bytes besides
* empty table: empty result; other columns are ignored

Rows are independent: nothing is shuffled, and no key can be hot.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.words import NOT_SPACE, Words, covered, pieces
from shelfscan.sources.shipping import ship

MIN_LENGTH = 6
MIN_EXPONENT = 4
_UNSORTED = np.int64(1) << 40


def word_numbers(words: Words) -> np.ndarray:
    """Equal words have equal numbers."""
    if not len(words):
        return np.empty(0, dtype=np.int64)
    held = words.data[NOT_SPACE[words.data]]
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(held)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


class SuffixArray:
    """Suffixes of all rows, sorted within their row as far as groups of ``copies`` suffixes share a prefix.

    ``array`` holds suffix starts, ``inverse`` their places, ``lcp[s]`` the words that the suffixes at s - 1 and s share
    (a very large number in groups left unsorted, 0 between rows).
    """

    def __init__(self, codes: np.ndarray, rows: np.ndarray, ends: np.ndarray, copies: int):
        n = len(codes)
        key = rows * np.int64(codes.max(initial=0) + 1) + codes
        self.array = np.argsort(key, kind="stable")
        held = key[self.array]
        opens = np.append(True, held[1:] != held[:-1]) if n else np.empty(0, dtype=bool)
        group = np.empty(n, dtype=np.int32)
        group[self.array] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
        self.levels = [group]
        k = 1
        while True:
            starts = np.flatnonzero(opens)
            sizes = np.diff(np.append(starts, n))
            slots = np.flatnonzero(np.repeat(sizes >= copies, sizes))
            if not len(slots):
                break
            at = self.array[slots]
            group = self.levels[-1]
            follow = at + k
            inside = follow < ends[at]
            second = np.where(inside, group[np.where(inside, follow, 0)], -1)
            key = group[at].astype(np.int64) * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            self.array[slots] = at
            new = np.append(True, key[1:] != key[:-1])
            opens[slots] = new
            group = group.copy()
            group[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
            self.levels.append(group)
            k *= 2
        self.inverse = np.empty(n, dtype=np.int64)
        self.inverse[self.array] = np.arange(n)
        self.lcp = self._lcp(opens, ends)

    def _lcp(self, opens: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(self.array)
        lcp = np.where(opens, 0, _UNSORTED)
        first = self.levels[0][self.array]
        slots = np.flatnonzero(opens[1:] & (first[1:] == first[:-1])) + 1
        x, y = self.array[slots - 1], self.array[slots]
        shared = np.zeros(len(slots), dtype=np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            inside = np.flatnonzero((x < ends[self.array[slots - 1]]) & (y < ends[self.array[slots]]))
            same = inside[self.levels[j][x[inside]] == self.levels[j][y[inside]]]
            for moved in (x, y, shared):
                moved[same] += 1 << j
        lcp[slots] = shared
        return np.concatenate([[-1], lcp[1:], [-1]]) if n else np.full(1, -1)

    def intervals(self, copies: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots where the children of LCP intervals of ``copies`` suffixes or more begin, and those intervals' bounds."""
        lcp, n = self.lcp, len(self.array)
        bounds = []
        for step in (-1, 1):
            near = np.arange(n + 1) + step
            todo = np.flatnonzero(lcp > 0)
            while len(todo := todo[lcp[near[todo]] >= lcp[todo]]):
                near[todo] = near[near[todo]]
            bounds.append(near)
        slots = np.flatnonzero((lcp > 0) & (lcp < _UNSORTED))
        left, right = bounds[0][slots], bounds[1][slots]
        large = right - left >= copies
        return slots[large], left[large], right[large]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and each one's range."""
    of = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of], of


def branching_squares(suffixes: SuffixArray, first: np.ndarray, ends: np.ndarray, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of squares that the next word breaks."""
    slots, left, right = suffixes.intervals(copies)
    if not len(slots):
        return slots, slots
    name = left * np.int64(len(suffixes.array) + 2) + right
    order = np.lexsort((slots, name))
    slots, left, right, name = slots[order], left[order], right[order], name[order]
    opens = np.append(True, name[1:] != name[:-1])
    interval = np.cumsum(opens) - 1
    depth = suffixes.lcp[slots[opens]]
    low, high = left[opens], right[opens]
    # children: from the interval's start and from each of its slots up to the next
    begin, of = np.concatenate([low, slots]), np.concatenate([np.arange(len(low)), interval])
    order = np.lexsort((begin, of))
    begin, of = begin[order], of[order]
    last = np.append(of[1:] != of[:-1], True)
    end = np.where(last, high[of], np.append(begin[1:], 0))
    size = end - begin
    largest = np.lexsort((size, of))[np.flatnonzero(last)]
    small = np.ones(len(begin), dtype=bool)
    small[largest] = False
    begin, end, of, size = begin[small], end[small], of[small], size[small]
    slot, child = _ranges(begin, size)
    at = suffixes.array[slot]
    d = depth[of[child]]
    found = []
    for other, start in ((at + d, at), (at - d, at - d)):
        ok = np.flatnonzero((other < ends[at]) & (other >= first[at]))
        place, c = suffixes.inverse[other[ok]], child[ok]
        hit = (place >= low[of[c]]) & (place < high[of[c]]) & ((place < begin[c]) | (place >= end[c]))
        found.append((start[ok[hit]], d[ok[hit]]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _rotated(codes: np.ndarray, at: np.ndarray, period: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The smallest start from which words a period apart are identical up to ``at``."""
    at = at.copy()
    todo, block = np.flatnonzero(at > first), 64
    while len(todo):
        width = np.minimum(block, at[todo] - first[todo])
        place, of = _ranges(at[todo] - width, width)
        broken = np.where(codes[place] != codes[place + period[todo][of]], place, -1)
        last = np.maximum.reduceat(broken, np.cumsum(width) - width)
        at[todo] = np.where(last >= 0, last + 1, at[todo] - width)
        todo = todo[(last < 0) & (at[todo] > first[todo])]
        block *= 4
    return at


def find_runs(
    codes: np.ndarray, rows: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (in the array), lengths and periods of all runs, by start, then period; row r has the words bounds[r] to bounds[r + 1] - 1."""
    first, ends = bounds[:-1][rows], bounds[1:][rows]
    suffixes = SuffixArray(codes, rows, ends, min_exponent)
    square, period = branching_squares(suffixes, first, ends, min_exponent)
    close = square + 2 * period
    need = np.maximum(min_length, min_exponent * period)
    possible = np.flatnonzero(close - need >= first[square]) if len(square) else square
    square, period, close, need = square[possible], period[possible], close[possible], need[possible]
    for part in range(4):  # cheap look before the whole comparison
        x = close - need + (need - period - 1) * part // 3
        same = codes[x] == codes[x + period]
        square, period, close, need = square[same], period[same], close[same], need[same]
    order = np.lexsort((period, close))
    square, period, close, need = square[order], period[order], close[order], need[order]
    out = []
    while len(square):
        lead = np.append(True, close[1:] != close[:-1])
        start = _rotated(codes, square[lead], period[lead], first[square[lead]])
        length = close[lead] - start
        long = length >= need[lead]
        out.append((start[long], length[long], period[lead][long]))
        of = np.cumsum(lead) - 1
        merged = (period % period[lead][of] == 0) & (square >= start[of])
        square, period, close, need = square[~merged], period[~merged], close[~merged], need[~merged]
    starts, lengths, periods = (np.concatenate(c) if out else np.empty(0, dtype=np.int64) for c in (zip(*out, strict=True) if out else ((), (), ())))
    order = np.lexsort((periods, starts))
    return starts[order], lengths[order], periods[order]


def _collapse(batch: pa.RecordBatch, min_length: int, min_exponent: int) -> pa.RecordBatch:
    texts = batch.column("text")
    words = Words(texts)
    starts, lengths, periods = find_runs(word_numbers(words), words.row_of, words.rows, min_length, min_exponent)
    dropped = covered(len(words), starts + periods, starts + lengths)
    row = words.row_of[starts]
    counts = np.bincount(row, minlength=batch.num_rows)
    struct = pa.StructArray.from_arrays(
        [pa.array(starts - words.rows[row]), pa.array(lengths), pa.array(periods)], ["start", "length", "period"]
    )
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    kept = []
    for r, text in enumerate(texts):
        parts = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
        if counts[r]:
            parts = compress(parts, (~dropped[words.rows[r] : words.rows[r + 1]]).tolist())
        kept.append(b" ".join(parts))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id"), pa.array(np.diff(words.rows)), pa.ListArray.from_arrays(offsets, struct),
            pa.array(kept, type=pa.binary()).cast(pa.string()),
        ],
        ["id", "n_words", "runs", "kept"],
    )


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """id, n_words, runs (start, length, period; words from 0) and kept (the words that are left, joined by one space) of every row.

    ``min_exponent`` is 2 at least.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 at least")
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def rows(batches):
        for batch in pieces(batches, "text"):
            yield _collapse(batch, min_length, min_exponent)

    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(rows, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string")

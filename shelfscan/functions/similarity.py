"""Token-sort similarity (0-100): words sorted, then 200 * LCS / (total length), for many pairs at once."""

from __future__ import annotations

from functools import cached_property

import numpy as np

_CELLS = 1 << 22
_WORD = 64
#: Pairs whose common subsequences are computed together; their words stay in the cache.
_TOGETHER = 1 << 13


def sorted_tokens(name: str) -> str:
    return " ".join(sorted(name.split()))


def _codes(texts: list[str], filler: int) -> np.ndarray:
    """Character codes, one row per text, filled up on the right."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.full((len(texts), int(lengths.max(initial=0))), filler, dtype=np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32)
    return out


class CharacterBags:
    """Texts with their character counts and letter pairs, and what two of them can have in common at most."""

    BUCKETS, LEVELS, PAIR_WORDS = 128, 6, 4

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.codes = _codes(texts, -1)
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        row, column = np.nonzero(self.codes >= 0)
        places = row * self.BUCKETS + self._buckets(self.codes[row, column])
        self.counts = np.bincount(places, minlength=len(texts) * self.BUCKETS).reshape(len(texts), self.BUCKETS)

    @staticmethod
    def _buckets(codes: np.ndarray) -> np.ndarray:
        """Printable ASCII each for itself, everything else in 32 buckets."""
        return np.where((codes >= 32) & (codes < 127), codes - 32, 96 + codes % 32)

    @classmethod
    def bucket(cls, character: str) -> int:
        return int(cls._buckets(np.array([ord(character)]))[0])

    @cached_property
    def _levels(self) -> np.ndarray:
        """A column for each number of repeats and bucket: 1 where a text has as many."""
        return np.concatenate([self.counts >= j for j in range(1, self.LEVELS + 1)], axis=1)

    @cached_property
    def _beyond(self) -> np.ndarray:
        """The characters beyond the levels."""
        return np.maximum(self.counts - self.LEVELS, 0).sum(axis=1).astype(np.float32)

    @cached_property
    def _used(self) -> tuple[np.ndarray, np.ndarray]:
        """The columns of levels that a text has, and those columns."""
        used = np.flatnonzero(self._levels.any(axis=0))
        return used, self._levels[:, used].astype(np.float32)

    @cached_property
    def _pairs(self) -> np.ndarray:
        """Which pairs of neighbouring characters a text has, as bits of a few words, by hash."""
        width = self.PAIR_WORDS * _WORD
        here, after = self.codes[:, :-1].astype(np.int64), self.codes[:, 1:].astype(np.int64)
        row, column = np.nonzero(after >= 0)
        number = (here[row, column] * 8191 + after[row, column] * 31) % 65521 % width
        bits = np.zeros((len(self.texts), width), dtype=bool)
        bits[row, number] = True
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")

    def margins(self, other: CharacterBags, least: np.ndarray) -> np.ndarray:
        """How many more characters every text may share with every text of ``other`` than a similarity of ``least`` (one for each text) needs.

        Below zero, the similarity is below ``least``. A little more than exact, for the rounding.
        """
        used, mine = self._used
        part = (least / 200.0).astype(np.float32)
        left = np.concatenate([mine, -part[:, None]], axis=1)
        right = np.concatenate([other._levels[:, used], other.lengths[:, None]], axis=1, dtype=np.float32)
        out = left @ right.T
        if self._beyond.any() and other._beyond.any():
            out += np.minimum(self._beyond[:, None], other._beyond[None, :])
        out -= (part * self.lengths - 1e-5 * (self.lengths + other.lengths.max(initial=0) + 1))[:, None].astype(np.float32)
        return out

    def bounds(self, other: CharacterBags) -> np.ndarray:
        """Upper bounds of the similarity of every text with every text of ``other``, by character counts."""
        total = self.lengths[:, None] + other.lengths[None, :]
        # a little more, for the rounding of the division
        return np.where(total > 0, 200.0 * self.margins(other, np.zeros(len(self.texts))) / np.maximum(total, 1), 100.0) + 1e-6

    def pair_bounds(self, other: CharacterBags, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Upper bounds of the similarity of self[rows[i]] and other[columns[i]] by neighbouring characters.

        A character outside the common subsequence parts at most two pairs of its own text and one of the other, so texts that
        differ in p pairs have p / 3 such characters or more.
        """
        differing = np.zeros(len(rows), dtype=np.int64)
        for word in range(self.PAIR_WORDS):
            differing += np.bitwise_count(self._pairs[:, word][rows] ^ other._pairs[:, word][columns])
        total = self.lengths[rows] + other.lengths[columns]
        return 100.0 - differing * (100.0 / 3.0) / np.maximum(total, 1) + 1e-6


def common_lengths(left: CharacterBags, right: CharacterBags, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Longest common subsequence of left[rows[i]] and right[columns[i]]."""
    out = np.zeros(len(rows), dtype=np.int64)
    short = right.lengths[columns] <= _WORD
    words = np.flatnonzero(short)
    if len(words):
        masks = _Masks(right)
        number = masks.numbers(left)
        for at in range(0, len(words), _TOGETHER):
            part = words[at : at + _TOGETHER]
            out[part] = masks.common(number, left.lengths, rows[part], columns[part])
    long = np.flatnonzero(~short)
    if len(long):
        step = max(1, _CELLS // (1 + int(right.lengths.max())))
        for at in range(0, len(long), step):
            part = long[at : at + step]
            out[part] = _common([left.texts[i] for i in rows[part]], [right.texts[j] for j in columns[part]])
    return out


class _Masks:
    """Of every text of up to 64 characters, the places of each character as bits of one word."""

    def __init__(self, bags: CharacterBags):
        codes = bags.codes[:, :_WORD]
        self.alphabet, number = np.unique(codes, return_inverse=True)
        number = number.reshape(codes.shape)
        self.bits = np.zeros((len(self.alphabet) + 1, len(codes)), dtype=np.uint64)
        row, column = np.nonzero(codes >= 0)
        np.bitwise_or.at(self.bits, (number[row, column], row), np.uint64(1) << column.astype(np.uint64))
        size = np.minimum(bags.lengths, _WORD).astype(np.uint64)
        self.whole = np.where(size == _WORD, ~np.uint64(0), (np.uint64(1) << (size % np.uint64(_WORD))) - np.uint64(1))

    def numbers(self, left: CharacterBags) -> np.ndarray:
        """Of the left texts, the row of the masks for each character: one line per place, for all texts."""
        place = np.minimum(np.searchsorted(self.alphabet, left.codes), len(self.alphabet) - 1)
        number = np.where(self.alphabet[place] == left.codes, place, len(self.alphabet))
        number[left.codes < 0] = len(self.alphabet)  # no bits: nothing changes
        return np.ascontiguousarray(number.T) * self.bits.shape[1]

    def common(self, number: np.ndarray, lengths: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """One addition per character of the left texts, for all pairs together; cleared bits count the sequence."""
        flat = self.bits.ravel()
        open_ = np.full(len(rows), ~np.uint64(0))
        hit, mask, at = np.empty_like(open_), np.empty_like(open_), np.empty(len(rows), dtype=np.int64)
        for step in range(int(lengths[rows].max(initial=0))):
            # every index is in bounds: "clip" only spares a copy
            np.add(number[step].take(rows, out=at, mode="clip"), columns, out=at)
            np.bitwise_and(open_, flat.take(at, out=mask, mode="clip"), out=hit)
            np.subtract(open_, hit, out=mask)
            np.add(open_, hit, out=open_)
            np.bitwise_or(open_, mask, out=open_)
        return np.bitwise_count(~open_ & self.whole[columns])


def similarities(left: list[str], right: list[str]) -> np.ndarray:
    """Similarity of left[i] and right[i]; two empty names are equal."""
    if not left:
        return np.empty(0)
    a, b = CharacterBags([sorted_tokens(t) for t in left]), CharacterBags([sorted_tokens(t) for t in right])
    each = np.arange(len(left))
    total = a.lengths + b.lengths
    return np.where(total > 0, 200.0 * common_lengths(a, b, each, each) / np.maximum(total, 1), 100.0)


def _common(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequence of each pair: one row of the table per character, all pairs together."""
    a, b = _codes(left, -1), _codes(right, -2)
    row = np.zeros((len(left), b.shape[1] + 1), dtype=np.int32)
    for column in range(a.shape[1]):
        hit = b == a[:, column : column + 1]
        row[:, 1:] = np.maximum.accumulate(np.where(hit, row[:, :-1] + 1, row[:, 1:]), axis=1)
    return row[:, -1]

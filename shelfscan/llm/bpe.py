"""BPE encoding and decoding of texts as bounded-lookahead streams.

The vocabulary file (public tokenizers format) states NFC, lower-casing, a split into words and merges
with a word-end suffix. A text is read slice by slice, cut at white space; a slice
becomes words, and a word's symbols run through a transducer:

* ``sufficient_lookahead`` follows, over the merge list, how far a change behind a cut can
  travel to the left. A merge (u, v) reacts to a change at its right end only if v starts
  with the left part of an earlier reacting merge, and passes it on by the length
  of u. The longest such chain is the number of symbols that must be known behind a token
  for it to be final.
* Tokens that end that far before the end of what was read are emitted, and their
  symbols forgotten; so a word of any length needs a buffer of fixed size. Words shorter than
  the buffer are complete when read; new ones of a slice are merged together, vectorised.

``Decoder`` turns ids back into text, id by id: in the library's form (tokens joined by one
space, for files without a decoder), or as plain text, with a state machine that holds an
incomplete UTF-8 character until its last byte has come.

* null text: encoded as the empty text: no ids, empty decoded text
* the files' special tokens in a text become their ids, as in the library
* repeated rows, null ids: encoded like any other; other columns are ignored
* empty table: empty result

Map-only, no shuffle. Each worker keeps the ids of recent words, up to a fixed number.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.words import list_column, pieces
from shelfscan.sources.shipping import ship

SLICE = 1 << 16
CACHED_WORDS = 300_000
SHORT = 48
#: White space of the split, as the files' regular expressions define it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


@cache
def _word_pattern() -> re.Pattern:
    """The files' split; letters and numbers are listed as ranges of the Unicode categories L and N.

    The categories are Python's; characters that a newer Unicode version assigns count as symbols here.
    """
    spans: dict[str, list[list[int]]] = {"L": [], "N": []}
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind in spans:
            if spans[kind] and spans[kind][-1][1] == code - 1:
                spans[kind][-1][1] = code
            else:
                spans[kind].append([code, code])
    letters, numbers = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans[k]) for k in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{SPACE}{letters}{numbers}]+")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens and merges of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: list[str] = [""] * (max(*ids.values(), *self.special.values()) + 1)
        for token, i in (ids | self.special).items():
            self.tokens[i] = token
        self.numbers = [str(i) for i in range(len(self.tokens))]
        symbols = _byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([ids[s] for s in symbols], dtype=np.int64)
        self.final = np.array([ids[s + self.suffix] for s in symbols], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        key = self.left * len(self.tokens) + self.right
        self.order = np.argsort(key)
        self.sorted_keys = key[self.order]
        self.rank_of = dict(zip(key.tolist(), range(len(key)), strict=True))

    def length(self, token: int) -> int:
        """Symbols of a token."""
        text = self.tokens[token]
        return len(text) - len(self.suffix) if text.endswith(self.suffix) else len(text)

    @property
    def is_proper(self) -> bool:
        """Each token comes from one merge, made before any merge that uses it; the chain argument rests on this."""
        born: dict[int, int] = {}
        for rank, token in enumerate(self.merged.tolist()):
            if token in born:
                return False
            born[token] = rank
        uses = zip(self.left.tolist(), self.right.tolist(), strict=True)
        return all(born.get(a, -1) < rank and born.get(b, -1) < rank for rank, (a, b) in enumerate(uses))

    def sufficient_lookahead(self) -> int:
        """Symbols that must be known behind a token for it to be final."""
        if not self.is_proper:
            raise ValueError("the merge list makes a token twice or uses it before it is made; no bound is known")
        first_part = dict(zip(self.merged.tolist(), self.left.tolist(), strict=True))
        reach: dict[int, int] = {}  # left part of a merge -> how far a change gets by merges up to here
        longest = 0
        for u, v in zip(self.left.tolist(), self.right.tolist(), strict=True):
            behind, part = 0, v
            while part is not None:
                behind = max(behind, reach.get(part, 0))
                part = first_part.get(part)
            here = behind + self.length(u)
            reach[u] = max(reach.get(u, 0), here)
            longest = max(longest, here)
        return longest

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        none = len(self.order)
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.sorted_keys, key), none - 1)
        return np.where((self.sorted_keys[at] == key) & (a >= 0) & (b >= 0), self.order[at], none)

    def merge_many(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of complete short words: in each round every word makes its first merge of lowest rank."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = int(sizes.max())
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        rows, none = np.repeat(np.arange(len(words)), sizes), len(self.order)
        ends = np.cumsum(sizes)
        grid = np.full((len(words), width + 1), -1, dtype=np.int64)
        grid[rows, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = self.inner[flat]
        grid[np.arange(len(words)), sizes - 1] = self.final[flat[ends - 1]]
        out = grid.copy()
        ranks = self._ranks(grid[:, :-1], grid[:, 1:])
        live, steps = np.arange(len(words)), np.arange(width + 1)
        while len(live):
            at = ranks.argmin(axis=1)
            here = np.arange(len(live))
            best = ranks[here, at]
            done = best == none
            if done.any():
                out[live[done]] = np.pad(grid[done], ((0, 0), (0, width + 1 - grid.shape[1])), constant_values=-1)
                live, grid, ranks, at, best = live[~done], grid[~done], ranks[~done], at[~done], best[~done]
                here = np.arange(len(live))
                if not len(live):
                    break
            n = grid.shape[1]
            shift = steps[: n - 1] + (steps[: n - 1] > at[:, None])
            grid = np.take_along_axis(grid, shift, axis=1)
            grid[here, at] = self.merged[best]
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=none), shift[:, : n - 2], axis=1)
            before = np.maximum(at - 1, 0)
            if n > 2:
                inside = at < n - 2
                ranks[here[inside], at[inside]] = self._ranks(grid[here[inside], at[inside]], grid[here[inside], at[inside] + 1])
                moved = at > 0
                ranks[here[moved], before[moved]] = self._ranks(grid[here[moved], before[moved]], grid[here[moved], at[moved]])
            else:
                ranks = np.full((len(live), 1), none)
                grid = np.pad(grid, ((0, 0), (0, 1)), constant_values=-1)
        counts = (out >= 0).sum(axis=1)
        held = iter(out[out >= 0].tolist())
        return [tuple(next(held) for _ in range(c)) for c in counts.tolist()]

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of one symbol sequence: lowest rank first, then leftmost, from a heap of adjacent pairs."""
        n, size = len(symbols), len(self.tokens)
        ids, after, before = list(symbols), [*range(1, n), -1], [-1, *range(n - 1)]
        rank, merged = self.rank_of, self.merged
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(merged[r]), -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y >= 0 and (s := rank.get(ids[x] * size + ids[y])) is not None:
                    heapq.heappush(heap, (s, x, ids[x], ids[y]))
        return [t for t in ids if t >= 0]


class Transducer:
    """Symbols of one word in, final tokens out; holds at most ``lookahead`` + ``block`` symbols and a token."""

    def __init__(self, vocabulary: Vocabulary, lookahead: int, block: int = 1024):
        self.vocabulary, self.lookahead, self.block = vocabulary, lookahead, block
        self.held: list[int] = []

    def feed(self, symbols: Iterable[int]) -> Iterator[int]:
        for symbol in symbols:
            self.held.append(symbol)
            if len(self.held) >= self.lookahead + self.block:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        end, limit = 0, len(self.held) - self.lookahead
        for token in self.vocabulary.merge(self.held):
            size = self.vocabulary.length(token)
            if end + size > limit:
                break
            end += size
            yield token
        self.held = self.held[end:]

    def close(self) -> Iterator[int]:
        yield from self.vocabulary.merge(self.held)
        self.held = []


class Decoder:
    """Text of ids that come one by one."""

    def __init__(self, vocabulary: Vocabulary, plain: bool = False):
        self.vocabulary, self.plain, self.begun = vocabulary, plain, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        """What is certain after these ids."""
        parts = [self.vocabulary.tokens[i] for i in ids]
        if not self.plain:
            text = " ".join(parts)
            gap = " " if self.begun and parts else ""
            self.begun |= bool(parts)
            return gap + text
        return "".join(map(self._plain, parts))

    def _plain(self, token: str) -> str:
        if token in self.vocabulary.special:
            return self.utf8.decode(b"", final=True) + token
        ends = token.endswith(self.vocabulary.suffix)
        body = token[: len(token) - len(self.vocabulary.suffix)] if ends else token
        text = self.utf8.decode(bytes(self.vocabulary.byte_of[c] for c in body), final=ends)
        return text + " " if ends else text

    def close(self) -> str:
        return self.utf8.decode(b"", final=True)


class Encoder:
    """Ids of UTF-8 texts; keeps the ids of recent words (what stands between ASCII white space)."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.lookahead = self.vocabulary.sufficient_lookahead()
        self.pattern = _word_pattern()
        self.known: dict[bytes, tuple[int, ...]] = {}
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, special)).encode()) if special else None

    def slices(self, text: bytes) -> Iterator[bytes]:
        """Parts of about SLICE bytes at most, unless a word is longer; cuts lie at white space, which no token has."""
        at = 0
        while len(text) - at > SLICE:
            cut = max(text.rfind(b" ", at + 1, at + SLICE), text.rfind(b"\n", at + 1, at + SLICE))
            if cut < 0:
                found = re.compile(b"[ \n]").search(text, at + SLICE)
                cut = found.start() if found else len(text)
            yield text[at:cut]
            at = cut
        yield text[at:]

    def _learn(self, words: set[bytes]) -> None:
        """Make sure that the ids of all these words are known."""
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known = {}
        parts: dict[bytes, list[bytes]] = {}
        for word in words:
            if word not in self.known:
                text = word.decode("utf-8", "replace")
                if not text.isascii():
                    # letters are lower-cased one by one: no special form at a word's end
                    text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
                parts[word] = [part.encode() for part in self.pattern.findall(text.lower())]
        ids = self._merged({part for some in parts.values() for part in some})
        for word, some in parts.items():
            self.known[word] = ids[some[0]] if len(some) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, some)))

    def _merged(self, parts: set[bytes]) -> dict[bytes, tuple[int, ...]]:
        groups: dict[int, list[bytes]] = {}
        for part in parts:
            groups.setdefault((len(part) + 3) // 4 if len(part) <= SHORT else 0, []).append(part)
        out = {part: tuple(self._long(part)) for part in groups.pop(0, ())}
        for members in groups.values():
            for at in range(0, len(members), 1 << 13):
                some = members[at : at + (1 << 13)]
                out.update(zip(some, self.vocabulary.merge_many(some), strict=True))
        return out

    def _long(self, word: bytes) -> Iterator[int]:
        stream = Transducer(self.vocabulary, self.lookahead)
        yield from stream.feed(self.vocabulary.inner[np.frombuffer(word[:-1], dtype=np.uint8)].tolist())
        yield from stream.feed([int(self.vocabulary.final[word[-1]])])
        yield from stream.close()

    def _ids(self, words: list[bytes]) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, words)))

    def encode(self, text: bytes) -> Iterator[list[int]]:
        """Ids, slice by slice."""
        at = 0
        for mark in self.specials.finditer(text) if self.specials else ():
            yield from self._encode(text[at : mark.start()])
            yield [self.vocabulary.special[mark.group().decode()]]
            at = mark.end()
        yield from self._encode(text[at:] if at else text)

    def _encode(self, text: bytes) -> Iterator[list[int]]:
        for part in self.slices(text):
            words = part.split()
            self._learn(set(words))
            yield self._ids(words)

    def encode_all(self, texts: list[bytes]) -> list[Iterable[list[int]]]:
        """Ids of each text, slice by slice; the words of short texts are learned together."""
        split = [None if len(t) > SLICE or (self.specials and self.specials.search(t)) else t.split() for t in texts]
        distinct: set[bytes] = set()
        for words in split:
            distinct.update(words or ())
        self._learn(distinct)
        return [self.encode(t) if words is None else [self._ids(words)] for t, words in zip(texts, split, strict=True)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _coded(batch: pa.RecordBatch, path: str, keep_ids: bool) -> pa.RecordBatch:
    coder = encoder(path)
    vocabulary = coder.vocabulary
    rows, held = [], []
    for parts in coder.encode_all([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]):
        decoder = Decoder(vocabulary)
        of_ids, of_text, n, own = hashlib.sha256(), hashlib.sha256(), 0, []
        for ids in parts:
            if ids:
                numbers = " ".join([vocabulary.numbers[i] for i in ids])
                of_ids.update((f" {numbers}" if n else numbers).encode())
                of_text.update(decoder.feed(ids).encode())
                n += len(ids)
                if keep_ids:
                    own.append(np.array(ids, dtype=np.int32))
        of_text.update(decoder.close().encode())
        rows.append((n, of_ids.hexdigest(), of_text.hexdigest()))
        held += own
    n = [r[0] for r in rows]
    columns = [batch.column("id"), pa.array(n, type=pa.int64()), *(pa.array([r[i] for r in rows], type=pa.string()) for i in (1, 2))]
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if keep_ids:
        flat = np.concatenate(held) if held else np.empty(0, dtype=np.int32)
        columns, names = [*columns, list_column(flat, np.array(n, dtype=np.int64), pa.int32())], [*names, "ids"]
    return pa.RecordBatch.from_arrays(columns, names)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """For every row: id, n_tokens, digests of the ids and of the decoded text, and with ``keep_ids`` the ids.

    ``path``: the vocabulary file, at the same place on every machine.
    """
    ship(docs.sparkSession)
    file = path or default_vocabulary()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def rows(batches):
        for batch in pieces(batches, "text", 1 << 21):
            yield _coded(batch, file, keep_ids)

    schema = f"id {plain.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return plain.mapInArrow(rows, schema + ", ids array<int>" * keep_ids)

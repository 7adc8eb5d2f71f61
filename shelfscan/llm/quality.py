"""Quality rules by tokeniser fertility.

Public vocabularies are applied to the words of each text: characters per token in every
vocabulary, the share of tokens that fall back to single bytes, and the entropy of the text's
tokens. A text is rejected if a measure lies outside the band of its language, or, where the
language has none, of its main script (by lead bytes of its characters). Bands are parameters.

Words are runs of anything but ASCII white space. Beside the method's measures there are
base counts: characters in words, symbols ``#*$%&|<>``, repeated lines (equal to an
earlier line, with a word), and words in five-word windows that occur twice or more in the text.

* null text: as a text without words; it fails the base rule (fewer than 10 words)
* null or unknown language: the script's band; null id and repeated rows: judged like any other
* empty table: empty result; columns other than id, text and language are ignored

Map-only: one pass over the text, no shuffle. Words are tokenised once for each batch.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.words import RangeHash, Words, byte_table, covered, pieces
from shelfscan.sources.shipping import ship

SYMBOLS = byte_table(b"#*$%&|<>")
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5


@dataclass(frozen=True)
class Band:
    """Accepted ranges: characters per token (piece and rank vocabulary), byte-fallback share, token evenness (entropy by its maximum)."""

    min_chars: float
    min_chars_2: float
    max_chars: float
    max_fallback: float
    min_evenness: float


#: Fixed values. Bands by script, then languages that override their script.
BANDS = {
    "latin": Band(1.5, 1.9, 8.0, 0.05, 0.50),
    "greek": Band(0.7, 0.7, 6.0, 0.40, 0.40),
    "cyrillic": Band(1.2, 1.2, 7.0, 0.10, 0.40),
    "hebrew": Band(0.7, 0.7, 6.0, 0.40, 0.40),
    "arabic": Band(0.7, 0.7, 6.0, 0.40, 0.40),
    "indic": Band(0.3, 0.3, 6.0, 0.95, 0.30),
    "cjk": Band(0.3, 0.3, 4.0, 0.80, 0.30),
    "other": Band(0.2, 0.2, 8.0, 1.00, 0.20),
    "de": Band(1.5, 1.97, 8.0, 0.05, 0.50),
    "en": Band(1.5, 2.05, 8.0, 0.05, 0.50),
    "es": Band(1.5, 2.10, 8.0, 0.05, 0.50),
    "fr": Band(1.5, 1.93, 8.0, 0.05, 0.50),
}
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "cjk", "other")
#: Short texts scatter: lower edges of characters per token give way by this over the root of the token count.
SLACK = 2.5


def _script_of_byte() -> np.ndarray:
    """Script number of the character that a lead byte starts; -1 for bytes that start none or are no letter."""
    table = np.full(256, -1, dtype=np.int8)
    for first, last, script in (
        (65, 90, "latin"), (97, 122, "latin"), (0xC3, 0xCA, "latin"), (0xCD, 0xCF, "greek"), (0xD0, 0xD4, "cyrillic"),
        (0xD6, 0xD7, "hebrew"), (0xD8, 0xDB, "arabic"), (0xE0, 0xE0, "indic"), (0xE3, 0xED, "cjk"),
    ):
        table[first : last + 1] = SCRIPTS.index(script)
    return table


_SCRIPT_OF_BYTE = _script_of_byte()


class PieceVocabulary:
    """Tokens of words in a piece vocabulary with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


class RankVocabulary:
    """Tokens of words in a byte-level vocabulary of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[str]) -> list[list[int]]:
        encode = self.encoding.encode_ordinary
        return [encode(w) for w in words]


_loaded: dict[tuple, object] = {}


def _load(kind, *args):
    if (kind, *args) not in _loaded:
        _loaded[(kind, *args)] = kind(*args)
    return _loaded[(kind, *args)]


@dataclass(frozen=True)
class Vocabularies:
    """Files of the two vocabularies, at the same place on every machine, and the second one's word pattern."""

    pieces: str
    ranks: str
    pattern: str


def public_vocabularies() -> Vocabularies:
    import public_tokenizers

    return Vocabularies(
        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


def _per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[rows[1:]] - sums[rows[:-1]]


def _repeats(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each row in windows that occur twice or more in the row."""
    starts = words.whole(REPEAT_WINDOW)
    runs = RangeHash(hashes)(starts, starts + REPEAT_WINDOW)
    order = np.lexsort((runs, words.row_of[starts] if len(starts) else starts))
    r, h = words.row_of[starts[order]], runs[order]
    same = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = covered(len(words), starts[twice], starts[twice] + REPEAT_WINDOW)
    return _per_row(inside.astype(np.int64), words.rows)


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


class WordTokens:
    """Tokens of the words met so far in both vocabularies, by word hash; starts anew above ``limit`` words."""

    def __init__(self, vocabularies: Vocabularies, limit: int = 400_000):
        self.pieces = PieceVocabulary(vocabularies.pieces)
        self.ranks = RankVocabulary(vocabularies.ranks, vocabularies.pattern)
        self.limit = limit
        self._clear()

    def _clear(self):
        self.keys = np.empty(0, dtype=np.uint64)
        self.start, self.count, self.other, self.fallback = (np.empty(0, dtype=np.int64) for _ in range(4))
        self.flat = np.empty(0, dtype=np.int32)

    def _add(self, keys: np.ndarray, words: list[str]):
        tokens = self.pieces.encode(words)
        count = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        flat = np.fromiter(chain.from_iterable(tokens), dtype=np.int32, count=int(count.sum()))
        start = np.cumsum(count) - count
        fallback = np.add.reduceat(np.append(self.pieces.is_byte[flat], False).astype(np.int64), start) * (count > 0)
        other = np.fromiter(map(len, self.ranks.encode(words)), dtype=np.int64, count=len(words))
        order = np.argsort(np.concatenate([self.keys, keys]))
        joined = lambda old, new: np.concatenate([old, new])[order]
        self.start = joined(self.start, start + len(self.flat))
        self.count, self.other, self.fallback = joined(self.count, count), joined(self.other, other), joined(self.fallback, fallback)
        self.keys, self.flat = joined(self.keys, keys), np.concatenate([self.flat, flat])

    def find(self, keys: np.ndarray, text_of) -> np.ndarray:
        """Places of the sorted distinct keys in the arrays; ``text_of`` gives the words of key numbers."""
        if len(self.keys) + len(keys) > self.limit:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        missing = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(missing):
            self._add(keys[missing], text_of(missing))
        return np.searchsorted(self.keys, keys)


def _fertility(words: Words, hashes: np.ndarray, known: WordTokens):
    """By row: tokens in both vocabularies, fallback tokens, entropy in bits and evenness of the first one's tokens."""
    n_rows = len(words.rows) - 1
    keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    raw = memoryview(words.data)

    def text_of(numbers):
        of = first[numbers]
        return [str(raw[a:b], "utf-8", "replace") for a, b in zip(words.starts[of].tolist(), words.ends[of].tolist(), strict=True)]

    place = known.find(keys, text_of)
    counts, others, fallback = known.count[place], known.other[place], known.fallback[place]
    n_tokens = _per_row(counts[inverse], words.rows)
    sizes = counts[inverse]
    at = np.repeat(known.start[place][inverse] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    key = np.sort((np.repeat(words.row_of, sizes).astype(np.int64) << 32) | known.flat[at])
    edge = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(np.append(edge, len(key))).astype(np.float64)
    sums = np.bincount(key[edge] >> 32, weights=n * np.log2(n), minlength=n_rows)
    total = np.maximum(n_tokens, 1)
    entropy = np.where(n_tokens > 0, np.log2(total) - sums / total, 0.0)
    evenness = np.where(n_tokens > 1, entropy / np.log2(np.clip(total, 2, 1 << 12)), 1.0)
    return n_tokens, _per_row(others[inverse], words.rows), _per_row(fallback[inverse], words.rows), entropy, evenness


def _measured(batch: pa.RecordBatch, vocabularies: Vocabularies, bands: dict[str, Band]) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text"), "")
    words = Words(texts)
    hashes = words.hashes()
    n_words = np.diff(words.rows)
    bytes_in = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    word_chars = _per_row(bytes_in[words.ends] - bytes_in[words.starts], words.rows)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    n_symbols = _per_row(SYMBOLS[words.data].astype(np.int64), bounds)
    raw = words.data.tobytes()
    n_dup_lines = np.array([_repeated_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], dtype=np.int64)
    n_repeat = _repeats(words, hashes)
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    n_tokens, n_other, n_fallback, entropy, evenness = _fertility(words, hashes, _load(WordTokens, vocabularies))
    script_of = _SCRIPT_OF_BYTE[words.data].astype(np.int64)
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    letter = script_of >= 0
    n_scripts = len(SCRIPTS) - 1
    letters = np.bincount(row_of[letter] * n_scripts + script_of[letter], minlength=len(sizes) * n_scripts).reshape(-1, n_scripts).T
    script = np.where(letters.sum(axis=0) > 0, letters.argmax(axis=0), len(SCRIPTS) - 1)
    names = [lang if lang in bands else SCRIPTS[s] for lang, s in zip(batch.column("lang").to_pylist(), script.tolist(), strict=True)]
    low, low_2, high, fall, even = (np.array([getattr(bands[b], f) for b in names], dtype=float) for f in Band.__annotations__)
    per_token = word_chars / np.maximum(n_tokens, 1)
    per_other = word_chars / np.maximum(n_other, 1)
    share = n_fallback / np.maximum(n_tokens, 1)
    slack = SLACK / np.sqrt(np.maximum(n_tokens, 1))
    inside = (per_token >= low - slack) & (per_other >= low_2 - slack) & (per_token <= high) & (per_other <= high) & (share <= fall) & (evenness >= even)
    columns = {
        "id": batch.column("id"), "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "base_failed": base_failed, "kept": ~base_failed & inside, "band": names, "n_tokens": n_tokens,
        "chars_per_token": per_token, "chars_per_token_2": per_other, "fallback_share": share, "token_entropy": entropy,
        "evenness": evenness,
    }
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


_OUT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, band string, "
    "n_tokens long, chars_per_token double, chars_per_token_2 double, fallback_share double, token_entropy double, evenness double"
)


def quality_measures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    vocabularies: Vocabularies | None = None,
    bands: dict[str, Band] = BANDS,
) -> DataFrame:
    """For every row: id, base counts, base_failed, kept, the band applied and the fertility measures."""
    ship(docs.sparkSession)
    files = vocabularies or public_vocabularies()
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))

    def rows(batches):
        for batch in pieces(batches, "text"):
            yield _measured(batch, files, bands)

    return plain.mapInArrow(rows, f"id {plain.schema['id'].dataType.simpleString()}, {_OUT}")


def kept_rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bands: dict[str, Band] = BANDS) -> DataFrame:
    """The rows of docs that the rules keep, all columns kept; no shuffle."""
    ship(docs.sparkSession)
    files = public_vocabularies()

    def rows(batches):
        for batch in pieces(batches, text_col):
            judged = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in (text_col, text_col, lang_col)], ["id", "text", "lang"]
            )
            yield batch.filter(_measured(judged, files, bands).column("kept"))

    return docs.mapInArrow(rows, docs.schema)

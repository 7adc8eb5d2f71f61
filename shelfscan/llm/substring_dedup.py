"""Substring dedup by relative Lempel-Ziv parsing against every block of the corpus.

Each document is cut into reference blocks by content: in every window of ``width``
words the ``seed``-word sequence with the smallest hash is the anchor, and a block is the
stretch of words whose windows share an anchor. Equal passages therefore carry equal
anchors, wherever they stand. The index has every block of every document under its
anchor; a block belongs to the document with the smallest id that holds it.

A document is then factored from left to right: blocks that an earlier document owns
are copied whole and chain into one factor as long as they meet. At a factor's
boundaries, where documents share an anchor but not the block around it, the windows
of the block are looked up one by one. Words of a factor of ``width`` or more words are removed.

Results do not depend on which other rows are duplicated: windows are judged on the input.

* null text or fewer than ``width`` words: nothing is removed; null text has no words
* null id: the row is kept whole and is no reference for others
* rows that share an id are one document: they are no references for each other
* repeats inside one document stay; of equal documents the smallest id stays whole
* other columns of the input are ignored, whatever their names

At scale: what is shuffled first is one pre-aggregated row for each distinct anchor of a
map task, about a fifth of the words; rows whose anchor only one document has are
then held back by a filter of fixed size. No group of rows is gathered; owners are
minima, and the joins on blocks can be split where a block is hot.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.bitmaps import key_filter, passes
from shelfscan.llm.words import RangeHash, Words, covered, pieces
from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

WIDTH = 13
SEED = 5
FILTER_BITS = 1 << 26


class Blocks:
    """Reference blocks of the rows of a text column."""

    def __init__(self, column: pa.Array, width: int, seed: int):
        self.words = Words(column)
        windows = self.words.whole(width)
        self.hash = RangeHash(self.words.hashes())
        n = len(self.words)
        starts = np.arange(max(0, n - seed + 1))
        seeds = self.hash(starts, starts + seed)
        best, anchor = seeds[windows], windows.copy()
        for step in range(1, width - seed + 1):
            other = seeds[windows + step]
            better = other < best
            best[better] = other[better]
            anchor[better] = windows[better] + step
        edge = np.flatnonzero(np.diff(anchor, prepend=-1)) if len(windows) else windows
        self.first = windows[edge]
        self.last = windows[np.append(edge[1:], len(windows)) - 1] if len(windows) else windows
        self.anchor = seeds[anchor[edge]]
        offset = (anchor[edge] - self.first).astype(np.uint64)
        self.block = self.hash(self.first, self.last + width) + offset
        self.row = self.words.row_of[self.first]
        self.width = width

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window starts of the chosen blocks, their hashes, and each window's block."""
        counts = self.last[chosen] - self.first[chosen] + 1
        of = np.repeat(chosen, counts)
        ends = np.cumsum(counts)
        starts = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + self.first[of]
        return starts, self.hash(starts, starts + self.width), of


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _anchors(docs: DataFrame, width: int, seed: int) -> DataFrame:
    def rows(batches):
        for batch in pieces(batches, "text"):
            blocks = Blocks(batch.column("text"), width, seed)
            ids = batch.column("id").take(pa.array(blocks.row))
            yield pa.RecordBatch.from_arrays([_signed(blocks.anchor), _signed(blocks.block), ids], ["anchor", "block", "id"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"anchor long, block long, id {kind}")


def _keys(docs: DataFrame, width: int, seed: int, shared, contested) -> DataFrame:
    """One row for each shared block, or for each window of a contested one."""

    def rows(batches):
        for batch in pieces(batches, "text"):
            blocks = Blocks(batch.column("text"), width, seed)
            open_ = passes(contested.value, blocks.anchor)
            whole = np.flatnonzero(passes(shared.value, blocks.anchor) & ~open_)
            _, hashes, of = blocks.windows(np.flatnonzero(open_))
            of, keys = np.concatenate([whole, of]), np.concatenate([blocks.block[whole], hashes])
            # once for each row: texts that repeat themselves would send the same key again and again
            order = np.lexsort((keys, blocks.row[of]))
            new = np.diff(blocks.row[of][order], prepend=-1) != 0
            new[1:] |= np.diff(keys[order]) != 0
            of, keys = of[order[new]], keys[order[new]]
            ids = batch.column("id").take(pa.array(blocks.row[of]))
            yield pa.RecordBatch.from_arrays([_signed(blocks.anchor[of]), _signed(keys), ids], ["anchor", "key", "id"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"anchor long, key long, id {kind}")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED
) -> DataFrame:
    """Every document with what is left of it: id, n_words, n_removed, n_factors, kept (words joined by one space)."""
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = plain.where("id is not null and text is not null")
    index = (
        _anchors(known, width, seed)
        .groupBy("anchor")
        .agg(F.min("id").alias("a"), F.max("id").alias("z"), F.min("block").alias("b"), F.max("block").alias("y"))
        .where("a < z")
        .select("anchor", (F.col("b") != F.col("y")).alias("contested"))
    )
    index = stage(index, "anchors")
    shared = key_filter(index, "anchor", FILTER_BITS)
    contested = key_filter(index.where("contested"), "anchor", FILTER_BITS)
    keys = _keys(known, width, seed, shared, contested)  # read twice: cheaper to make again than to store
    owners = (
        keys.groupBy("anchor", "key")
        .agg(F.min("id").alias("owner"), F.max("id").alias("z"))
        .where("owner < z")
        .select(F.col("anchor").alias("anchor_"), F.col("key").alias("key_"), "owner")
    )
    owners = stage(owners, "owners")  # so that both sides of the join are plain exchanges, which can be split
    copied = (
        keys.join(owners, (F.col("anchor") == F.col("anchor_")) & (F.col("key") == F.col("key_")) & (F.col("id") > F.col("owner")))
        .groupBy(F.col("id").alias("id_"))
        .agg(F.collect_set("key").alias("copied"))
    )

    def cut(batches):
        for batch in pieces(batches, "text"):
            yield _cut(batch, width, seed, shared.value, contested.value)

    kind = plain.schema["id"].dataType.simpleString()
    return plain.join(copied, F.col("id") == F.col("id_"), "left").drop("id_").mapInArrow(
        cut, f"id {kind}, n_words long, n_removed long, n_factors long, kept string"
    )


def _cut(batch: pa.RecordBatch, width: int, seed: int, shared: np.ndarray, contested: np.ndarray) -> pa.RecordBatch:
    """Factor each document against the blocks it was found to share, and cut the factors out."""
    texts = batch.column("text")
    lists = batch.column("copied")
    touched = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    blocks = Blocks(texts.take(pa.array(touched)), width, seed)
    sizes = np.diff(lists.offsets.to_numpy())[touched] if len(touched) else np.empty(0, dtype=np.int64)
    copied = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    open_ = passes(contested, blocks.anchor)
    whole = np.flatnonzero(passes(shared, blocks.anchor) & ~open_)
    at, hashes, of = blocks.windows(np.flatnonzero(open_))
    begins = np.concatenate([blocks.first[whole], at])
    closes = np.concatenate([blocks.last[whole], at]) + width
    keys = np.concatenate([blocks.block[whole], hashes])
    row = np.concatenate([blocks.row[whole], blocks.row[of]])
    order = np.argsort(row, kind="stable")
    edges = np.searchsorted(row[order], np.arange(len(touched) + 1))
    found = np.zeros(len(keys), dtype=bool)
    for i in range(len(touched)):
        mine = order[edges[i] : edges[i + 1]]
        found[mine] = np.isin(keys[mine], copied[bounds[i] : bounds[i + 1]])
    removed = covered(len(blocks.words), begins[found], closes[found])
    entered = removed.copy()
    entered[1:] &= ~removed[:-1] | (np.diff(blocks.words.row_of) != 0)
    place = {int(r): i for i, r in enumerate(touched)}
    n_words, n_removed, n_factors, kept = [], [], [], []
    for r, text in enumerate(texts):
        parts = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
        n_words.append(len(parts))
        cut = slice(0, 0)
        if r in place:
            cut = slice(*blocks.words.rows[place[r] : place[r] + 2])
            parts = list(compress(parts, (~removed[cut]).tolist()))
        n_removed.append(int(removed[cut].sum()))
        n_factors.append(int(entered[cut].sum()))
        kept.append(b" ".join(parts))
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(n_words), pa.array(n_removed), pa.array(n_factors), pa.array(kept, type=pa.binary()).cast(pa.string())],
        ["id", "n_words", "n_removed", "n_factors", "kept"],
    )


def kept_digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()

"""Benchmark decontamination with a positional inverted index over training tokens.

Tokens are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters, held as
64-bit hashes. A benchmark item is cut into windows of ``width`` consecutive tokens (an item
with fewer, but not none, is one window).

1. Every benchmark token is counted over all documents; a window with a token that
   occurs nowhere is dropped.
2. The terms of each window are ranked from the rarest. The index stores postings
   (term, document, position, the tokens around it) of rarest terms only, and
   of those only the ones that meet the second rarest term at the right distance: the two
   rarest lists are intersected with adjusted offsets before anything is shuffled.
3. Postings join the windows of their term; the other lists are intersected at the same offsets
   by comparing the tokens around the posting one by one.

``phrase_matches`` gives exact phrases. ``proximity_matches`` gives places where all
terms of a window stand within ``width - 1 + slop`` tokens of its rarest term, in any order.

* null text: no tokens, no hits; null or empty item text: no windows
* null item id: its windows mark words, but it is not counted or listed as an item
* items that share an id are one item; repeated windows and rows count once per row
* null document id: the row is marked like any other
* other columns of the input are ignored, whatever their names

At scale: two passes over the text without a shuffle of text. Filters of benchmark terms and of term pairs
have a fixed size (see ``bitmaps``); if a benchmark outgrows them, more postings pass to the
exact join, and none is lost. Token counts are summed before they are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.llm.bitmaps import key_filter, passes
from shelfscan.llm.words import ALPHANUMERIC, Words, list_column, pieces
from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

WIDTH = 10
FILTER_BITS = 1 << 24


def _windows(items: DataFrame, width: int) -> DataFrame:
    """(item, tokens) for each window of each item."""

    def rows(batches):
        for batch in pieces(batches, "text"):
            words = Words(batch.column("text"), ALPHANUMERIC, lower=True)
            hashes, counts = words.hashes(), np.diff(words.rows)
            short = np.flatnonzero((counts > 0) & (counts < width))
            starts = np.concatenate([words.whole(width), words.rows[short]])
            sizes = np.concatenate([np.full(len(starts) - len(short), width), counts[short]]).astype(np.int64)
            inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat = hashes[np.repeat(starts, sizes) + inner].view(np.int64)
            ids = batch.column("item").take(pa.array(words.row_of[starts] if len(words) else starts))
            yield pa.RecordBatch.from_arrays([ids, list_column(flat, sizes, pa.int64())], ["item", "tokens"])

    return items.mapInArrow(rows, f"item {items.schema['item'].dataType.simpleString()}, tokens array<long>")


def _counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(term, n) over all documents, for terms that may be in the vocabulary."""

    def rows(batches):
        for batch in pieces(batches, "text"):
            hashes = Words(batch.column("text"), ALPHANUMERIC, lower=True).hashes()
            terms, n = np.unique(hashes[passes(vocabulary.value, hashes)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "n"])

    return docs.select("text").mapInArrow(rows, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _ranked(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct windows whose tokens all occur, with their two rarest tokens and offsets."""
    tokens = windows.select("tokens").distinct().select("tokens", F.posexplode("tokens").alias("offset", "token"))
    order = F.sort_array(F.collect_list(F.struct("n", "term", "offset")))
    ranked = (
        tokens.join(counts, F.col("token") == F.col("term"))
        .groupBy("tokens")
        .agg(order.alias("ranks"))
        .where(F.size("ranks") == F.size("tokens"))
        .withColumn("first", F.col("ranks")[0])
        .withColumn("second", F.element_at("ranks", F.least(F.size("ranks"), F.lit(2))))
    )
    return ranked.select(
        "tokens",
        F.col("first.term").alias("term_"),
        F.col("first.offset").alias("offset"),
        F.col("second.term").alias("other"),
        (F.col("second.offset") - F.col("first.offset")).alias("apart"),
    )


def _pair(first: Column, second: Column, apart: Column) -> Column:
    turned = F.shiftleft(second, 17).bitwiseOR(F.shiftrightunsigned(second, 47))
    return first.bitwiseXOR(turned).bitwiseXOR(F.shiftleft(apart.cast("long") + 64, 9))


def _pair_of(first: np.ndarray, second: np.ndarray, apart: int) -> np.ndarray:
    turned = (second << np.uint64(17)) | (second >> np.uint64(47))
    return first ^ turned ^ np.uint64((apart + 64) << 9)


def _index(docs: DataFrame, terms, pairs, reach: int) -> DataFrame:
    """One row per document: id, copy (hash of the row), n_words, postings.

    A posting has the term, its position and the ``reach`` tokens on either side (0 beyond
    the document's ends). With ``pairs`` it is stored only where a second term stands right.
    """

    def rows(batches):
        for batch in pieces(batches, "text"):
            words = Words(batch.column("text"), ALPHANUMERIC, lower=True)
            hashes, row_of, n = words.hashes(), words.row_of, len(words)
            at = np.flatnonzero(passes(terms.value, hashes))
            if pairs is not None:
                meets = np.zeros(len(at), dtype=bool)
                for apart in range(-reach, reach + 1):
                    there = np.clip(at + apart, 0, n - 1)
                    inside = (there == at + apart) & (row_of[there] == row_of[at])
                    meets |= inside & passes(pairs.value, _pair_of(hashes[at], hashes[there], apart))
                at = at[meets]
            around = at[:, None] + np.arange(-reach, reach + 1)
            there = np.clip(around, 0, max(0, n - 1))
            near = np.where((there == around) & (row_of[there] == row_of[at][:, None]), hashes[there], np.uint64(0)) if n else there
            sides = list_column(near.reshape(-1).astype(np.uint64).view(np.int64), np.full(len(at), 2 * reach + 1), pa.int64())
            postings = pa.StructArray.from_arrays(
                [pa.array(hashes[at].view(np.int64)), pa.array(at - words.rows[row_of[at]]), sides], ["term", "pos", "around"]
            )
            edges = np.searchsorted(row_of[at], np.arange(batch.num_rows + 1)).astype(np.int32)
            held = pa.ListArray.from_arrays(pa.array(edges), postings)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copy"), pa.array(np.diff(words.rows)), held], ["id", "copy", "n_words", "postings"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    posting = "array<struct<term: long, pos: long, around: array<long>>>"
    return docs.mapInArrow(rows, f"id {kind}, copy long, n_words long, postings {posting}")


def _prepared(docs: DataFrame, items: DataFrame, columns: dict[str, str], width: int):
    ship(docs.sparkSession)
    text = F.col(columns["text"]).cast("string")
    plain = docs.select(F.col(columns["id"]).alias("id"), text.alias("text"))
    plain = plain.withColumn("copy", F.xxhash64("id", "text"))
    tests = items.select(F.col(columns["item"]).alias("item"), F.col(columns["item_text"]).cast("string").alias("text"))
    windows = stage(_windows(tests, width), "windows")
    vocabulary = key_filter(windows.select(F.explode("tokens").alias("token")), "token", FILTER_BITS)
    ranked = stage(_ranked(windows, _counts(plain, vocabulary)), "ranked")
    return plain, windows, ranked, key_filter(ranked, "term_", FILTER_BITS)


COLUMNS = {"id": "doc_id", "text": "text", "item": "item_id", "item_text": "text"}


def _found(index: DataFrame, ranked: DataFrame, condition: Column) -> DataFrame:
    postings = index.select("id", "copy", F.explode("postings").alias("p")).select("id", "copy", "p.*")
    return postings.join(ranked, (F.col("term") == F.col("term_")) & condition)


def _phrases(docs: DataFrame, items: DataFrame, columns: dict[str, str], width: int):
    plain, windows, ranked, terms = _prepared(docs, items, columns, width)
    pairs = key_filter(ranked, _pair(F.col("term_"), F.col("other"), F.col("apart")), FILTER_BITS)
    index = stage(_index(plain, terms, pairs, width - 1), "postings")
    here = F.slice("around", F.lit(width) - F.col("offset"), F.size("tokens"))
    found = _found(index, ranked, here == F.col("tokens"))
    starts = found.select("id", "copy", (F.col("pos") - F.col("offset")).alias("start"), F.size("tokens").alias("length"), "tokens")
    return index, windows, stage(starts, "matches")


def phrase_matches(docs: DataFrame, items: DataFrame, columns: dict[str, str] = COLUMNS, width: int = WIDTH) -> DataFrame:
    """Exact occurrences: id, start (token number from 0), length, item."""
    _, windows, starts = _phrases(docs, items, columns, width)
    owners = windows.distinct().withColumnRenamed("tokens", "tokens_")
    return starts.join(owners, F.col("tokens") == F.col("tokens_")).select("id", "start", "length", "item")


def proximity_matches(
    docs: DataFrame, items: DataFrame, slop: int, columns: dict[str, str] = COLUMNS, width: int = WIDTH
) -> DataFrame:
    """Places where all terms of a window stand near its rarest one: id, position of that term, item."""
    plain, windows, ranked, terms = _prepared(docs, items, columns, width)
    index = _index(plain, terms, None, width - 1 + slop)
    found = _found(index, ranked, F.size(F.array_except("tokens", "around")) == 0).select("id", "pos", "tokens").distinct()
    owners = windows.distinct().withColumnRenamed("tokens", "tokens_")
    return found.join(owners, F.col("tokens") == F.col("tokens_")).select("id", "pos", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, columns: dict[str, str] = COLUMNS, width: int = WIDTH) -> DataFrame:
    """For every document: id, copy, n_words, n_hit (words inside an occurrence), items (sorted ids with occurrences)."""
    index, windows, starts = _phrases(docs, items, columns, width)
    row = Window.partitionBy("id", "copy").orderBy("start", "length")
    end = F.col("start") + F.col("length")
    before = F.coalesce(F.max(end).over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hits = (
        starts.select("id", "copy", "start", "length")
        .distinct()
        .withColumn("new", F.greatest(F.lit(0), end - F.greatest("start", before)))
        .groupBy(F.col("id").alias("id_"), F.col("copy").alias("copy_"))
        .agg(F.sum("new").alias("n_hit"))
    )
    owners = windows.where("item is not null").distinct().withColumnRenamed("tokens", "tokens_")
    listed = (
        starts.select("id", "copy", "tokens")
        .distinct()
        .join(owners, F.col("tokens") == F.col("tokens_"))
        .groupBy(F.col("id").alias("id__"), F.col("copy").alias("copy__"))
        .agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    same = lambda mark: (F.col("copy") == F.col(f"copy{mark}")) & F.col("id").eqNullSafe(F.col(f"id{mark}"))
    return (
        index.select("id", "copy", "n_words")
        .join(hits, same("_"), "left")
        .join(listed, same("__"), "left")
        .select(
            "id",
            "copy",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def clean_rows(docs: DataFrame, items: DataFrame, columns: dict[str, str] = COLUMNS, width: int = WIDTH) -> DataFrame:
    """The rows of docs without a hit word, all columns kept."""
    hit = contamination(docs, items, columns, width).where("n_hit > 0").select("id", F.col("copy").alias("hit_copy__"))
    copy = F.xxhash64(docs[columns["id"]], docs[columns["text"]].cast("string"))
    return docs.join(
        hit.select(F.col("id").alias("hit_id__"), "hit_copy__"),
        (copy == F.col("hit_copy__")) & docs[columns["id"]].eqNullSafe(F.col("hit_id__")),
        "left_anti",
    )

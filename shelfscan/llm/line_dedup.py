"""Line dedup by repeated passages of lines.

Lines are hashed. The unit is a passage of two neighbouring lines that are not blank, with the blank lines between
them; every line starts one, so passages overlap, and a longer repeated passage is the union of its pairs.
A pair that occurs again, in another document or the same, is removed there after its bytes have been compared
with the first occurrence (smallest id, then position); so any repeated passage of two or more lines
goes, whatever stands around it. A line that is alone in being repeated stays, and so does
the first occurrence of every line. A pair that shares a line with its first occurrence stays.

Passages are found from the coarse to the fine. A hash rolling over two full lines cuts the text into chunks where it is
divisible by ``divisor``; ``Outer`` chunks (about 16 lines) hold whole ``Inner`` ones (about 4). Outer chunks are hashed and compared
first; what lies in a repeated one is settled and sent no further. The inner chunks left are next, and last the
pairs: those of chunks without an equal, and those across a cut. All pairs of a repeated chunk are
repeated, so the lines that go are those that pairs alone would find.

``repeated_chunks`` with ``Chunks`` is the coarser form: a rolling hash over the last ``window`` line hashes ends a chunk where
it is divisible by ``divisor``, and chunks of two or more lines are the units. It sends
a row for each chunk and misses most short passages.

* null text: stays null, no lines; empty text: one empty line, nothing to remove
* a pair or chunk with the hash but not the bytes of an earlier one stays
* null id: the row stays whole and is no first occurrence for others
* rows that share an id name one document: equal pairs or chunks at the same place of both stay
* a text of which everything is removed becomes empty; the row stays
* empty table: empty result; other columns are kept, whatever their names

At scale: hashes are shuffled first, one row per chunk or open pair; bodies only of chunks and pairs that pass a
filter of fixed size holding the repeated hashes; whole texts once, to meet their removal lists. No group
is gathered; joins on hot pairs can be split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.bitmaps import key_filter, passes
from shelfscan.llm.words import NOT_SPACE, Lines, RangeHash, covered, list_column, pieces
from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

WINDOW = 2
DIVISOR = 4
#: A multiple of DIVISOR, so that outer cuts are inner ones too.
OUTER_DIVISOR = 16
FILTER_BITS = 1 << 26


class Chunks:
    """Chunks of the rows of a text column: line ranges, row, number in the row, hash."""

    #: Units whose numbers differ by less share lines.
    reach = 1

    def __init__(self, column: pa.Array, window: int = WINDOW, divisor: int = DIVISOR):
        self.lines = lines = Lines(column)
        n = len(lines)
        hashes = RangeHash(lines.hashes())
        numbers = np.arange(n)
        rolling = hashes(np.maximum(numbers - window + 1, lines.rows[lines.row_of]), numbers + 1)
        last = rolling % np.uint64(divisor) == 0
        last[lines.rows[1:] - 1] = True
        self.last = np.flatnonzero(last)
        self.first = np.append(0, self.last[:-1] + 1) if len(self.last) else self.last
        self.row = lines.row_of[self.first]
        self.number = np.arange(len(self.first)) - np.searchsorted(self.row, self.row)
        self.hash = hashes(self.first, self.last + 1)
        self.several = self.last > self.first

    def body(self, chunk: int) -> bytes:
        return self.lines.data[self.lines.starts[self.first[chunk]] : self.lines.ends[self.last[chunk]]].tobytes()


class Pairs(Chunks):
    """Every two neighbouring lines that are not blank, with the blank ones between them."""

    reach = 2

    def __init__(self, column: pa.Array):
        self.lines = lines = Lines(column)
        marks = np.append(0, np.cumsum(NOT_SPACE[lines.data]))
        full = np.flatnonzero(marks[lines.ends] > marks[lines.starts])
        row = lines.row_of[full]
        at = np.flatnonzero(row[1:] == row[:-1])
        self.first, self.last, self.row = full[at], full[at + 1], row[at]
        self.number = np.arange(len(at)) - np.searchsorted(self.row, self.row)
        self.range_hash = RangeHash(lines.hashes())
        self.hash = self.range_hash(self.first, self.last + 1)
        self.several = np.ones(len(at), dtype=bool)

    def across(self, divisor: int) -> np.ndarray:
        """Which pairs lie across a cut: the hash of the two lines before it, the pair ahead, is divisible."""
        out = np.zeros(len(self.row), dtype=bool)
        out[1:] = (self.hash[:-1] % np.uint64(divisor) == 0) & (self.row[1:] == self.row[:-1])
        return out

    def parts(self, divisor: int) -> np.ndarray:
        """Number of the part each pair is in: the pairs of a chunk, or one pair across a cut."""
        across = self.across(divisor)
        new = across.copy()
        new[1:] |= across[:-1] | (self.row[1:] != self.row[:-1])
        return np.cumsum(new)

    def take(self, starts: np.ndarray, ends: np.ndarray) -> None:
        """Become the passages from pair to pair; a passage has the number of its first pair."""
        self.first, self.last, self.row, self.number = self.first[starts], self.last[ends], self.row[starts], self.number[starts]
        self.hash = self.range_hash(self.first, self.last + 1)


def _edges(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of equal numbers."""
    new = np.flatnonzero(np.diff(parts)) + 1
    starts = np.concatenate([[0], new]).astype(np.int64)[: len(parts)]
    return starts, np.append(starts[1:] - 1, len(parts) - 1)[: len(starts)]


class Inner(Pairs):
    """Content-defined chunks of three or more full lines."""

    def __init__(self, column: pa.Array, pairs: Pairs | None = None):
        vars(self).update(vars(pairs or Pairs(column)))
        starts, ends = _edges(self.parts(DIVISOR))
        self.take(starts, ends)
        self.several = ends > starts


class Outer(Pairs):
    """Content-defined chunks that hold more than one part of the inner cuts."""

    def __init__(self, column: pa.Array, pairs: Pairs | None = None):
        vars(self).update(vars(pairs or Pairs(column)))
        inner = self.parts(DIVISOR)
        starts, ends = _edges(self.parts(OUTER_DIVISOR))
        self.take(starts, ends)
        self.several = inner[ends] > inner[starts]


class Passages(Pairs):
    """Outer and inner chunks and pairs together."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        levels = [self, Inner(column, self), Outer(column, self)]
        order = np.argsort(np.concatenate([u.row for u in levels]), kind="stable")
        for name in ("first", "last", "row", "number", "hash", "several"):
            setattr(self, name, np.concatenate([getattr(u, name) for u in levels])[order])


def _parts(docs: DataFrame) -> DataFrame:
    """A row per inner chunk or pair across its cuts: place and hash, those of the outer chunk around it, hashes of its pairs."""

    def rows(batches):
        for batch in pieces(batches, "text"):
            column = batch.column("text")
            pairs = Pairs(column)
            inner, outer = Inner(column, pairs), Outer(column, pairs)
            starts, ends = _edges(pairs.parts(DIVISOR))
            around = pairs.parts(OUTER_DIVISOR)[starts]
            none = ~outer.several[around]
            columns = [
                batch.column("id").take(pa.array(inner.row)),
                pa.array(inner.number),
                pa.array(inner.hash.view(np.int64)),
                pa.array(outer.number[around], mask=none),
                pa.array(outer.hash[around].view(np.int64), mask=none),
                list_column(pairs.hash.view(np.int64), ends - starts + 1, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "number", "hash", "outer_number", "outer_hash", "pairs"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"id {kind}, number long, hash long, outer_number long, outer_hash long, pairs array<long>")


def _hashes(docs: DataFrame, units: type[Chunks]) -> DataFrame:
    def rows(batches):
        for batch in pieces(batches, "text"):
            chunks = units(batch.column("text"))
            at = np.flatnonzero(chunks.several)
            ids = batch.column("id").take(pa.array(chunks.row[at]))
            columns = [pa.array(chunks.hash[at].view(np.int64)), ids, pa.array(chunks.number[at])]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "id", "number"])

    return docs.mapInArrow(rows, f"hash long, id {docs.schema['id'].dataType.simpleString()}, number long")


def _bodies(docs: DataFrame, repeated, units: type[Chunks]) -> DataFrame:
    def rows(batches):
        for batch in pieces(batches, "text", 1 << 21):
            chunks = units(batch.column("text"))
            at = np.flatnonzero(chunks.several & passes(repeated.value, chunks.hash))
            ids = batch.column("id").take(pa.array(chunks.row[at]))
            body = pa.array([chunks.body(i) for i in at.tolist()], type=pa.binary())
            columns = [pa.array(chunks.hash[at].view(np.int64)), ids, pa.array(chunks.number[at]), body]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "id", "number", "body"])

    return docs.mapInArrow(rows, f"hash long, id {docs.schema['id'].dataType.simpleString()}, number long, body binary")


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: type[Chunks] = Chunks) -> DataFrame:
    """(id, hash, number) of every unit that equals an earlier one byte by byte."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    return _repeated(plain, _hashes(plain, units), units)


def _repeated(plain: DataFrame, places: DataFrame, units: type[Chunks]) -> DataFrame:
    """(id, hash, number) of the units that equal the first of the places with their hash byte by byte, and are not it."""
    first = F.min(F.struct("id", "number")).alias("first")
    owners = places.groupBy("hash").agg(first, F.max(F.struct("id", "number")).alias("latest")).where("first != latest")
    owners = stage(owners.select(F.col("hash").alias("hash_"), "first"), "owners")
    bodies = stage(_bodies(plain, key_filter(owners, "hash_", FILTER_BITS), units), "bodies")
    here = F.struct("id", "number")
    own = bodies.join(owners, (F.col("hash") == F.col("hash_")) & (here == F.col("first")))
    own = own.groupBy(F.col("hash").alias("hash_")).agg(F.min("body").alias("body_"), F.first("first").alias("first"))
    own = stage(own, "own")
    same = (F.col("hash") == F.col("hash_")) & (F.col("body") == F.col("body_")) & (here != F.col("first"))
    apart = (F.col("id") != F.col("first.id")) | (F.col("number") - F.col("first.number") >= units.reach)
    return bodies.join(own, same & apart).select("id", "hash", "number")


def settle_chunks(plain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, hash, number) of repeated chunks, outer ones first, and the same of the pairs that lie in none of them."""
    parts = stage(_parts(plain), "parts")
    held = parts.where("outer_hash is not null").select("id", F.col("outer_hash").alias("hash"), F.col("outer_number").alias("number"))
    outer = stage(_repeated(plain, held, Outer), "outer")
    around = outer.withColumnsRenamed({"hash": "outer_hash", "number": "outer_number"})
    left = stage(parts.join(around, ["id", "outer_number", "outer_hash"], "left_anti"), "left-parts")
    inner = stage(_repeated(plain, left.where("size(pairs) > 1"), Inner), "inner")
    pairs = left.join(inner, ["id", "number", "hash"], "left_anti").select("id", "number", F.posexplode("pairs").alias("at", "hash"))
    return outer.unionByName(inner), pairs.select("id", "hash", (F.col("number") + F.col("at")).alias("number"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, number) of outer and inner chunks and of pairs that, together, are all repeated passages."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    chunks, pairs = settle_chunks(plain)
    return chunks.unionByName(_repeated(plain, pairs, Pairs))


def _without(batch: pa.RecordBatch, units: type[Chunks]) -> pa.RecordBatch:
    """id, text without the lines of the listed units, line counts; a unit is listed by number and hash."""
    found = units(batch.column("text"))
    lines = found.lines
    data = memoryview(lines.data)
    kept, n_lines, n_removed = [], [], []
    bounds = np.searchsorted(found.row, np.arange(batch.num_rows + 1))
    for r, (text, listed) in enumerate(zip(batch.column("text"), batch.column("gone").to_pylist(), strict=True)):
        first, end = int(lines.rows[r]), int(lines.rows[r + 1])
        if not text.is_valid or not listed:
            kept.append(text.as_py())
            n_lines.append(end - first if text.is_valid else 0)
            n_removed.append(0)
            continue
        gone = {(g["number"], g["hash"]) for g in listed}
        at = range(int(bounds[r]), int(bounds[r + 1]))
        at = [u for u in at if found.several[u] and (int(found.number[u]), int(found.hash[u].astype(np.int64))) in gone]
        left = ~covered(end - first, found.first[at] - first, found.last[at] + 1 - first)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], left, [False]]).astype(np.int8))).tolist()
        parts = [bytes(data[lines.starts[first + a] : lines.ends[first + b - 1]]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        kept.append(b"\n".join(parts).decode())
        n_lines.append(end - first)
        n_removed.append(end - first - int(left.sum()))
    columns = [pa.array(kept, type=pa.string()), pa.array(n_lines, type=pa.int64()), pa.array(n_removed, type=pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["text", "n_lines", "n_removed"])


def _listed(docs: DataFrame, id_col: str, text_col: str, units: type[Chunks]) -> DataFrame:
    """docs with the removal list of each row in a column of its own."""
    found = repeated_passages(docs, id_col, text_col) if units is Passages else repeated_chunks(docs, id_col, text_col, units)
    gone = found.groupBy(F.col("id").alias("id__gone")).agg(F.collect_set(F.struct("number", "hash")).alias("list__gone"))
    return docs.join(gone, docs[id_col] == F.col("id__gone"), "left").drop("id__gone")


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: id, text without its repeated passages, n_lines, n_removed."""
    return remove_repeated_chunks(docs, id_col, text_col, Passages)


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: type[Chunks] = Chunks) -> DataFrame:
    """For every row: id, text (what is left), n_lines, n_removed."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def rows(batches):
        for batch in pieces(batches, "text"):
            batch = batch.rename_columns(["id", "text", "gone"])
            left = _without(batch, units)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *left.columns], ["id", *left.schema.names])

    schema = f"id {plain.schema['id'].dataType.simpleString()}, text string, n_lines long, n_removed long"
    return _listed(plain, "id", "text", units).mapInArrow(rows, schema)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The rows of docs with what is left of their texts; ``size_col``, if there is one, follows the new length."""
    names = docs.columns

    def rows(batches):
        for batch in pieces(batches, text_col):
            work = pa.RecordBatch.from_arrays([batch.column(text_col), batch.column("list__gone")], ["text", "gone"])
            left = _without(work, Passages).column("text")
            yield pa.RecordBatch.from_arrays([left if c == text_col else batch.column(c) for c in names], names)

    out = _listed(docs, id_col, text_col, Passages).mapInArrow(rows, docs.schema)
    if size_col in names:
        out = out.withColumn(size_col, F.char_length(text_col).cast(docs.schema[size_col].dataType))
    return out

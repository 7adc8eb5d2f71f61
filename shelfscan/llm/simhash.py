"""SimHash near-dedup with a Gray-order hierarchical index over fingerprints.

Fingerprint: A-Z lower-cased, words split at ASCII white space, shingles of three words
(repeats included; shorter texts give one shingle, none gives fingerprint zero). A bit
is set if more than half of the shingles' XXH64 values (seed 42) have it.

Search: distinct fingerprints are dealt to groups by a band of bits that near
fingerprints must share (pigeonhole: with ``radius`` + 1 bands at least one is equal).
A group larger than ``group_limit`` is dealt again by the bands of its remaining bits, so
that no group has to be large for the sake of one hot pattern. In a group, fingerprints are
sorted by Gray rank; runs of neighbours form nodes, whose shared masked bit
pattern moves to the upper node, level by level. Two nodes are compared on the bits
both fix; what they differ in accumulates on the way down, and a pair of nodes whose sum
exceeds the radius is dropped with everything below it. So is a pair that lies in one
component already, as components are what is wanted. Only a spanning forest of links leaves a group.

* null text and texts without a word: fingerprint zero, linked like any other
* null id: keeps its fingerprint; its component is the smallest non-null id, null if there is none
* repeated rows share a fingerprint, and so a component
* empty table: empty result; other columns are ignored
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.components import components
from shelfscan.llm.words import pieces
from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

BITS = 64
RADIUS = 3
SHINGLE = 3
FANOUT = 8
GROUP_LIMIT = 4096
_PAIRS = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], 42) for a, b in zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)],
        dtype="<u8",
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, copy (hash of the text) and signed 64-bit fingerprint of every row."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    plain = plain.withColumn("copy", F.xxhash64("text"))

    def rows(batches):
        for batch in pieces(batches, "text"):
            texts = batch.column("text")
            prints = np.array([fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in texts], dtype=np.uint64)
            columns = [batch.column("id"), batch.column("copy"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "copy", "print"])

    return plain.mapInArrow(rows, f"id {plain.schema['id'].dataType.simpleString()}, copy long, print long")


def _gray_rank(values: np.ndarray) -> np.ndarray:
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchies over the fingerprints of several groups, one root per group, with a self-join by components.

    ``values`` are distinct within a group; ``groups`` numbers their groups in ascending order.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray, radius: int = RADIUS, fanout: int = FANOUT):
        order = np.lexsort((_gray_rank(values), groups))
        self.leaves, self.groups, self.radius = values[order], groups[order], radius
        fixed, shared = np.full(len(values), ~np.uint64(0)), self.leaves
        starts = np.flatnonzero(np.diff(self.groups, prepend=-1))
        sizes = np.diff(np.append(starts, len(values)))
        #: from the leaves up: shared bit patterns, their masks, and the first child and number of children
        self.levels = [(shared, fixed, None, None)]
        while sizes.max(initial=1) > 1:
            nodes = -(-sizes // fanout)
            inner = np.arange(nodes.sum()) - np.repeat(np.cumsum(nodes) - nodes, nodes)
            first = np.repeat(starts, nodes) + inner * fanout
            count = np.minimum(np.repeat(starts + sizes, nodes) - first, fanout)
            agree = np.bitwise_and.reduceat(fixed & ~(shared ^ np.repeat(shared[first], count)), first)
            shared, fixed = shared[first] & agree, agree
            self.levels.append((shared, fixed, first, count))
            starts, sizes = np.cumsum(nodes) - nodes, nodes
        self.parent = np.arange(len(values))

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def _join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self._root(i), self._root(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                out.append((i, j))
        return out

    def _labels(self) -> list[np.ndarray]:
        """By level, the component of a node whose leaves are all in one, else a negative number of its own."""
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        labels = [self.parent]
        for _, _, first, _ in self.levels[1:]:
            low, high = np.minimum.reduceat(labels[-1], first), np.maximum.reduceat(labels[-1], first)
            labels.append(np.where((low == high) & (low >= 0), low, -1 - np.arange(len(first))))
        return labels

    def links(self) -> list[tuple[int, int]]:
        """Pairs of leaf numbers within the radius that span every component of every group."""
        close = np.bitwise_count(self.leaves[1:] ^ self.leaves[:-1]) <= self.radius
        near = np.flatnonzero(close & (self.groups[1:] == self.groups[:-1]))
        out = self._join(near, near + 1)
        labels, found = self._labels(), 0
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        stack = [(top, roots, roots, np.zeros(len(roots), dtype=np.int64), np.zeros(len(roots), dtype=np.uint64))] if top else []
        while stack:
            level, a, b, differ, seen = stack.pop()
            if found:
                labels, found = self._labels(), 0
            apart = (labels[level][a] != labels[level][b]) | (labels[level][a] < 0)
            a, b, differ, seen = a[apart], b[apart], differ[apart], seen[apart]
            if not level:
                new = self._join(a, b)
                found, out = len(new), out + new
                continue
            _, _, first, count = self.levels[level]
            pairs = count[a] * count[b]
            if pairs.sum() > _PAIRS and len(a) > 1:
                half = len(a) // 2
                stack += [(level, *(x[half:] for x in (a, b, differ, seen))), (level, *(x[:half] for x in (a, b, differ, seen)))]
                continue
            of = np.repeat(np.arange(len(a)), pairs)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            x = first[a[of]] + inner // count[b[of]]
            y = first[b[of]] + inner % count[b[of]]
            shared, fixed, _, _ = self.levels[level - 1]
            both = fixed[x] & fixed[y]
            total = differ[of] + np.bitwise_count((shared[x] ^ shared[y]) & both & ~seen[of])
            stay = (total <= self.radius) & ((x <= y) if level > 1 else (x < y))
            stack.append((level - 1, x[stay], y[stay], total[stay], both[stay]))
        return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _refined(mask: int, radius: int) -> list[int]:
    """The mask with one of radius + 1 bands of its free bits added, for each band."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _links_in(batches, radius: int):
    """Links of the groups in rows sorted by (mask, value); groups are small, so whole ones are held."""

    def linked(table: pa.Table):
        print_ = table.column("print").to_numpy().view(np.uint64)
        mask, value = table.column("mask").to_numpy(), table.column("value").to_numpy()
        new = np.append(True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) if len(mask) else np.empty(0, dtype=bool)
        index = GrayIndex(print_, np.cumsum(new), radius)
        pairs = np.array(index.links(), dtype=np.int64).reshape(-1, 2)
        ends = [pa.array(index.leaves[pairs[:, i]].view(np.int64)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    held = None
    for batch in batches:
        held = pa.concat_tables([held, pa.table(batch)]) if held is not None else pa.table(batch)
        mask, value = held.column("mask").to_numpy(), held.column("value").to_numpy()
        edges = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
        if len(edges):
            yield linked(held.slice(0, int(edges[-1]) + 1))
            held = held.slice(int(edges[-1]) + 1).combine_chunks()
    if held is not None and held.num_rows:
        yield linked(held)


def near_links(prints: DataFrame, radius: int = RADIUS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column print) that span every component.

    A group holds the fingerprints that agree on a mask of bits. The first masks are the
    bands themselves; members of a group above ``group_limit`` are dealt again, each of its
    masks refined by the bands of the bits still free, until groups are small or fewer
    free bits are left than 20 (a group then has at most 2**20 different members).
    """
    spark = prints.sparkSession
    ship(spark)
    level = _refined(0, radius)
    dealt = prints.select("print").distinct().withColumn("mask", F.explode(F.array(*(F.lit(_signed(m)) for m in level))))
    out = None
    while True:
        dealt = stage(dealt.withColumn("value", F.col("print").bitwiseAND(F.col("mask"))), "dealt")
        sizes = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = sizes.select(F.col("mask").alias("mask_"), F.col("value").alias("value_"), "n")
        sized = dealt.join(sizes, (F.col("mask") == F.col("mask_")) & (F.col("value") == F.col("value_")))
        last = min(BITS - m.bit_count() for m in level) < 20 or sizes.where(F.col("n") > group_limit).isEmpty()
        small = (sized if last else sized.where(F.col("n") <= group_limit)).select("print", "mask", "value")
        found = (
            small.repartition("mask", "value")
            .sortWithinPartitions("mask", "value")
            .mapInArrow(lambda batches: _links_in(batches, radius), "a long, b long")
        )
        out = found if out is None else out.unionByName(found)
        if last:
            return out
        finer = {_signed(m): [F.lit(_signed(f)) for f in _refined(m, radius)] for m in level}
        choice = F.create_map(*(x for m, fs in finer.items() for x in (F.lit(m), F.array(*fs))))
        level = [f for m in level for f in _refined(m, radius)]
        dealt = sized.where(F.col("n") > group_limit).select("print", F.explode(choice[F.col("mask")]).alias("mask"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """id, copy (hash of the text), print (signed 64-bit fingerprint), component (smallest id reachable by links) of every row."""
    prints = stage(fingerprints(docs, id_col, text_col), "prints")
    roots = components(near_links(prints, radius))
    classes = prints.groupBy("print").agg(F.min("id").alias("low"))
    rooted = classes.join(roots, F.col("print") == F.col("node"), "left")
    rooted = stage(rooted.select("print", "low", F.coalesce("root", "print").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component")).select(F.col("root").alias("root_"), "component")
    labels = rooted.join(lowest, F.col("root") == F.col("root_")).select(F.col("print").alias("print_"), "component")
    return prints.join(labels, F.col("print") == F.col("print_")).select("id", "copy", "print", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of docs that stay: of each component the row with the smallest id, all columns kept.

    Rows with a null id stay; repeated rows of the smallest id all stay.
    """
    marked = near_duplicates(docs, id_col, text_col, radius)
    gone = marked.where("id != component").select(F.col("id").alias("id__gone"), F.col("copy").alias("copy__gone")).distinct()
    copy = F.xxhash64(docs[text_col].cast("string"))
    return docs.join(gone, (docs[id_col] == F.col("id__gone")) & (copy == F.col("copy__gone")), "left_anti")

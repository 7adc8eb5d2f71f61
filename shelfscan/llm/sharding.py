"""Byte-balanced sharding of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together. A partial partition is a tuple of
``shards`` byte sums. Differencing takes the two tuples with the largest spread (largest minus smallest sum), adds
the largest sums of one to the smallest of the other, subtracts what all sums have in
common, and goes on until one tuple is left; its spread is the imbalance.

On a cluster, groups larger than 1 / (``LARGE`` * shards) of all bytes, of which there can be no more than
``LARGE`` * shards, are differenced first. Shards that they fill beyond an equal share of what is left are closed. All other
groups are dealt to blocks of about ``block`` groups, and each block is differenced to one tuple over the open shards.
A part of the blocks levels the open shards: each of them starts with its share of the large groups' tuple as
one more tuple, so it fills what they left open. The tuples of all other blocks are then differenced with each other,
``FAN`` at a time in rounds, the last round with the levelled tuple; where its sums end up names the shards. So what one block has too much
of meets what another has too little of, and the spread does not grow with the number of blocks.

* null text: no bytes, one group; its CRC is that of no bytes (0); empty text: another group of the same size
* repeated rows are rows of one group; null ids are placed like others
* fewer groups than shards: the rest stays empty; empty table: empty result
* a group larger than a shard's share stays whole; the other shards are balanced around it
* ties are broken by the text's digest; slots follow id, then CRC; other columns are ignored

At scale: what is shuffled is id, size and digest, never a text. Group sizes are sums combined
before the shuffle. Slots are numbered in small blocks of rows, offset by the counts of the blocks before.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

SHARDS = 40
OVERHEAD = 16
BLOCK = 1 << 14
LARGE = 16
SLOT_ROWS = 1 << 16
FAN = 256


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combined sums of the tuples (rows of ``sums``), and for each tuple the place each of its sums went to.

    The combined sums are not reduced by what they have in common.
    """
    n, k = sums.shape
    places = [np.argsort(row, kind="stable") for row in -sums]  # place of each sum, largest first
    held = np.take_along_axis(sums, np.array(places).reshape(n, k), axis=1)
    low = held[:, -1].copy()
    nodes: list[np.ndarray] = list(held - low[:, None])
    parts: list[tuple[int, int, np.ndarray, np.ndarray] | None] = [None] * n
    heap = [(-int(node[0]), i) for i, node in enumerate(nodes)]
    heapq.heapify(heap)
    base = int(low.sum())
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = nodes[a] + nodes[b][::-1]
        order = np.argsort(-joined, kind="stable")
        joined = joined[order]
        base += int(joined[-1])
        nodes[a] = nodes[b] = None
        went = np.empty(k, dtype=np.int64)
        went[order] = np.arange(k)
        parts.append((a, b, went, went[::-1]))
        nodes.append(joined - joined[-1])
        heapq.heappush(heap, (-int(nodes[-1][0]), len(nodes) - 1))
    top = heap[0][1]
    final: list[np.ndarray | None] = [None] * len(nodes)
    final[top] = np.arange(k)
    for i in range(len(nodes) - 1, n - 1, -1):
        a, b, of_a, of_b = parts[i]
        final[a], final[b] = final[i][of_a], final[i][of_b]
    where = np.empty((n, k), dtype=np.int64)
    for i in range(n):
        where[i, places[i]] = final[i]
    return nodes[top] + base, where


def _closed(base: np.ndarray, total: int) -> int:
    """How many shards, from the first (``base`` falls), hold more than an equal share of what the ones before leave."""
    closed, left = 0, total
    while closed < len(base) - 1 and int(base[closed]) * (len(base) - closed) > left:
        left -= int(base[closed])
        closed += 1
    return closed


def _named(sums: np.ndarray) -> np.ndarray:
    """Places of the sums of all tuples after differencing; a place is named by the sum of the first tuple that went there."""
    _, where = difference(sums)
    name = np.empty(sums.shape[1], dtype=np.int32)
    name[where[0]] = np.arange(sums.shape[1])
    return name[where]


def _difference_nodes(nodes: DataFrame, levelled: DataFrame, count: int, shards: int, fan: int) -> DataFrame:
    """(node, place, shard) for tuples in rows (node, place, size), numbered from 0 to below ``count``, by rounds of differencing."""

    def run(table: pa.Table) -> pa.Table:
        nodes, row = np.unique(table.column("node").to_numpy(), return_inverse=True)
        sums = np.zeros((len(nodes), shards), dtype=np.int64)
        sums[row, table.column("place").to_numpy()] = table.column("size").to_numpy()
        place = np.tile(np.arange(shards, dtype=np.int32), len(nodes))
        parent = np.full(len(place), table.column("parent")[0].as_py(), dtype=np.int64)
        return pa.table({"parent": parent, "node": np.repeat(nodes, shards), "place": place, "went": _named(sums).ravel(), "size": sums.ravel()})

    rounds = []
    while True:
        last = count <= fan
        nodes = nodes.withColumn("parent", F.floor(F.col("node") / fan).cast("long"))
        if last:
            # number -1: the first tuple of the last round
            nodes = nodes.unionByName(levelled.select(F.lit(-1).cast("long").alias("node"), "place", "size", F.lit(0).cast("long").alias("parent")))
        rounds.append(stage(nodes.groupBy("parent").applyInArrow(run, "parent long, node long, place int, went int, size long"), "round"))
        if last:
            break
        nodes = rounds[-1].groupBy(F.col("parent").alias("node"), F.col("went").alias("place")).agg(F.sum("size").alias("size"))
        count = -(-count // fan)
    names = rounds[-1].select("node", "place", F.col("went").alias("shard"))
    for earlier in reversed(rounds[:-1]):
        above = names.select(F.col("node").alias("parent"), F.col("place").alias("went"), "shard")
        names = earlier.join(above, ["parent", "went"]).select("node", "place", "shard")
    return names


def shard_groups(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(key, shard) for groups (key string, size long, not below 1)."""
    spark = groups.sparkSession
    ship(spark)
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    is_large = F.col("size") * LARGE * shards > int(total)
    large = groups.where(is_large).select("key", "size").orderBy(F.col("size").desc(), "key").collect()  # fewer than LARGE * shards
    sums = np.zeros((len(large) + 1, shards), dtype=np.int64)
    sums[1:, 0] = [r["size"] for r in large]
    base, where = difference(sums)
    fixed = spark.createDataFrame([(r["key"], int(w[0])) for r, w in zip(large, where[1:], strict=True)], "key string, shard int")
    blocks = max(1, -(-(n - len(large)) // block))
    closed = _closed(base, int(total))
    left = base[closed:]
    missing = int((left.max() - left).sum())
    # twice the bytes that are missing, so that every levelling block can even out its share
    levelling = min(blocks, -(-2 * missing * blocks // max(1, int(total) - int(base.sum()))))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        sums = np.zeros((table.num_rows + 1, shards - closed), dtype=np.int64)
        if table.column("node")[0].as_py() < 0:
            sums[0] = left // levelling
        sums[1:, 0] = table.column("size").to_numpy()
        return table.append_column("place", pa.array(_named(sums)[1:, 0]))

    # levelling blocks have numbers below 0
    node = F.pmod(F.xxhash64("key"), F.lit(blocks)) - levelling
    dealt = groups.where(~is_large).select("key", "size", node.cast("long").alias("node"))
    placed = stage(dealt.groupBy("node").applyInArrow(run, "key string, size long, node long, place int"), "blocks")
    levelled = placed.where("node < 0")
    shard = (F.col("place") + closed).cast("int").alias("shard")
    done = fixed.unionByName(levelled.select("key", shard))
    if levelling == blocks:
        return done
    start = spark.createDataFrame([(s, int(size)) for s, size in enumerate(left)], "place int, size long")
    level = start.unionByName(levelled.select("place", "size")).groupBy("place").agg(F.sum("size").alias("size"))
    tuples = placed.where("node >= 0").groupBy("node", "place").agg(F.sum("size").alias("size"))
    names = _difference_nodes(tuples, level, blocks - levelling, shards - closed, fan)
    free = placed.where("node >= 0").join(names, ["node", "place"])
    return done.unionByName(free.select("key", (F.col("shard") + closed).cast("int").alias("shard")))


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, block: int = BLOCK, fan: int = FAN
) -> DataFrame:
    """Every row's id, size, text_crc32, group (digest of the text), shard and slot in the shard."""
    text = F.col(text_col).cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")
    crc = F.coalesce(F.crc32(F.encode(text, "utf-8")), F.lit(0)).cast("long")
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"), size.alias("size"), crc.alias("text_crc32"), F.coalesce(F.sha2(text, 256), F.lit("null")).alias("group")
        ),
        "sizes",
    )
    groups = rows.groupBy(F.col("group").alias("key")).agg(F.sum("size").alias("size"))
    placed = shard_groups(groups, shards, block, fan)
    return with_slots(rows.join(placed, F.col("group") == F.col("key")).drop("key"))


def with_slots(rows: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Number the rows of each shard without gaps from 0, block by block."""
    blocks = max(1, -(-rows.count() // slot_rows))
    part = F.pmod(F.xxhash64("id", "group"), F.lit(blocks))
    rows = stage(rows.withColumn("part", part), "placed")
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("shard").alias("shard_"), F.col("part").alias("part_"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "part").orderBy(F.col("id"), "text_crc32", "group")
    numbered = rows.withColumn("inside", F.row_number().over(inside))
    return numbered.join(starts, (F.col("shard") == F.col("shard_")) & (F.col("part") == F.col("part_"))).select(
        "id", "size", "text_crc32", "group", "shard", (F.col("start") + F.col("inside") - 1).cast("long").alias("slot")
    )

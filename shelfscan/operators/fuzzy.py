"""Fuzzy links between the names that the key tiers left unmatched.

Definition: for every pair of stores, in store order, each name of the first store (most listings first) takes the
most similar name of the second store that is still free, if their token-sort similarity reaches the cutoff (ties: the name with more listings).

How it runs:

* A name's best partners are searched, not scored pair by pair. Names are put into blocks by a signature of their characters, so
  that a block holds similar names. A block of one store meets the blocks of the other, nearest signatures first. What two names can share at most
  follows from their character counts, then from their neighbouring characters; only where that exceeds a name's worst kept partner is the
  similarity computed. Nothing is lost: the bounds are never below the similarity.
* Names ask in turns of bounded size, in order. What a turn has taken is free for no later turn, so a search only meets what is left.
* Within a turn, each name in order takes the best of its list that no earlier one of the turn has. A name whose list ends searches
  again, among what no earlier name holds, and the turn is settled again with its new list, until no list has ended: the stable
  matching in which every name of the second store prefers the earliest who asks.
* Pairs of stores whose positions have the same sum share no store and run together.
* Names a pair has linked are free for no later pair, on either side.

Block pairs grow with the square of the number of blocks; each block is sent to a task once per block it meets.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfscan.functions.fixed_values import FUZZY_CUTOFF
from shelfscan.functions.similarity import CharacterBags, common_lengths, sorted_tokens
from shelfscan.operators.stats import ranked_values
from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage, stage_root

#: Partners kept for a name, names of a block that is sent, of a block that meets them, and of a turn of one pair of stores.
LIST, BLOCK, ASKING, TURN = 32, 512, 2048, 8192
#: Blocks of a turn: as many tasks search for it.
_SEARCHES = 16
_FREE = (1 << 63) - 1
_LISTS = "pair INT, block BIGINT, a BIGINT, bs ARRAY<BIGINT>, scores ARRAY<DOUBLE>, more BOOLEAN"
_PICKS = "pair INT, a BIGINT, b BIGINT, score DOUBLE, open BOOLEAN"
_LINKS = "pair INT, a BIGINT, b BIGINT, score DOUBLE"


def unmatched_names(rows: DataFrame, name: str = "product_name_clean") -> DataFrame:
    """Distinct unmatched names per store with ``id``, which orders them by listings, then first row.

    Ids come from a distributed sort.
    """
    free = rows.filter(F.col("match_group").isNull() & F.col(name).isNotNull())
    names = free.groupBy("store_key", F.col(name).alias("name")).agg(
        F.count("*").alias("num_rows"), F.min("row_ord").alias("first_row")
    )
    order = [F.desc("num_rows"), F.asc("first_row"), F.asc("name")]
    return stage(names.sort(*order).withColumn("id", F.monotonically_increasing_id()), "names")


def _signature(names: list[str]) -> np.ndarray:
    """Names with similar characters get near numbers: which of the commonest letters and digits they hold often."""
    bags = CharacterBags(names)
    out = np.zeros(len(names), dtype=np.int64)
    for character in "eaolnrtisdmcgp0123456789":
        out = out << 2 | np.minimum(bags.counts[:, CharacterBags.bucket(character)], 3)
    return out


def _coded(names: DataFrame) -> DataFrame:
    """Names with their words sorted, and ``code``, their signature."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sorted_tokens(t) for t in batch.column("name").to_pylist()]
            columns = [pa.array(texts, type=pa.string()) if c == "name" else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(_signature(texts))], [*batch.schema.names, "code"])

    ship(names.sparkSession)
    return names.mapInArrow(coded, StructType([*names.schema.fields, StructField("code", LongType())]))


def _blocks(names: DataFrame, size: int) -> DataFrame:
    """Rows (pair, code, ids, names, holders), each with up to ``size`` coded names of a pair that are neighbours by signature."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            cuts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, dtype=int)
            starts = sorted({s for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(pair)], strict=True) for s in range(a, b, size)})
            spans = list(zip(starts, [*starts[1:], len(pair)], strict=True))
            lists = {c: [batch.column(c).slice(a, b - a).to_pylist() for a, b in spans] for c in ("id", "name", "holder")}
            first = batch.take(pa.array(starts, type=pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    first.column("pair"), first.column("code"), pa.array(lists["id"], type=pa.list_(pa.int64())),
                    pa.array(lists["name"], type=pa.list_(pa.string())), pa.array(lists["holder"], type=pa.list_(pa.int64())),
                ],
                ["pair", "code", "ids", "names", "holders"],
            )

    order = ["pair", "code", "id"]
    rows = names.select("pair", "id", "name", "holder", "code").repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(packed, "pair INT, code BIGINT, ids ARRAY<BIGINT>, names ARRAY<STRING>, holders ARRAY<BIGINT>")


class _Best:
    """The best partners of a block's names so far; ties to the smaller id."""

    def __init__(self, pair: int, block: int, ids: np.ndarray, names: list[str], k: int, cutoff: float):
        self.pair, self.block, self.k, self.cutoff = pair, block, k, cutoff
        self.ids, self.bags = np.array(ids), CharacterBags(names)
        self.scores = np.full((len(ids), k), -1.0)
        self.partners = np.full((len(ids), k), _FREE)

    def _least(self) -> np.ndarray:
        """What a partner must reach for each name: its worst kept one, or the cutoff."""
        return np.maximum(self.scores[:, -1], self.cutoff)

    def meet(self, ids: np.ndarray, bags: CharacterBags, holders: np.ndarray) -> None:
        """Where far more pairs pass than are kept, the likeliest of each name come first: they raise what others must exceed."""
        least = self._least()
        margin = self.bags.margins(bags, least)
        if holders.min(initial=_FREE) < _FREE:
            margin[holders[None, :] <= self.ids[:, None]] = -1.0
        row, column = np.divmod(np.flatnonzero(margin >= 0), max(len(ids), 1))
        if len(row) > 2 * self.k * len(self.ids) and self.k < len(ids):
            cut = len(ids) - self.k
            likely = margin.argmax(axis=1)[:, None] if self.k == 1 else np.argpartition(margin, cut, axis=1)[:, cut:]
            first, second = np.repeat(np.arange(len(self.ids)), self.k), likely.ravel()
            wanted = margin[first, second] >= 0
            self._keep(ids, bags, first[wanted], second[wanted])
            margin[first, second] = -1.0
            # a margin shrinks by what more is needed for the two lengths
            more = (self._least() - least) / 200.0
            left = margin[row, column]
            passing = (left >= 0) & (left >= more[row] * (self.bags.lengths[row] + bags.lengths[column]) - 1e-3)
            row, column = row[passing], column[passing]
        self._keep(ids, bags, row, column)

    def _keep(self, ids: np.ndarray, bags: CharacterBags, row: np.ndarray, column: np.ndarray) -> None:
        likely = self.bags.pair_bounds(bags, row, column) >= self._least()[row]
        row, column = row[likely], column[likely]
        total = self.bags.lengths[row] + bags.lengths[column]
        score = np.where(total > 0, 200.0 * common_lengths(self.bags, bags, row, column) / np.maximum(total, 1), 100.0)
        good = score >= self._least()[row]
        row, score, partner = row[good], score[good], ids[column[good]]
        if not len(row):
            return
        touched = np.unique(row)
        row = np.concatenate([row, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.scores[touched].ravel()])
        partner = np.concatenate([partner, self.partners[touched].ravel()])
        order = np.lexsort((partner, -score, row))
        row, score, partner = row[order], score[order], partner[order]
        starts = np.searchsorted(row, touched)
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
        kept = rank < self.k
        self.scores[row[kept], rank[kept]], self.partners[row[kept], rank[kept]] = score[kept], partner[kept]

    def batch(self) -> pa.RecordBatch:
        sizes = (self.scores >= 0).sum(axis=1)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        held = self.scores >= 0
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[held])) for x in (self.partners, self.scores)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(self.ids), self.pair, dtype=np.int32)), pa.array(np.full(len(self.ids), self.block)), pa.array(self.ids), *lists,
                pa.array(sizes == self.k),
            ],
            ["pair", "block", "a", "bs", "scores", "more"],
        )


def best_partners(asking: DataFrame, offered: DataFrame, cutoff: float = FUZZY_CUTOFF, k: int = LIST, size: int | None = None) -> DataFrame:
    """(pair, block, a, bs, scores, more): the k most similar names offered to each asking name, best first, and whether there may be others.

    ``asking``: pair, id, name. ``offered``: pair, id, name, holder (an id; names from the holder's on may not have it; null: free).
    Both may have ``code``, if their words are sorted. ``size``: names of a block that asks.
    """
    spark = asking.sparkSession
    ship(spark)
    free = F.lit(_FREE).cast("bigint")
    asking, offered = (side if "code" in side.columns else _coded(side) for side in (asking, offered))
    mine = _blocks(asking.withColumn("holder", free), size or ASKING).withColumn("block", F.monotonically_increasing_id())
    left = stage(mine, "blocks")
    right = _blocks(offered.withColumn("holder", F.coalesce("holder", free)), BLOCK)
    # few pairs, many blocks: blocks are dealt over salts, and their partners sent to each
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the number of the partition, and the place in it
    salt = F.pmod(F.shiftright("block", 33) + F.col("block").bitwiseAND((1 << 33) - 1), F.lit(salts)).cast("int").alias("salt")
    mine = left.select("pair", "block", F.col("code").alias("at"), salt)
    other = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = mine.join(other, ["pair", "salt"]).select(
        "salt", "block", F.abs(F.col("at") - F.col("code")).alias("distance"), "pair", "ids", "names", "holders"
    )
    own = left.select(salt, "block", F.lit(-1).cast("bigint").alias("distance"), "pair", "ids", "names", "holders")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            distance, pair, block, held = (batch.column(c) for c in ("distance", "pair", "block", "names"))
            for row in range(batch.num_rows):
                ids, holders = (batch.column(c)[row].values.to_numpy() for c in ("ids", "holders"))
                names = held[row].values.to_pylist()
                if distance[row].as_py() < 0:
                    if best is not None:
                        yield best.batch()
                    best = _Best(pair[row].as_py(), block[row].as_py(), ids, names, k, cutoff)
                else:
                    best.meet(ids, CharacterBags(names), holders)
        if best is not None:
            yield best.batch()

    # each salt is a task: blocks are few, and hashes would put many into one
    rows = own.unionByName(met).repartitionById(salts, "salt").sortWithinPartitions("block", "distance")
    return rows.mapInArrow(searched, _LISTS)


def _taken(lists: pa.Table) -> pa.Table:
    """The names of one turn, in order: each takes the best of its list that no earlier one has."""
    lists = lists.sort_by("a")
    taken, picked, scores, ended = set(), [], [], []
    for bs, score, more in zip(*(lists.column(c).to_pylist() for c in ("bs", "scores", "more")), strict=True):
        at = next((i for i, b in enumerate(bs) if b not in taken), None)
        picked.append(None if at is None else bs[at])
        scores.append(None if at is None else score[at])
        ended.append(at is None and more)
        taken.add(picked[-1])
    columns = [lists.column("pair"), lists.column("a"), pa.array(picked, type=pa.int64()), pa.array(scores, type=pa.float64()), pa.array(ended, type=pa.bool_())]
    return pa.table(columns, ["pair", "a", "b", "score", "open"])


def _asked(lists: DataFrame) -> DataFrame:
    """One round over the lists of a turn: (pair, a, b, score, open), where ``open`` says that a full list has ended without a partner."""
    # a turn has a bounded number of names, and of partners listed for each
    return stage(lists.groupBy("pair").applyInArrow(_taken, _PICKS), "picks")


def _settled(asking: DataFrame, offered: DataFrame, cutoff: float, k: int) -> DataFrame:
    """(pair, a, b, score, open) of one turn: rounds until no list has ended."""
    most = F.lit(None).cast("bigint")
    lists = stage(best_partners(asking, offered.withColumn("holder", most), cutoff, k, TURN // _SEARCHES), "lists")
    while True:
        picks = _asked(lists)
        left = picks.where("open").groupBy("pair").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if not left:
            return picks
        # the fewer names are left, the longer their lists may be
        wanting = asking.join(picks.where("open").select(F.col("a").alias("id")), "id", "left_semi")
        holders = picks.where("b IS NOT NULL").select(F.col("b").alias("id"), F.col("a").alias("holder"))
        longer = max(k, k * TURN // left)
        renewed = best_partners(wanting, offered.join(holders, "id", "left"), cutoff, longer, -(-left // _SEARCHES))
        lists = stage(lists.join(wanting.select(F.col("id").alias("a")), "a", "left_anti").unionByName(renewed), "lists")


def _in_turns(asking: DataFrame) -> tuple[DataFrame, int]:
    """Names with ``turn``, their place among the names of their pair over the size of a turn, and the number of turns."""
    places = ranked_values(asking, ["pair"], "id").select("pair", F.col("id").cast("bigint").alias("id"), F.floor(F.col("below") / TURN).alias("turn"))
    turns = stage(asking.join(places, ["pair", "id"]), "turns")
    return turns, 1 + (turns.agg(F.max("turn")).first()[0] if not turns.isEmpty() else -1)


def _matched(asking: DataFrame, offered: DataFrame, cutoff: float, k: int, path: str) -> None:
    """Write the links (pair, a, b, score) of store pairs that share no store, a folder below ``path`` for each turn."""
    spark = asking.sparkSession
    asking, number = _in_turns(asking)
    for turn in range(number):
        now = asking.where(F.col("turn") == turn).drop("turn")
        _settled(now, offered, cutoff, k).where("b IS NOT NULL").select("pair", "a", "b", "score").write.parquet(f"{path}/turn={turn}")
        gone = spark.read.schema(_LINKS).parquet(f"{path}/turn={turn}").select(F.col("b").alias("id"))
        offered = stage(offered.join(gone, "id", "left_anti"), "offered")


def fuzzy_links(names: DataFrame, cutoff: float = FUZZY_CUTOFF, k: int = LIST) -> DataFrame:
    """One row per link: both stores and names, similarity, rows, and the order in which it was made."""
    spark = names.sparkSession
    first = names.groupBy("store_key").agg(F.min("first_row").alias("f"))
    # bounded by the number of stores
    stores = [r["store_key"] for r in first.orderBy("f").collect()]
    links = spark.createDataFrame([], _LINKS)
    path = f"{stage_root(spark)}/links-{uuid.uuid4().hex}"
    free = stage(_coded(names.select("store_key", "id", "name")), "free")
    for level in range(1, 2 * len(stores) - 2):
        pairs = [(i, level - i) for i in range(len(stores)) if i < level - i < len(stores)]
        sides = [
            free.join(spark.createDataFrame([(stores[p[side]], p[0]) for p in pairs], "store_key STRING, pair INT"), "store_key").select("pair", "id", "name", "code")
            for side in (0, 1)
        ]
        _matched(*sides, cutoff, k, f"{path}/level={level}")
        links = spark.read.schema(_LINKS).parquet(f"{path}/level=*/turn=*")
        taken = links.select(F.explode(F.array("a", "b")).alias("id"))
        free = stage(free.join(taken, "id", "left_anti"), "free")
    return _describe(links, names, stores)


def best_scores(names: DataFrame, cutoff: float = FUZZY_CUTOFF, k: int = 1) -> DataFrame:
    """(store_a, name_a, store_b, name_b, rank, score): the k most similar names of every later store (by name), ties in order of name."""
    spark = names.sparkSession
    ordered = stage(names.select("store_key", "name").sort("name").withColumn("id", F.monotonically_increasing_id()), "ordered")
    coded = stage(_coded(ordered), "coded")
    stores = sorted(r["store_key"] for r in names.select("store_key").distinct().collect())
    pairs = list(itertools.combinations(stores, 2))
    if not pairs:
        return spark.createDataFrame([], "store_a STRING, name_a STRING, store_b STRING, name_b STRING, rank INT, score DOUBLE")
    sides = [
        coded.join(spark.createDataFrame([(p[side], n) for n, p in enumerate(pairs)], "store_key STRING, pair INT"), "store_key") for side in (0, 1)
    ]
    found = best_partners(sides[0], sides[1].withColumn("holder", F.lit(None).cast("bigint")), cutoff, k)
    found = found.select("a", F.posexplode(F.arrays_zip("bs", "scores")).alias("rank", "found"))
    end = lambda s: ordered.select(F.col("id").alias(s), F.col("store_key").alias(f"store_{s}"), F.col("name").alias(f"name_{s}"))
    found = found.select("a", F.col("found.bs").alias("b"), (F.col("rank") + 1).alias("rank"), F.col("found.scores").alias("score"))
    return found.join(end("a"), "a").join(end("b"), "b").select("store_a", "name_a", "store_b", "name_b", "rank", "score")


def _describe(links: DataFrame, names: DataFrame, stores: list[str]) -> DataFrame:
    def side(s: str) -> DataFrame:
        return names.select(
            F.col("id").alias(s), F.col("store_key").alias(f"store_{s}"), F.col("name").alias(f"name_{s}"),
            F.col("num_rows").alias(f"rows_{s}"),
        )

    rank = {s: i for i, s in enumerate(stores)} or {"": 0}
    place = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    return (
        links.join(side("a"), "a")
        .join(side("b"), "b")
        .withColumn("link_order", F.struct(place[F.col("store_a")].alias("i"), place[F.col("store_b")].alias("j"), "a"))
        .withColumn("match_group", F.concat_ws(":", F.lit("fz"), "store_a", "name_a"))
        .drop("pair")
    )


def apply_links(rows: DataFrame, links: DataFrame, name: str = "product_name_clean") -> DataFrame:
    """Rows with the groups of the links; they are pass 4."""
    sides = [
        links.select(
            F.col(f"store_{s}").alias("_store"), F.col(f"name_{s}").alias("_name"), F.col("match_group").alias("_group")
        )
        for s in "ab"
    ]
    named = reduce(DataFrame.unionByName, sides)
    same = (F.col("store_key") == F.col("_store")) & (F.col(name) == F.col("_name")) & F.col("match_group").isNull()
    return rows.join(named, same, "left").select(
        *[c for c in rows.columns if c not in ("match_group", "match_pass")],
        F.coalesce("match_group", "_group").alias("match_group"),
        F.coalesce("match_pass", F.when(F.col("_group").isNotNull(), 4)).alias("match_pass"),
    )


def fuzzy_boost(rows: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """Rows with fuzzy groups added to the unmatched ones; the same at every size."""
    return apply_links(rows, fuzzy_links(unmatched_names(rows), cutoff))

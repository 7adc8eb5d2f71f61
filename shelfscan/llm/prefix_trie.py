"""Prefix trie of rebuilt conversations, by fingerprints of a composable monoid.

A plan rebuilds every conversation from the first ``head`` turns of a base conversation, followed by its own
turns after its first ``head``. Each distinct sequence of first d rebuilt turns is a node of the trie.

Method: a sequence of n turns has the product (n, F, L): F = sum of x(i) * B**i over its turn
hashes, modulo four primes of 31 bits, and L its code points. Products compose,
(n, F, L) * (m, G, M) = (n + m, F + B**n * G, L + M), and every conversation's prefix products are computed
once, over the stored turns. A rebuilt prefix is base head * own suffix, and its product
follows from three prefix products by arithmetic, so no rebuilt text is ever
made. Prefixes with equal depth and product form a group. A group is verified through the stored
turns its members refer to: all must have the same parent group, and last turns that are different rows
must have equal role and text. If any group fails, everything is made again with other hashes.

No node is compared with its descendants. Let a conversation own the nodes whose smallest
member it is; they are the last ones of its path. Then

* children of a node: members that own their node one level deeper
* childless nodes below it: members that own the childless node their path ends in
* saved code points below it: for every member, the code points from here to the first node it owns

so a node's figures are sums over its members, aggregated map-side.

* null conversation id: the row takes no part
* null role or text: empty; null turn: first; ties in turn: by role, then text; repeated rows are turns of their own
* conversations without rebuilt turns are members of the root alone; a base without rows has no turns
* very long conversations: turns are dealt by range of (conversation, turn), so one conversation may span tasks; its pieces' products are composed
* empty table: empty result (a root needs a member); other columns are ignored

At scale: rows are shuffled as numbers only (texts once, for order, and where equal turns are different rows);
the digest of the conversations that end in a node is made of blocks of sorted ids, streamed.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.sources.shipping import ship
from shelfscan.sources.staging import stage

#: The four largest primes below 2**31, two to a packed column.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_MASK = (1 << 31) - 1
BLOCK = 1024


class Ring:
    """Powers of a base modulo each prime."""

    def __init__(self, seed: int):
        self.seed = seed
        self.bases = [int(hashlib.sha256(f"{seed}:{p}".encode()).hexdigest(), 16) % (p - 2) + 2 for p in PRIMES]
        self._powers = [np.ones(1, dtype=np.uint64) for _ in PRIMES]

    def powers(self, k: int, n: int) -> np.ndarray:
        """B**0 to B**(n-1) modulo prime k."""
        have, p = self._powers[k], PRIMES[k]
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(self.bases[k], len(have), p)) % np.uint64(p)])
        self._powers[k] = have
        return have[:n]

    def power(self, k: int, exponents: np.ndarray, inverse: bool = False) -> np.ndarray:
        """B**exponent (or B**-exponent) modulo prime k."""
        p, left = np.uint64(PRIMES[k]), exponents.astype(np.uint64)
        square = pow(self.bases[k], -1, PRIMES[k]) if inverse else self.bases[k]
        out = np.ones(len(left), dtype=np.uint64)
        while left.any():
            out = np.where(left & np.uint64(1) == 1, out * np.uint64(square) % p, out)
            left, square = left >> np.uint64(1), square * square % PRIMES[k]
        return out


def _pack(a: np.ndarray, b: np.ndarray) -> pa.Array:
    return pa.array((a.astype(np.int64) << 31) | b.astype(np.int64))


def _residues(packed: list[Column]) -> list[Column]:
    mask = F.lit(_MASK).cast("long")
    return [r for c in packed for r in (F.shiftright(c, 31), c.bitwiseAND(mask))]


def _packed(residues: list[Column]) -> list[Column]:
    return [F.shiftleft(residues[i], 31).bitwiseOR(residues[i + 1]) for i in (0, 2)]


def _scan(ring: Ring, kind: str):
    """Products of the prefixes of each conversation's piece in a sorted partition."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, place, length, sums = None, 0, 0, [0] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv")
            values = conv.to_numpy(zero_copy_only=False)
            opens = np.append(True, values[1:] != values[:-1])
            starts = np.flatnonzero(opens)
            same = held is not None and bool(values[0] == held)
            group = np.cumsum(opens) - 1
            carried = np.where(group == 0, place if same else 0, 0)
            at = np.arange(len(values)) - starts[group] + carried  # turns before this one, in this piece
            chars = batch.column("len").to_numpy().astype(np.int64)
            total = np.cumsum(chars)
            before = total - chars
            before = before - before[starts][group] + np.where(group == 0, length if same else 0, 0)
            after = []
            earlier = []
            hashes = [batch.column(c).to_numpy().view(np.uint64) for c in ("x", "y")]
            for k, p in enumerate(PRIMES):
                symbol = (hashes[k // 2] >> np.uint64(32 * (k % 2)) & np.uint64(_MASK)) % np.uint64(p)
                term = symbol * ring.powers(k, int(at.max()) + 1)[at] % np.uint64(p)
                run = np.cumsum(term)  # terms below 2**31: no overflow
                base = (run - term)[starts][group]
                first = np.uint64(sums[k] if same else 0)
                whole = run - base + np.where(group == 0, first, np.uint64(0))
                after.append(whole % np.uint64(p))
                earlier.append((whole - term) % np.uint64(p))
            held, place, length = values[-1], int(at[-1]) + 1, int(before[-1] + chars[-1])
            sums = [int(a[-1]) for a in after]
            columns = [
                conv, pa.array(np.full(len(values), part, dtype=np.int32)), pa.array((at + 1).astype(np.int64)),
                _pack(after[0], after[1]), _pack(after[2], after[3]), _pack(earlier[0], earlier[1]), _pack(earlier[2], earlier[3]),
                pa.array(before), batch.column("len"), batch.column("role"), batch.column("text"),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "part", "place", "fa", "fb", "ga", "gb", "before", "len", "role", "text"])

    return rows, f"conv {kind}, part int, place long, fa long, fb long, ga long, gb long, before long, len long, role string, text string"


def _with_factors(df: DataFrame, ring: Ring, up: str, down: str | None = None) -> DataFrame:
    """The rows with m0 to m3: B**up (times B**-down) for each prime."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            factors = []
            for k, p in enumerate(PRIMES):
                m = ring.power(k, batch.column(up).to_numpy())
                if down:
                    m = m * ring.power(k, batch.column(down).to_numpy(), inverse=True) % np.uint64(p)
                factors.append(pa.array(m.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *factors], [*batch.schema.names, "m0", "m1", "m2", "m3"])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.schema] + [f"m{k} long" for k in range(4)])
    return df.mapInArrow(rows, schema)


def _moved(a: str, b: str, first: list[Column], second: list[Column], factor: list[Column]) -> list[Column]:
    """first + factor * second, residue by residue, packed into columns a and b."""
    out = [(first[k] + second[k] * factor[k]) % F.lit(p) for k, p in enumerate(PRIMES)]
    return [c.alias(name) for c, name in zip(_packed(out), (a, b), strict=True)]


def stored_turns(plain: DataFrame, ring: Ring) -> DataFrame:
    """Every stored turn with its place (from 1), the products up to and before it (f, g), and the code points before it.

    ``plain`` has conv (not null), turn, role and text (not null).
    """
    seed = F.lit(ring.seed)
    hashed = plain.select(
        "conv", "turn", "role", "text", F.char_length("text").cast("long").alias("len"),
        F.xxhash64(seed, F.lit(1), "role", "text").alias("x"), F.xxhash64(seed, F.lit(2), "role", "text").alias("y"),
    )
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    rows, schema = _scan(ring, plain.schema["conv"].dataType.simpleString())
    pieces = stage(hashed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(rows, schema), "turns")
    # a conversation that goes on in the next partition is the last of one and the first of the next: few rows per partition
    lasts = pieces.groupBy("part").agg(F.max("conv").alias("z"), F.min("conv").alias("a"))
    edges = lasts.select("part", F.explode(F.array("a", "z")).alias("conv")).distinct()
    split = edges.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    ends = (
        pieces.join(split, "conv", "left_semi")
        .groupBy("conv", "part")
        .agg(
            F.max("place").alias("n"), F.max_by("fa", "place").alias("fa"), F.max_by("fb", "place").alias("fb"),
            F.max(F.col("before") + F.col("len")).alias("chars"),
        )
    )
    pieces_before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    ends = _with_factors(ends.withColumn("skip", F.coalesce(F.sum("n").over(pieces_before), none)), ring, "skip")
    parts = _residues([F.col("fa"), F.col("fb")])
    ends = ends.select(
        "conv", "part", "skip", "chars", "m0", "m1", "m2", "m3", *[(parts[k] * F.col(f"m{k}") % F.lit(p)).alias(f"t{k}") for k, p in enumerate(PRIMES)]
    )
    ends = ends.select(
        F.col("conv").alias("conv_"), F.col("part").alias("part_"), "skip", "m0", "m1", "m2", "m3",
        F.coalesce(F.sum("chars").over(pieces_before), none).alias("chars"),
        *[(F.coalesce(F.sum(f"t{k}").over(pieces_before), none) % F.lit(p)).alias(f"o{k}") for k, p in enumerate(PRIMES)],
    )
    ends = stage(ends.where("skip > 0"), "pieces")
    moved = pieces.join(ends, (F.col("conv") == F.col("conv_")) & (F.col("part") == F.col("part_")), "left")
    skip = F.coalesce("skip", none)
    offset, factor = [F.coalesce(f"o{k}", none) for k in range(4)], [F.coalesce(f"m{k}", F.lit(1).cast("long")) for k in range(4)]
    whole = lambda a, b: _moved(a, b, offset, _residues([F.col(a), F.col(b)]), factor)
    return moved.select(
        "conv", (F.col("place") + skip).alias("place"), *whole("fa", "fb"), *whole("ga", "gb"),
        (F.col("before") + F.coalesce("chars", none)).alias("before"), "len", "role", "text",
    )


def rebuilt_paths(turns: DataFrame, plan: DataFrame, ring: Ring) -> DataFrame:
    """One row per rebuilt conversation and depth, the root included.

    conv, depth, size (its rebuilt turns), total (code points), f (product), g (parent's product), before (code points
    before the last turn), and the stored turn referred to (owner, place).
    """
    numbers = turns.select("conv", "place", "fa", "fb", "ga", "gb", "before", "len")
    sizes = stage(numbers.groupBy("conv").agg(F.max("place").alias("n"), F.max(F.col("before") + F.col("len")).alias("chars")), "sizes")
    known = sizes.join(plan.select("conv", "base", F.col("head").cast("long").alias("head")), "conv", "left").select(
        "conv", "n", "chars", "base", F.greatest(F.coalesce("head", F.lit(0)), F.lit(0)).cast("long").alias("head")
    )
    base_sizes = sizes.select(F.col("conv").alias("base_"), F.col("n").alias("base_n"))
    known = known.join(base_sizes, F.col("base") == F.col("base_"), "left").select(
        "conv", "n", "chars", "base", F.least("head", "n").alias("skip"), F.least("head", F.coalesce("base_n", F.lit(0))).alias("lead")
    )
    at = lambda s: numbers.select(
        F.col("conv").alias(f"conv_{s}"), F.col("place").alias(f"place_{s}"), F.col("fa").alias(f"fa_{s}"), F.col("fb").alias(f"fb_{s}"),
        (F.col("before") + F.col("len")).alias(f"chars_{s}"),
    )
    known = (
        known.join(at("b"), (F.col("base") == F.col("conv_b")) & (F.col("lead") == F.col("place_b")), "left")
        .join(at("s"), (F.col("conv") == F.col("conv_s")) & (F.col("skip") == F.col("place_s")), "left")
        .na.fill(0, ["fa_b", "fb_b", "chars_b", "fa_s", "fb_s", "chars_s"])
        .select(
            "conv", "base", "skip", "lead", "fa_b", "fb_b", "chars_b", "fa_s", "fb_s", "chars_s",
            (F.col("lead") + F.col("n") - F.col("skip")).alias("size"),
            (F.col("chars_b") + F.col("chars") - F.col("chars_s")).alias("total"),
        )
    )
    known = stage(_with_factors(known, ring, "lead", "skip"), "rebuilt")
    turn = numbers.select(F.col("conv").alias("owner"), "place", "fa", "fb", "ga", "gb", "before")
    columns = ["conv", "depth", "size", "total", "fa", "fb", "ga", "gb", "before", "owner", "place"]
    heads = known.where("lead > 0").join(turn, (F.col("base") == F.col("owner")) & (F.col("place") <= F.col("lead")))
    heads = heads.withColumn("depth", F.col("place")).select(*columns)
    own = known.where("size > lead").join(turn, (F.col("conv") == F.col("owner")) & (F.col("place") > F.col("skip")))

    def composed(a: str, b: str) -> list[Column]:
        head, skipped = _residues([F.col("fa_b"), F.col("fb_b")]), _residues([F.col("fa_s"), F.col("fb_s")])
        mine = [(m - s + F.lit(p)) % F.lit(p) for m, s, p in zip(_residues([F.col(a), F.col(b)]), skipped, PRIMES, strict=True)]
        return _moved(a, b, head, mine, [F.col(f"m{k}") for k in range(4)])

    own = own.select(
        "conv", (F.col("lead") + F.col("place") - F.col("skip")).alias("depth"), "size", "total", *composed("fa", "fb"), *composed("ga", "gb"),
        (F.col("chars_b") + F.col("before") - F.col("chars_s")).alias("before"), "owner", "place",
    )
    kind = turns.schema["conv"].dataType
    none = F.lit(0).cast("long")
    root = known.select(
        "conv", none.alias("depth"), "size", "total", none.alias("fa"), none.alias("fb"), F.lit(-1).cast("long").alias("ga"), none.alias("gb"),
        none.alias("before"), F.lit(None).cast(kind).alias("owner"), none.alias("place"),
    )
    return stage(heads.unionByName(own).unionByName(root), "paths")


def _groups(paths: DataFrame) -> DataFrame:
    """Prefix groups, with what verification needs."""
    return paths.groupBy("depth", "fa", "fb").agg(
        F.min("conv").alias("top"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("longest"), F.min("before").alias("start"),
        F.min("ga").alias("ga"), F.min("gb").alias("gb"), F.max("ga").alias("ga_z"), F.max("gb").alias("gb_z"),
        F.min("owner").alias("owner_"), F.min_by("place", "owner").alias("place_"), F.max("owner").alias("owner_z"),
        F.min("place").alias("least"), F.max("place").alias("most"),
    )


def _verified(paths: DataFrame, groups: DataFrame, turns: DataFrame) -> bool:
    """All members of a group have one parent group, and the stored turns they end in are equal."""
    if not groups.where("ga != ga_z OR gb != gb_z").isEmpty():
        return False
    mixed = groups.where("owner_ != owner_z OR least != most").select(
        F.col("depth").alias("d"), F.col("fa").alias("a"), F.col("fb").alias("b"), "owner_", "place_"
    )
    pairs = (
        paths.join(mixed, (F.col("depth") == F.col("d")) & (F.col("fa") == F.col("a")) & (F.col("fb") == F.col("b")))
        .where("owner != owner_ OR place != place_")
        .select("owner", "place", "owner_", "place_")
        .distinct()
    )
    said = turns.select("conv", F.col("place").alias("at"), "role", "text")
    left = pairs.join(said, (F.col("owner") == F.col("conv")) & (F.col("place") == F.col("at"))).select(
        "owner_", "place_", F.col("role").alias("role_"), F.col("text").alias("text_")
    )
    both = left.join(said, (F.col("owner_") == F.col("conv")) & (F.col("place_") == F.col("at")))
    return both.where("role != role_ OR text != text_").isEmpty()


def _digests(paths: DataFrame) -> DataFrame:
    """SHA-256 of the sorted, comma-joined ids of the conversations that end in a node (depth, fa, fb)."""
    key = ["depth", "fa", "fb"]

    def blocks(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in key])
            opens = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
            starts = np.flatnonzero(opens)
            size = np.diff(np.append(starts, len(opens)))
            n = -(-size // BLOCK)
            begin = np.repeat(starts, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * BLOCK
            end = np.minimum(begin + BLOCK, np.repeat(starts + size, n))
            ids = batch.column("conv").to_pylist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            chosen = batch.select([*key, "conv"]).take(pa.array(begin))
            yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(texts, type=pa.string())], [*key, "conv", "ids"])

    def hashed(batches):
        held, digest = None, None
        for batch in batches:
            done = []
            for *k, ids in zip(*(batch.column(c).to_pylist() for c in (*key, "ids")), strict=True):
                if k != held:
                    if digest is not None:
                        done.append((*held, digest.hexdigest()))
                    held, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digest_batch(done)
        if digest is not None:
            yield _digest_batch([(*held, digest.hexdigest())])

    order = [*key, "conv"]
    kind = paths.schema["conv"].dataType.simpleString()
    rows = paths.where("depth = size").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = rows.mapInArrow(blocks, f"depth long, fa long, fb long, conv {kind}, ids string")
    return chunks.repartition(*key).sortWithinPartitions(*order).mapInArrow(hashed, "depth long, fa long, fb long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], ["depth", "fa", "fb", "ends_sha256"]
    )


def prefix_trie(
    rows: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per node: conv (smallest member), depth, parent (its conv), n_convs, n_children, n_leaves, saved, ends_sha256,
    and the stored turn (owner, place) that stands for its last turn.

    ``plan``: (conv, base, head), one row per conversation that is not rebuilt from itself alone.
    """
    ship(rows.sparkSession)
    plain = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    for seed in itertools.count():
        ring = Ring(seed)
        turns = stored_turns(plain, ring)
        paths = rebuilt_paths(turns, plan, ring)
        groups = stage(_groups(paths), "groups")
        if _verified(paths, groups, turns):
            return _nodes(paths, groups)


def _nodes(paths: DataFrame, groups: DataFrame) -> DataFrame:
    owned = groups.groupBy(F.col("top").alias("conv_")).agg(
        F.min("depth").alias("first"), F.min("start").alias("start_"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf")
    )
    placed = paths.join(owned, F.col("conv") == F.col("conv_"), "left")
    deeper = F.col("depth") + 1
    child = (F.col("first") <= deeper) & (deeper <= F.col("size"))
    spared = F.greatest(F.coalesce("start_", "total") - F.col("before"), F.lit(0))
    sums = placed.groupBy("depth", "fa", "fb").agg(
        F.count(F.when(child, 1)).alias("n_children"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(spared).alias("saved")
    )
    above = groups.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("ga"), F.col("fb").alias("gb"), F.col("top").alias("parent"))
    key = ["depth", "fa", "fb"]
    return (
        groups.join(sums, key)
        .join(_digests(paths), key, "left")
        .join(above, ["depth", "ga", "gb"], "left")
        .select(
            F.col("top").alias("conv"), "depth", "parent", "n_convs", "n_children", "n_leaves", "saved",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), F.col("owner_").alias("owner"), F.col("place_").alias("place"),
        )
    )

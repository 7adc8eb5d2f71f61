import hashlib
import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfscan.llm import prefix_trie as trie
from shelfscan.llm.op13_query import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, place int, owner string, depth int"


def brute(rows, plan):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for conv, mine in own.items():
        base, head = plan(conv)
        path = tuple(own.get(base, [])[:head] + mine[head:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((conv, len(path)))
    out = set()
    for path, members in nodes.items():
        below = [q for q in nodes if q[: len(path)] == path]
        has_child = {q[:-1] for q in below if q}
        ends = ",".join(str(c) for c, size in sorted(members) if size == len(path))
        out.add((
            min(members)[0], len(path), min(nodes[path[:-1]])[0] if path else None, len(members), sum(len(q) == len(path) + 1 for q in below),
            sum(q not in has_child for q in below), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def plan_of(conv):
    return conv - conv % 100, zlib.crc32(str(conv).encode()) % 6


def plan_frame(spark, rows, rule=plan_of):
    convs = sorted({r[0] for r in rows if r[0] is not None})
    return spark.createDataFrame([(c, *rule(c)) for c in convs], "conv long, base long, head long")


def nodes_of(spark, rows, rule=plan_of):
    frame = spark.createDataFrame([(*r, 1, "o", 2) for r in rows], SCHEMA)
    done = trie.prefix_trie(frame, plan_frame(spark, rows, rule))
    return done.select("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256")


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(0, 40), *range(100, 130), 205, 299, 1000]:
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])))
    rows += [(None, 0, "user", "lost"), (3, None, "user", "first"), (4, 2, None, "no role"), (5, 2, "user", None), (6, 1, "user", "a"), (6, 1, "user", "a")]
    rows += [(7, 1, "", "x"), (7, 1, None, "x"), (500, None, None, None), (-5, 0, "user", "a"), (-105, 0, "user", "bb")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed):
    rows = some_rows(seed)
    rule = lambda c: (int(c - math.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6)
    got = nodes_of(spark, rows, rule).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(rows, rule)


def test_heads_of_any_base_and_length(spark):
    rng = random.Random(5)
    rows = some_rows(5)
    rule = lambda c: random.Random(c).choice([(c, 3), (0, 4), (999, 2), (100, 50), (c, 0)])
    rows += [(0, 50 + i, "user", rng.choice("xyz")) for i in range(30)]
    assert {tuple(r) for r in nodes_of(spark, rows, rule).collect()} == brute(rows, rule)


def test_one_conversation_over_many_tasks(spark):
    rows = [(7, i, "user", f"t{i % 3}") for i in range(400)] + [(8, i, "user", f"t{i % 3}") for i in range(400)] + some_rows(3)
    rule = lambda c: (7, 200) if c == 9 else (c, 0)
    turns = trie.stored_turns(spark.createDataFrame(rows, "conv long, turn long, role string, text string").where("conv is not null").na.fill(""), trie.Ring(0))
    assert [r["place"] for r in turns.where("conv = 8").sort("place").collect()] == list(range(1, 1 + sum(r[0] == 8 for r in rows)))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(r) for r in nodes_of(spark, rows, rule).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute(rows, rule)


def test_unequal_turns_under_one_hash_are_told_apart(spark, monkeypatch):
    rows = some_rows(4)
    seeds = []
    whole = trie.stored_turns

    def weak(plain, ring):
        seeds.append(ring.seed)
        if ring.seed == 0:  # "bb" and "ccc" look the same, their texts are kept
            masked = plain.withColumn("real", F.col("text")).withColumn("text", F.regexp_replace("text", "^ccc$", "bb"))
            turns = whole(masked.drop("real"), ring)
            ranked = whole(plain, ring)
            return turns.drop("role", "text").join(ranked.select("conv", "place", "role", "text"), ["conv", "place"])
        return whole(plain, ring)

    monkeypatch.setattr(trie, "stored_turns", weak)
    rule = lambda c: (c, 0)
    assert {tuple(r) for r in nodes_of(spark, rows, rule).collect()} == brute(rows, rule)
    assert seeds == [0, 1]


def test_many_ends_in_one_node(spark):
    rows = [(c, 0, "user", "same") for c in range(2600)]
    got = {tuple(r) for r in nodes_of(spark, rows, lambda c: (c, 0)).collect()}
    digest = hashlib.sha256(",".join(map(str, range(2600))).encode()).hexdigest()
    assert got == {(0, 0, None, 2600, 1, 1, 2599 * 4, hashlib.sha256(b"").hexdigest()), (0, 1, 0, 2600, 0, 1, 2599 * 4, digest)}


def test_powers(spark):
    import numpy as np

    ring = trie.Ring(3)
    exponents = np.array([0, 1, 2, 77, 10**6])
    for k, p in enumerate(trie.PRIMES):
        assert ring.power(k, exponents).tolist() == [pow(ring.bases[k], int(e), p) for e in exponents]
        assert ring.power(k, exponents, inverse=True).tolist() == [pow(ring.bases[k], -int(e), p) for e in exponents]
        assert ring.powers(k, 100).tolist() == [pow(ring.bases[k], e, p) for e in range(100)]
        assert all(p % q for q in itertools.chain([2], range(3, 47000, 2)))


def test_empty_table(spark, folder):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    got = QUERIES["op13_conversation_prefix_trie"](spark, folder)
    assert got.count() == 0 and len(got.columns) == 8

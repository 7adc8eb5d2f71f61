import itertools
import zlib

import numpy as np

from shelfscan.llm.sharding import difference, shard_documents


def loads(rows, shards):
    sums = [0] * shards
    for r in rows:
        sums[r["shard"]] += r["size"]
    return sums


def test_differencing_keeps_every_sum():
    rng = np.random.default_rng(5)
    for k in (2, 3, 7):
        sums = np.zeros((50, k), dtype=np.int64)
        sums[:, 0] = rng.integers(1, 10_000, 50)
        sums[3] = rng.integers(0, 5000, k)
        total, where = difference(sums)
        again = np.zeros(k, dtype=np.int64)
        for row, place in zip(sums, where, strict=True):
            again[place] += row
        assert again.tolist() == total.tolist() and total.max() - total.min() < 1000


def test_textbook_example():
    total, _ = difference(np.array([[s, 0] for s in (8, 7, 6, 5, 4)]))
    assert sorted(total.tolist()) == [14, 16]


def test_near_optimal_on_small_sets():
    rng = np.random.default_rng(1)
    for _ in range(10):
        sizes = rng.integers(1, 100, 9)
        total, _ = difference(np.array([[s, 0] for s in sizes]))
        best = min(abs(sizes.sum() - 2 * sum(c)) for n in range(10) for c in itertools.combinations(sizes, n))
        assert total.max() - total.min() <= best + 25


def test_awkward_rows(awkward, nothing):
    rows = shard_documents(awkward, shards=4).collect()
    texts = sorted((r["doc_id"], r["text"]) for r in awkward.where("doc_id is not null and doc_id not in (2)").collect() if r["text"] is not None)
    got = {r["id"]: r for r in rows if r["id"] not in (None, 2)}
    assert len(rows) == awkward.count()
    for i, text in texts:
        assert (got[i]["size"], got[i]["text_crc32"]) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
    assert (got[3]["size"], got[3]["text_crc32"]) == (16, 0)
    assert got[1]["shard"] in {r["shard"] for r in rows if r["id"] == 2}
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    groups = {}
    for r in rows:
        groups.setdefault(r["group"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())
    assert shard_documents(nothing).collect() == []


def test_blocks_fill_around_a_large_group(spark):
    """A group with a third of all bytes stays whole; the other shards are near equal, in one block or many."""
    rows = [(i, "hot " * 50) for i in range(2000)] + [(i, f"text {i} " + "y" * (i % 401)) for i in range(2000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1 << 14, 700):
        placed = shard_documents(docs, shards=5, block=block).collect()
        sums = sorted(loads(placed, 5))
        assert len({r["shard"] for r in placed if r["id"] < 2000}) == 1
        assert sums[4] >= 2000 * 216 and sums[3] - sums[0] < 500


def slow_difference(tuples):
    """Differencing by its definition: sort by spread, join the first two, until one is left."""
    left = [sorted(t, reverse=True) for t in tuples]
    while len(left) > 1:
        left.sort(key=lambda t: t[0] - t[-1], reverse=True)
        a, b = left[:2]
        left = [sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True), *left[2:]]
    return left[0]


def test_differencing_equals_its_definition():
    rng = np.random.default_rng(8)
    for k in (2, 3, 5):
        sums = rng.permutation(np.array([[2**i * 3 + i] + [0] * (k - 1) for i in range(14)], dtype=np.int64))
        assert sorted(difference(sums)[0].tolist(), reverse=True) == slow_difference(sums.tolist())


def test_spread_does_not_grow_with_the_blocks(spark):
    """Blocks of 60 groups in rounds of 4: several rounds, every row once, groups whole, spread of a few bytes."""
    rng = np.random.default_rng(9)
    sizes = rng.integers(1, 400, 4000).tolist()
    docs = spark.createDataFrame([(i, f"{i:05d}" + "z" * n) for i, n in enumerate(sizes)], "doc_id long, text string")
    for shards, hot in ((5, 0), (5, 3000), (7, 1), (1, 0)):
        rows = docs.unionByName(spark.createDataFrame([(10_000 + i, "hot" * 40) for i in range(hot)], docs.schema)) if hot else docs
        placed = shard_documents(rows, shards=shards, block=60, fan=4).collect()
        assert sorted(r["id"] for r in placed) == sorted([*range(4000), *range(10_000, 10_000 + hot)])
        groups = {(r["group"], r["shard"]) for r in placed}
        assert len(groups) == 4000 + (hot > 0)
        sums = sorted(loads(placed, shards))[: shards - (hot == 3000)]
        assert sums[-1] - sums[0] < 60
        for shard in range(shards):
            slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
            assert slots == list(range(len(slots)))

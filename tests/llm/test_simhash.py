import random

import numpy as np
import xxhash

from shelfscan.llm.components import components
from shelfscan.llm.simhash import GrayIndex, fingerprint, near_duplicates, near_links, one_of_each


def slow_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius=3):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def near_values(seed, groups=12, size=12):
    rng = random.Random(seed)
    out = set()
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            out.add(value)
    return sorted(out)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints():
    for text in ("", "  ", "One", "two WORDS", "a b c", "ÄÖ É x y z", "rep rep rep rep rep", "the quick brown fox jumps over it"):
        assert fingerprint(text.encode()) == slow_print(text)


def test_index_spans_the_components_of_each_group():
    for seed in range(25):
        values = near_values(seed)
        groups = np.sort(np.random.default_rng(seed).integers(0, 3, len(values)))
        index = GrayIndex(np.array(values, dtype=np.uint64), groups, fanout=2 + seed % 7)
        links = index.links()
        whole = 0
        for g in range(3):
            members = [int(v) for v in index.leaves[index.groups == g]]
            if members:
                whole += len(members) - len(set(roots(members)))
        assert len(links) == whole
        assert all(int(index.leaves[a] ^ index.leaves[b]).bit_count() <= 3 and index.groups[a] == index.groups[b] for a, b in links)


def test_links_do_not_depend_on_the_group_limit(spark):
    values = near_values(3, groups=20, size=25) + near_values(4, groups=1, size=60)
    values = sorted(set(values))
    prints = spark.createDataFrame([(signed(v),) for v in values], "print long")
    expected = len(values) - len(set(roots(values)))
    for limit in (4096, 3):
        found = components(near_links(prints, group_limit=limit)).collect()
        assert len(found) - len({r["root"] for r in found}) == expected


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 5), (7, None), (100, 101)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    prints = [slow_print(t) for _, t in rows]
    at = roots(prints)
    ids = {}
    for (i, _), r in zip(rows, at, strict=True):
        ids.setdefault(r, []).append(i)
    least = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    expected = sorted(((i, signed(p), least[r]) for (i, _), p, r in zip(rows, prints, at, strict=True)), key=str)
    assert sorted(((r["id"], r["print"], r["component"]) for r in near_duplicates(awkward).collect()), key=str) == expected
    assert near_duplicates(nothing).collect() == []
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((i for i, _, c in expected if i is None or i == c), key=str)

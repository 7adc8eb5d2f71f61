import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfscan.llm.op11_query import QUERIES
from shelfscan.llm.periodic_runs import SuffixArray, find_runs, periodic_runs, word_numbers
from shelfscan.llm.words import Words


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:])))  # noqa: B905


def brute(words, min_length=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    for (start, length), q in found.items():
        assert smallest_period(words[start : start + length]) == q
    return sorted((s, n, q) for (s, n), q in found.items())


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(rng, n):
    out = []
    for _ in range(n):
        words = []
        while rng.random() < 0.85:
            block = rng.choices("abc"[: rng.randint(1, 3)], k=rng.randint(1, 7))
            words += block * rng.choice([1, 1, 2, 3, 4, 5, 9]) + block[: rng.randint(0, len(block))]
        out.append(words)
    return out


def runs_of(texts, min_length=6, exponent=4):
    words = Words(pa.array([" ".join(t) for t in texts], type=pa.string()))
    starts, lengths, periods = find_runs(word_numbers(words), words.row_of, words.rows, min_length, exponent)
    out = [[] for _ in texts]
    for s, n, q in zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True):
        r = int(words.row_of[s])
        out[r].append((s - int(words.rows[r]), n, q))
    return out


@pytest.mark.parametrize("seed,min_length,exponent", [(1, 6, 4), (2, 1, 2), (3, 10, 3), (4, 6, 5)])
def test_runs_equal_brute_force(seed, min_length, exponent):
    texts = some_texts(random.Random(seed), 300) + [[], ["a"], ["a"] * 50, ["a", "b"] * 40 + ["a"]]
    assert runs_of(texts, min_length, exponent) == [brute(t, min_length, exponent) for t in texts]


def test_words_that_repeat_without_runs():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = "a"
    while len(morse) < 600:
        morse += morse.translate(str.maketrans("ab", "ba"))
    texts = [list(fibonacci[-1]), list(morse), list("aaaaab" * 30), list("ab" * 100 + "c" + "ab" * 100)]
    for exponent in (2, 3, 4):
        assert runs_of(texts, 2, exponent) == [brute(t, 2, exponent) for t in texts]


def test_suffixes_are_sorted_as_far_as_wanted():
    rng = random.Random(7)
    codes = np.array(rng.choices(range(3), k=400))
    ends = np.full(400, 400)
    suffixes = SuffixArray(codes, np.zeros(400, dtype=np.int64), ends, 2)
    order = sorted(range(400), key=lambda i: codes[i:].tolist())
    assert suffixes.array.tolist() == order
    shared = [next((k for k, (x, y) in enumerate(zip(codes[i:], codes[j:])) if x != y), 400 - max(i, j)) for i, j in zip(order, order[1:])]  # noqa: B905
    assert suffixes.lcp[1:-1].tolist() == shared


def test_very_long_texts():
    rng = random.Random(8)
    hot = ["x"] * 200_000
    tail = [f"w{i}" for i in range(30_000)]
    mixed = rng.choices([f"v{i}" for i in range(50)], k=100_000)
    got = runs_of([hot, tail * 5 + tail[:77], mixed + ["p", "q"] * 1000])
    assert got[0] == [(0, 200_000, 1)] and got[1] == [(0, 150_077, 30_000)]
    assert got[2][-1] == (100_000, 2000, 2)


def test_whole_rows(awkward, nothing):
    rows = {(r["id"], r["n_words"], r["kept"]): r["runs"] for r in periodic_runs(awkward).collect()}
    assert len(rows) == len({(r["doc_id"], r["text"] or "") for r in awkward.collect()})
    for source in awkward.collect():
        words = [w.decode() for w in (source["text"] or "").encode().split()]
        runs = brute(words) if len(words) < 1000 else []
        assert [tuple(r) for r in rows[source["doc_id"], len(words), kept(words, runs)]] == runs
    assert rows[9, 400, "x"] == [(0, 400, 1)]
    assert periodic_runs(nothing).count() == 0


def test_exponent_of_two_at_least(awkward):
    with pytest.raises(ValueError):
        periodic_runs(awkward, min_exponent=1)


def with_tail(doc_id, words):
    """Words with the query's repeated tail, and the run it makes of long texts without repeats."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words, None
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)], (a, n - a, p) if n - a >= max(6, 4 * p) else None


def test_query_on_awkward_rows(spark, awkward, nothing, folder):
    awkward.write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op11_periodic_run_detection"](spark, folder).collect()
    expected = []
    for row in awkward.collect():
        words, tail = with_tail(row["doc_id"], [w.decode() for w in (row["text"] or "").encode().split()])
        runs = brute(words) if len(words) < 1000 else [tail] if tail else []
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept(words, runs))]
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        expected.append((row["doc_id"], len(runs), *longest, *sha))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert any(r["n_runs"] and r["length"] > 50_000 for r in got)
    nothing.write.parquet(f"{folder}/none/documents.parquet")
    assert QUERIES["op11_periodic_run_detection"](spark, f"{folder}/none").count() == 0

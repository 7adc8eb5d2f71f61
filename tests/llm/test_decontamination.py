import hashlib
import re

import pytest

from shelfscan.llm.decontamination import clean_rows, contamination, phrase_matches, proximity_matches

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(PATTERN, lowered)


def windows(text, width=10):
    w = tokens(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, items):
    out = []
    for i, text in rows:
        w = tokens(text)
        hit, found = [False] * len(w), set()
        for item, body in items:
            for win in windows(body):
                for s in range(len(w) - len(win) + 1):
                    if tuple(w[s : s + len(win)]) == win:
                        hit[s : s + len(win)] = [True] * len(win)
                        if item is not None:
                            found.add(str(item))
        out.append((i, len(w), sum(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def items(spark):
    passage = " ".join(f"SHARED{i} phrase{i % 7}" for i in range(12))
    rows = [(1, passage), (2, "second LINE, here"), (3, None), (4, " .,! "), (None, "alpha beta"), (5, "one"), (5, "漢字 かな"), (1, passage), (6, "x x x x x x x x x x x x")]
    return spark.createDataFrame([(i, t, "docs", 1) for i, t in rows], "item_id long, text string, id string, tokens int")


def test_awkward_rows_equal_brute_force(awkward, items, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    expected = brute(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    got = [(r["id"], r["n_words"], r["n_hit"], r["items"]) for r in contamination(awkward, items).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(r[2] for r in expected) > 400
    kept = clean_rows(awkward, items)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(not r[2] for r in expected)
    assert contamination(nothing, items).collect() == []
    assert all(r["n_hit"] == 0 for r in contamination(awkward, items.where("false")).collect())


def test_phrases_have_positions(spark, items):
    docs = spark.createDataFrame([(1, "A second line here and second-line HERE")], "doc_id long, text string")
    found = sorted((r["start"], r["length"], r["item"]) for r in phrase_matches(docs, items).collect())
    assert found == [(1, 3, 2), (5, 3, 2)]


def test_proximity_takes_any_order_within_reach(spark):
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    texts = ["blue then green and red", "red " + "pad " * 30 + "green blue", "red green"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["id"] for r in proximity_matches(docs, items, slop=0).collect()} == {0}
    assert {r["id"] for r in proximity_matches(docs, items, slop=25).collect()} == {0, 1}
    assert phrase_matches(docs, items).collect() == []


def test_query_digest(spark):
    from shelfscan.llm.op4_query import decontamination

    row = decontamination(spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest() and not row["contaminated"]

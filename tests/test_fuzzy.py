import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscan.functions.similarity import CharacterBags, similarities, sorted_tokens
from shelfscan.operators import fuzzy

WORDS = ["red", "blue", "widget", "gear", "gearr", "bolt", "small", "smal", "large", "rod", "12kg", "500gm"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b):
            previous, row[j + 1] = row[j + 1], previous + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def similarity(a, b):
    a, b = sorted_tokens(a), sorted_tokens(b)
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def some_names(rng, n):
    return sorted({" ".join(rng.choices(WORDS, k=rng.randint(1, 5))) for _ in range(n)})


def test_scores_equal_dynamic_programming():
    rng = random.Random(1)
    names = some_names(rng, 40) + ["x" * 70 + " " + "ab" * 50, "é ü", "a", "b" * 64, "c" * 65 + "ab", "", "zzz", "ab" * 100]
    pairs = [(a, b) for a in names for b in names]
    assert list(similarities(*map(list, zip(*pairs, strict=True)))) == [similarity(a, b) for a, b in pairs]
    assert list(similarities([], [])) == []


def greedy(listings, cutoff=55):
    """The definition, one name at a time."""
    names = {}
    for store, name in listings:
        names.setdefault(store, {}).setdefault(name, 0)
        names[store][name] += 1
    order = {s: sorted(c, key=lambda n: -c[n]) for s, c in names.items()}
    stores, taken, links = list(names), set(), set()
    for i, a in enumerate(stores):
        for b in stores[i + 1 :]:
            for name in order[a]:
                usable = [n for n in order[b] if (b, n) not in taken and similarity(name, n) >= cutoff]
                if (a, name) not in taken and usable:
                    best = max(usable, key=lambda other: similarity(name, other))
                    taken |= {(a, name), (b, best)}
                    links.add((a, name, b, best))
    return links


def frame(spark, listings):
    rows = [(s, n, (i,), None, None) for i, (s, n) in enumerate(listings)]
    return spark.createDataFrame(
        rows,
        "store_key STRING, product_name_clean STRING, row_ord STRUCT<row: INT>, match_group STRING, match_pass INT",
    )


def linked(spark, listings, cutoff=55, k=fuzzy.LIST):
    links = fuzzy.fuzzy_links(fuzzy.unmatched_names(frame(spark, listings)), cutoff, k)
    rows = links.select("store_a", "name_a", "store_b", "name_b", "score").collect()
    assert all(abs(r["score"] - similarity(r["name_a"], r["name_b"])) < 1e-9 for r in rows)
    return {tuple(r)[:4] for r in rows}


@pytest.mark.parametrize("seed,cutoff,k", [(3, 55, 48), (4, 55, 2), (5, 80, 1)])
def test_links_equal_the_greedy_definition(spark, seed, cutoff, k):
    """Short lists end again and again, so that names search a second time."""
    rng = random.Random(seed)
    listings = [(s, n) for s in ("s2", "s1", "s3", "s4") for n in some_names(rng, 30) for _ in range(rng.randint(1, 2))]
    assert linked(spark, listings, cutoff, k) == greedy(listings, cutoff)


def test_links_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BLOCK", 7)
    rng = random.Random(6)
    listings = sorted({(s, n) for s in ("s1", "s2") for n in some_names(rng, 80)}) + [("s2", "x" * 90), ("s1", "x" * 80 + "yy"), ("s1", " "), ("s2", "")]
    assert linked(spark, listings, k=5) == greedy(listings)


def test_links_over_turns_of_few_names(spark, monkeypatch):
    """What a turn has taken is not offered to the next one."""
    monkeypatch.setattr(fuzzy, "TURN", 16)
    offers = []
    settled = fuzzy._settled
    monkeypatch.setattr(fuzzy, "_settled", lambda asking, offered, *more: offers.append((asking.count(), offered.count())) or settled(asking, offered, *more))
    rng = random.Random(8)
    listings = [(s, n) for s in ("s1", "s2") for n in some_names(rng, 30)]
    assert linked(spark, listings, k=3) == greedy(listings)
    assert len(offers) >= 2 and all(asking <= 16 for asking, _ in offers)
    assert all(later < earlier for (_, earlier), (_, later) in zip(offers, offers[1:], strict=False))


def test_one_store_or_none(spark):
    assert linked(spark, [("s1", "red bolt")]) == set() and linked(spark, []) == set()
    assert fuzzy.best_scores(fuzzy.unmatched_names(frame(spark, [("s1", "red bolt")]))).count() == 0


def test_best_scores_equal_all_pairs(spark):
    rng = random.Random(9)
    listings = sorted({(s, n) for s in ("s1", "s2", "s3") for n in some_names(rng, 60)}) + [("s3", "  "), ("s2", "é" * 70)]
    names = fuzzy.unmatched_names(frame(spark, listings))
    got = {tuple(r) for r in fuzzy.best_scores(names).select("store_a", "name_a", "store_b", "name_b").collect()}
    every = set()
    for s, a in set(listings):
        for t in {t for t, _ in listings if t > s}:
            near = sorted((-similarity(a, b), b) for u, b in set(listings) if u == t)
            if near and near[0][0] <= -55:
                every.add((s, a, t, near[0][1]))
    assert got == every


def test_bounds_are_never_below_the_similarity():
    rng = random.Random(10)
    names = [sorted_tokens(n) for n in [*some_names(rng, 60), "a" * 30, "aab" * 9, "", "é ü ö", "漢字 " * 20, "b" * 70]]
    bags = CharacterBags(names)
    bound = bags.bounds(bags)
    assert all(bound[i, j] >= similarity(a, b) for i, a in enumerate(names) for j, b in enumerate(names))


def test_bounds_by_neighbouring_characters_are_never_below_the_similarity():
    rng = random.Random(11)
    names = [sorted_tokens(n) for n in [*some_names(rng, 60), "a" * 30, "abab" * 9, "", "x", "é ü ö", "漢字 " * 20, "b" * 70]]
    bags = CharacterBags(names)
    rows, columns = (np.repeat(np.arange(len(names)), len(names)), np.tile(np.arange(len(names)), len(names)))
    bound = bags.pair_bounds(bags, rows, columns).reshape(len(names), -1)
    assert all(bound[i, j] >= similarity(a, b) for i, a in enumerate(names) for j, b in enumerate(names))
    least = np.array([rng.choice([0.0, 55.0, 80.0, 100.0]) for _ in names])
    margin = bags.margins(bags, least)
    assert all(margin[i, j] >= 0 for i, a in enumerate(names) for j, b in enumerate(names) if similarity(a, b) >= least[i])


def test_no_product_of_all_names_in_the_plan(spark):
    listings = [(s, n) for s in ("s1", "s2") for n in some_names(random.Random(1), 20)]
    names = fuzzy.unmatched_names(frame(spark, listings)).select(F.lit(0).alias("pair"), "id", "name")
    plan = fuzzy.best_partners(names, names.withColumn("holder", F.lit(None).cast("bigint")))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_boost_leaves_matched_rows_alone(spark):
    listings = [("s1", "red widgett"), ("s2", "red widget"), ("s1", "blue gear"), ("s2", "blue gearr")]
    rows = frame(spark, listings)
    matched = rows.withColumn("match_group", F.lit("g")).withColumn("match_pass", F.lit(1))
    assert fuzzy.fuzzy_boost(matched).filter("match_pass = 4").count() == 0
    boosted = fuzzy.fuzzy_boost(rows.unionByName(matched)).filter("match_pass = 4")
    groups = {tuple(sorted(r["n"])) for r in boosted.groupBy("match_group").agg(F.collect_list("product_name_clean").alias("n")).collect()}
    assert groups == {("red widget", "red widgett"), ("blue gear", "blue gearr")}


def test_boost_links_names_that_share_no_word(spark):
    listings = [
        ("s1", "red widgett"), ("s2", "red widget"), ("s1", "lux soap"), ("s2", "lux soaps"), ("s1", "coca cola 1.5 l"), ("s2", "cocacola 1.5 l"),
        ("s1", "dalda cooking oil"), ("s2", "dalda cookng oil 5l"), ("s1", "toothbrush"), ("s2", "tooth-brush"),
    ]
    boosted = fuzzy.fuzzy_boost(frame(spark, listings)).filter("match_pass = 4")
    groups = {frozenset(r["n"]) for r in boosted.groupBy("match_group").agg(F.collect_list("product_name_clean").alias("n")).collect()}
    assert groups == {frozenset(n for _, n in listings[i : i + 2]) for i in range(0, len(listings), 2)}


def test_names_of_a_block_that_want_the_same_are_settled_together(spark, monkeypatch):
    """200 names with one list in common: one at a time would need as many rounds."""
    rounds = []
    asked = fuzzy._asked
    monkeypatch.setattr(fuzzy, "_asked", lambda state: rounds.append(1) or asked(state))
    listings = [(s, f"red widget number {i:03d}") for s in ("s1", "s2") for i in range(200)]
    listings = [(s, n.replace("number", "same") if s == "s1" else n) for s, n in listings]
    got = linked(spark, listings, k=200)
    assert len(got) == 200 and got == greedy(listings)
    assert len(rounds) <= 4

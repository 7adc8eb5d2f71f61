import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfscan.operators import clean, correlation, dedup, dispersion, leaders, match, quality, sketches, stats, stores, views


def listings(spark, rows):
    """(store, city, category, name, price) rows in order."""
    return spark.createDataFrame(
        [(*r, None, (i,)) for i, r in enumerate(rows)],
        "store_key STRING, city STRING, category STRING, product_name STRING, price DOUBLE, old_price DOUBLE, row_ord STRUCT<row: INT>",
    )


def matched_rows(spark, rows):
    keyed = match.with_match_keys(clean.clean_listings(listings(spark, rows)))
    return match.match_listings(keyed)


def test_keep_first_is_independent_of_partitioning(spark):
    rows = [("a", "x", "c", "n", 1.0), ("a", "x", "d", "n", 1.0), (None, "x", "e", "n", 1.0), (None, "x", "f", "n", 1.0)]
    for parts in (1, 4):
        kept = dedup.dedup(listings(spark, rows).repartition(parts)).select("category").collect()
        assert sorted(r[0] for r in kept) == ["c", "e"]


def test_dedup_prunes_before_the_shuffle(spark):
    plan = dedup.dedup(listings(spark, [("a", "x", "c", "n", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.rindex("Partial") > plan.index("Exchange hashpartitioning")


def test_new_names_and_first_wins_merge(spark):
    old = listings(spark, [("a", "x", "c", " Tea ", 1.0)])
    new = listings(spark, [("a", "x", "c", "TEA", 2.0), ("a", "x", "c", "Milk", 3.0), ("a", "x", "c", "milk ", 4.0), ("a", "x", "c", " ", 4.0)])
    assert [r["price"] for r in dedup.new_names_only(new, old).collect()] == [3.0]
    again = listings(spark, [("a", "x", "c", " Tea ", 9.0), ("a", "y", "c", " Tea ", 8.0)])
    assert sorted(r["price"] for r in dedup.merge_first_wins(old, again).collect()) == [1.0, 8.0]


def test_rejections_and_cleaning_agree(spark):
    rows = [("a", "x", "c", "Tea 1kg", 5.0)] * 3 + [("a", "x", "c", "hot", 5.0), ("a", "x", "c", "Milk", -1.0), ("a", "x", "c", "Rice", None), ("a", "x", "c", "Gold", 1e6), ("a", "x", "c", None, 3.0), ("a", "x", "c", "Oil", float("nan"))]
    raw = listings(spark, rows)
    report = clean.rejection_counts(raw).first().asDict()
    assert report == {"raw_rows": 9, "duplicates": 2, "empty_names": 2, "invalid_prices": 3, "prices_too_high": 1, "clean_rows": 1}
    assert clean.clean_listings(raw).count() == 1


def test_names_filter_stays_above_the_dedup(spark):
    plan = clean.clean_listings(listings(spark, [("a", "x", "c", "n", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2


def test_three_passes(spark):
    tail = [("s1", "x", "c", f"Acme red big round ball kind{i} 5kg", 10.0 + i) for i in range(2)]
    rows = [
        ("s1", "x", "c", "Acme red ball 5kg", 10.0), ("s2", "x", "c", "ACME Red ball 5 kg", 12.0), ("s2", "y", "c", "Acme red ball 5kg", 11.0),
        ("s1", "x", "c", "Acme blue ball 1kg", 10.0), ("s2", "x", "c", "Acme blue ball 1000g", 12.0),
        *tail, ("s2", "x", "c", "Acme red big round ball odd 7kg", 12.0),
        ("s1", "x", "c", "Solo thing 1kg", 10.0), ("s1", "y", "c", "Solo thing 1kg", 10.0), ("s1", "x", "c", "abc", 1.0), ("s2", "x", "c", "abc", 1.0),
        ("s3", "x", "c", "Acme red ball 9kg", 10.0),
    ]
    result = matched_rows(spark, rows).collect()
    groups = {}
    for r in result:
        groups.setdefault(r["match_group"], []).append(r)
    assert {g: len(v) for g, v in groups.items()} == {"p1:acme_red_ball_5_kg": 3, "p2:acme_blue_ball": 2, "p3:acme_red_big_round": 3, None: 5}
    assert all(len({r["store_key"] for r in v}) > 1 for g, v in groups.items() if g)
    # a leftover never joins a group an earlier pass made
    assert [r["match_group"] for r in result if r["product_name"] == "Acme red ball 9kg"] == [None]
    coverage = {r["match_pass"]: (r["num_groups"], r["num_rows"]) for r in match.coverage_by_pass(matched_rows(spark, rows)).collect()}
    assert coverage == {0: (0, 5), 1: (1, 3), 2: (1, 2), 3: (1, 3)}


def group_rows(spark, rows):
    """(group, store, city, category, name, brand, price, size)"""
    return spark.createDataFrame(
        [(*r, None, None, (i,)) for i, r in enumerate(rows)],
        "match_group STRING, store_key STRING, city STRING, category STRING, product_name_clean STRING, brand STRING, price DOUBLE, qty_normalized DOUBLE, quantity DOUBLE, unit STRING, row_ord STRUCT<row: INT>",
    )


def test_profile_edge_cases(spark):
    rows = [
        ("one", "s1", "x", None, "n", "B", 10.0, None),
        ("tie", "s2", "x", "c", "late", "B", 5.0, None), ("tie", "s1", "x", "c", "early", "B", 5.0, 3.0),
    ]
    profile = {r["match_group"]: r for r in dispersion.group_profile(group_rows(spark, rows)).collect()}
    assert profile["one"]["cv"] is None and profile["one"]["price_spread_ratio"] == 1.0 and profile["one"]["category"] is None
    assert profile["tie"]["cheapest_store"] == "s2" and profile["tie"]["product"] == "late" and profile["tie"]["qty_normalized"] == 3.0
    assert profile["tie"]["cv"] == 0.0 and profile["tie"]["num_stores"] == 2
    categories = dispersion.category_dispersion(dispersion.group_profile(group_rows(spark, rows))).collect()
    assert [r["category"] for r in categories] == ["c"]
    positions = {r["match_group"]: r["rppi"] for r in dispersion.price_positions(group_rows(spark, rows)).collect()}
    assert positions == {"one": None, "tie": 1.0}


def test_leader_shares(spark):
    rows = [(f"g{i}", s, "x", f"c{i % 2}", "n", "B", p, None) for i in range(5) for s, p in (("s1", 5.0 + i), ("s2", 6.0), ("s3", 9.0))]
    matched = group_rows(spark, rows)
    profile = dispersion.group_profile(matched)
    basic = {r["store_key"]: r["ldi"] for r in leaders.leader_counts(profile).collect()}
    weighted = {r["store_key"]: r["weighted_ldi"] for r in leaders.weighted_leader_shares(profile).collect()}
    assert basic == weighted == {"s1": 0.4, "s2": 0.6} and sum(basic.values()) == pytest.approx(1)
    grid = leaders.category_leader_shares(profile, matched).collect()
    assert len(grid) == 6
    assert {(r["category"], r["total_in_category"]) for r in grid if r["store_key"] == "s3"} == {("c0", 0), ("c1", 0)}
    assert {r["store_key"]: r["times_cheapest"] for r in leaders.times_cheapest(profile).collect()} == {"s1": 6, "s2": 9}


def test_quantiles_and_ranks_are_exact_under_skew(spark):
    rng = random.Random(5)
    values = [("hot", rng.choice([-3.5, 0.0, 7.25, 7.25, 100.0, rng.uniform(-10, 1e4)])) for _ in range(3000)] + [("cold", 1.0), ("one", 4.0), ("cold", 2.0), ("cold", None)]
    df = spark.createDataFrame(values, "k STRING, v DOUBLE")
    got = {r["k"]: r for r in stats.quantiles(df, ["k"], "v", {"q1": 0.25, "m": 0.5, "top": 1.0, "low": 0.0}).collect()}
    hot = [v for k, v in values if k == "hot"]
    assert got["hot"]["m"] == pytest.approx(statistics.median(hot))
    assert got["hot"]["q1"] == pytest.approx(statistics.quantiles(hot, n=4, method="inclusive")[0])
    assert (got["hot"]["low"], got["hot"]["top"]) == (min(hot), max(hot))
    assert got["cold"]["m"] == 1.5 and got["one"]["q1"] == 4.0
    ranks = {r["v"]: r["rank"] for r in stats.average_ranks(df.filter("k = 'hot'"), ["k"], "v", "rank").collect()}
    order = sorted(hot)
    assert all(rank == order.index(v) + (order.count(v) + 1) / 2 for v, rank in ranks.items())
    whole = stats.quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert whole == pytest.approx(statistics.median([v for _, v in values if v is not None]))


def test_pairs_are_correlated_without_a_join(spark):
    rows = [(f"g{g}", f"s{s}", float((g * 7 + s * s * g) % 23 + 1)) for g in range(30) for s in range(4) if (g + s) % 5]
    matched = spark.createDataFrame(rows, "match_group string, store_key string, price double")
    pairs = correlation.pairwise(matched, "store_key", spearman=False)
    assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    means = pd.DataFrame(rows, columns=["g", "s", "p"]).pivot(index="g", columns="s", values="p")
    for method in ("pearson", "spearman"):
        expected = means.corr(method=method)
        got = correlation.pairwise(matched, "store_key").collect()
        assert len(got) == 6 and all(abs(r[method] - expected.loc[r["a"], r["b"]]) < 1e-9 for r in got)


def test_zero_variance_correlation_is_null(spark):
    rows = [(f"g{i}", s, "x", "c", "n", "B", 5.0, None) for i in range(12) for s in ("s1", "s2")]
    pairs = correlation.pairwise(group_rows(spark, rows), "store_key").collect()
    assert [(r["a"], r["b"], r["n"], r["pearson"]) for r in pairs] == [("s1", "s2", 12, None)]
    few = correlation.pairwise(group_rows(spark, rows[:8]), "store_key").collect()
    assert few == []


def test_quality_and_views(spark):
    raw = listings(spark, [("a", "x", "c", "Red (tea)", 5.0), ("a", "x", "c", "red tea", 6.0), ("b", "y", None, "Milk", 7.0), ("b", "y", None, "Milk", 7.0)])
    rows = raw.withColumn("product_name_clean", F.col("product_name")).withColumn("brand", F.lit("B"))
    assert dedup.unique_per_store(raw, "offer").filter("store_key = 'b'").first()["unique_rows"] == 1
    dup = quality.duplicates(raw).first()
    assert (dup["exact_duplicates"], dup["near_duplicates"]) == (1, 1)
    missing = {r["column_name"]: (r["missing"], r["status"]) for r in quality.missing_values(raw, ("category", "price", "nope")).collect()}
    assert missing == {"category": (2, "BAD"), "price": (0, "OK"), "nope": (None, "NOT FOUND")}
    counts = {r["layer"]: (r["num_rows"], r["status"]) for r in quality.row_counts({"raw": raw, "none": None}).collect()}
    assert counts == {"raw": (4, "WARN"), "none": (0, None)}
    assert views.search(rows, "RED .?tea").count() == 2 and views.search(rows, "(tea)", literal=True).count() == 1
    assert [r["price"] for r in views.cheapest_hits(views.search(rows, "red"), 1).collect()] == [5.0]
    cross = {r["store_key"]: (r["x"], r["y"]) for r in views.crosstab(raw).collect()}
    assert cross == {"a": (2, 0), "b": (0, 2)}
    assert stores.averages(raw, "store_key").count() == 2
    assert dispersion.histogram(raw, "price", 4).agg(F.sum("num_values")).first()[0] == 4
    same = dispersion.histogram(raw.filter("store_key = 'b'"), "price", 4).agg(F.min("bin_lo"), F.max("bin_hi"), F.sum("num_values")).first()
    assert tuple(same) == (6.5, 7.5, 2)
    copies = clean.replicate_cities(raw.filter("store_key = 'a'"), ["x", "z"], raw)
    assert {r["city"] for r in copies.collect()} == {"z"} and copies.count() == 2


def test_hot_key_results_are_whole(spark):
    """A third of all rows under one key, one group, one price and one duplicate."""
    base = spark.range(9000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 's1' ELSE 's2' END AS store_key", "concat('city', id % 7) AS city", "'c' AS category",
        "CASE WHEN id < 3000 THEN 'Acme red ball 5kg' ELSE concat('Acme thing w', id DIV 3, ' 5kg') END AS product_name",
        "CASE WHEN id < 1500 THEN 10.0D ELSE 10 + id % 1000 / 100 END AS price", "cast(null AS double) AS old_price", "struct(id AS row) AS row_ord",
    )
    kept = {}
    for r in base.orderBy("row_ord").collect():
        kept.setdefault((r["store_key"], r["city"], r["product_name"], r["price"]), r)
    rows = match.match_listings(match.with_match_keys(clean.clean_listings(base)))
    assert rows.count() == len(kept)
    hot = [r["price"] for r in kept.values() if r["product_name"] == "Acme red ball 5kg"]
    group = dispersion.group_profile(match.matched_only(rows)).filter("match_group = 'p1:acme_red_ball_5_kg'").first()
    assert (group["num_rows"], group["num_stores"], group["num_cities"]) == (len(hot), 2, 7)
    assert group["median_price"] == pytest.approx(statistics.median(hot)) and group["std_price"] == pytest.approx(statistics.stdev(hot))
    first = kept[("s1", "city0", "Acme red ball 5kg", 10.0)]
    assert first["row_ord"]["row"] == 0


def test_quantiles_scan_their_input_once(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "cast(id AS double) AS v")
    plan = stats.quantiles(df, ["k"], "v", {"m": 0.5})
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text


def test_repeated_rows_are_compared_whole(spark):
    rows = [(1, None, "a"), (None, 1, "a"), (1, 1, "a"), (1, 1, "a"), (1, 1, None), (1, 1, None), (1, 1, None), (2, None, "b")]
    df = spark.createDataFrame(rows, "x INT, y INT, z STRING")
    counted = quality.repeated_rows(df)
    assert counted.first()[0] == 3 and quality.repeated_rows(df.limit(0)).first()[0] == 0
    # whole rows are not shuffled while few digests meet: they are joined where they are
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_policies_and_new_names_in_one_pass(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice(["s", "t"]), rng.choice("xy"), rng.choice(["Tea", " tea", "Oil", "Rice", "", None]), rng.choice([1.0, 2.0, None]), rng.choice(["1", "2", None]), rng.random() < 0.2, (i,))
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "store_key STRING, city STRING, product_name STRING, price DOUBLE, sku STRING, old BOOLEAN, row_ord STRUCT<n: INT>")
    policies = ("listing", "listing_any_price", "offer", "item")
    got = {r["store_key"]: r.asDict() for r in dedup.unique_by_policy(df, policies).collect()}
    for policy in policies:
        for r in dedup.unique_per_store(df, policy).collect():
            assert (got[r["store_key"]]["num_rows"], got[r["store_key"]][policy]) == (r["num_rows"], r["unique_rows"])
    two = dedup.new_names_only(df.filter("NOT old"), df.filter("old")).collect()
    one = dedup.first_new_names(df, F.col("old")).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    plan = dedup.first_new_names(df, F.col("old"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_sketches_merge_within_their_error(spark):
    generator = random.Random(4)
    rows = [(f"s{i % 3}", f"c{i % 7 % 4}", generator.choice([1.0, generator.lognormvariate(3, 1), None])) for i in range(30_000)]
    rows += [("s0", "c9", None), ("s3", "c0", 5.0), ("s4", "c0", float("nan"))]
    prices = spark.createDataFrame(rows, "store_key string, city string, price double")
    parts = sketches.price_sketches(prices)
    for by in (["store_key"], []):
        found = sketches.sketched_quantiles(sketches.merged(parts, by), by)
        got = {tuple(r[b] for b in by): r for r in found.collect()}
        for key, r in got.items():
            known = sorted(p for *place, p in rows if p is not None and p == p and (not by or place[0] == key[0]))
            assert r["num_values"] == len(known)
            for name, share in sketches.QUARTERS.items():
                below, upto = (sum(test) / len(known) for test in ((p < r[name] for p in known), (p <= r[name] for p in known)))
                assert below - sketches.RANK_ERROR <= share <= upto + sketches.RANK_ERROR
        assert set(got) == ({("s0",), ("s1",), ("s2",), ("s3",)} if by else {()})
    errors = sketches.rank_errors(prices, sketches.sketched_quantiles(sketches.merged(parts, ["store_key"]), ["store_key"]), ["store_key"]).collect()
    assert len(errors) == 4 and all(0 <= r[q] <= sketches.RANK_ERROR for r in errors for q in sketches.QUARTERS)
    assert sketches.price_sketches(prices.limit(0)).collect() == []


def test_policies_within_another_count_its_keys(spark, capsys):
    """Rows make keys of the wide policies only; with nulls and repeats the counts are those of each policy alone."""
    from shelfscan.operators import dedup

    names = ("listing", "listing_any_price", "offer", "item")
    rows = [("s1" if i % 3 else None, "c" if i % 2 else None, f"n{i % 5}" if i % 7 else None, float(i % 4) if i % 5 else None, i % 6 or None) for i in range(200)]
    df = spark.createDataFrame(rows, "store_key STRING, city STRING, product_name STRING, price DOUBLE, sku INT")
    out = dedup.unique_by_policy(df, names)
    place = {c: n for n, c in enumerate(df.columns)}
    for row in out.collect():
        own = [r for r in rows if r[0] == row["store_key"]]
        assert row["num_rows"] == len(own)
        for p in names:
            assert row[p] == len({tuple(r[place[k]] for k in dedup.POLICIES[p]) for r in own}), p
    assert out.count() == 2 and dedup.unique_by_policy(df.limit(0), names).collect() == []
    capsys.readouterr()
    out.explain()
    plan = capsys.readouterr().out
    assert "listing_any_price" not in plan[plan.rindex("Generate") :]


def test_a_cleaning_calls_the_normalising_function_once(spark):
    """Each of both cleanings (before and after the promo words go) holds one call of the UDF, not one for every mention."""
    plan = clean.clean_names(listings(spark, [("a", "x", "c", "n", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "pythonUDF0" in plan and "pythonUDF1" not in plan


def test_listings_meet_their_orders_before_their_parts(spark, folder):
    """Only the last large shuffle holds the names of parts."""
    from shelfscan.sources.listings import listings as derived

    tables = {
        "lineitem": "1L l_orderkey, 1 l_linenumber, 1L l_partkey, 1L l_suppkey, 0.06D l_discount",
        "orders": "1L o_orderkey, 1L o_custkey, timestamp'2024-01-01' o_orderdate", "customer": "1L c_custkey, 'BUILDING' c_mktsegment",
        "part": "1L p_partkey, 'red gear' p_name, 'Brand#11' p_brand, 'SMALL TIN' p_type, 5 p_size, 10D p_retailprice",
        "supplier": "1L s_suppkey, 1 s_nationkey", "nation": "1 n_nationkey, 1 n_regionkey", "region": "1 r_regionkey, 'ASIA' r_name",
    }
    for name, columns in tables.items():
        spark.sql(f"SELECT {columns}").write.parquet(f"{folder}/{name}.parquet")
    found = derived(spark, folder)
    assert [(r["store_key"], r["city"], r["category"], r["sku"]) for r in found.collect()] == [("asia", "building", "small tin", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    orders = next(line for line in plan.splitlines() if "Join Inner, (l_orderkey" in line)
    parts = next(line for line in plan.splitlines() if "Join Inner, (l_partkey" in line)
    assert orders.index("Join") > parts.index("Join")

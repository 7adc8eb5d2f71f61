"""Correlations: size, competitors and brand tier against dispersion; cities and stores pairwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.numbers import correlation_verdict, round_half_up, tier, tier_code
from shelfscan.operators.stats import correlate, quantiles
from shelfscan.sources.staging import stage

MIN_OBSERVATIONS = 10


def _reported(pair: DataFrame, name: str, at_least: int = MIN_OBSERVATIONS) -> DataFrame:
    enough = F.col("n") > at_least
    return pair.select(
        F.lit(name).alias("metric"),
        "n",
        F.when(enough, round_half_up(F.col("pearson"), 4)).alias("pearson"),
        F.when(enough, round_half_up(F.col("spearman"), 4)).alias("spearman"),
        F.when(enough, correlation_verdict(F.col("pearson"))).alias("verdict"),
    )


def size_vs_cv(profile: DataFrame) -> DataFrame:
    return _reported(correlate(profile, "qty_normalized", "cv"), "size_vs_cv")


def competitors_vs_range(profile: DataFrame) -> DataFrame:
    complete = profile.na.drop(subset=["num_stores", "price_range", "cv", "price_spread_ratio"])
    return _reported(correlate(complete, "num_stores", "price_range"), "competitors_vs_spread")


def brand_tiers(matched: DataFrame) -> DataFrame:
    """Brand, its mean price and its tier by the 33rd and 66th percentile of brand means."""
    means = stage(
        matched.filter("brand IS NOT NULL").groupBy("brand").agg(F.avg("price").alias("brand_mean")), "brand-means"
    )
    bounds = stage(quantiles(means, [], "brand_mean", {"q33": 0.33, "q66": 0.66}), "tier-bounds")
    q33, q66 = bounds.select("q33").scalar(), bounds.select("q66").scalar()
    return means.select("brand", "brand_mean", tier(F.col("brand_mean"), q33, q66).alias("brand_tier"))


def with_tiers(profile: DataFrame, tiers: DataFrame) -> DataFrame:
    """Groups with the tier of their brand; groups of unknown brands are dropped."""
    return profile.join(tiers.select("brand", "brand_tier"), "brand").withColumn(
        "tier_numeric", tier_code(F.col("brand_tier"))
    )


def tier_vs_cv(tiered: DataFrame) -> DataFrame:
    return _reported(correlate(tiered, "tier_numeric", "cv"), "brand_tier_vs_cv")


def tier_statistics(tiered: DataFrame) -> DataFrame:
    moments = tiered.groupBy("brand_tier").agg(F.avg("cv").alias("mean"), F.stddev_samp("cv").alias("std"))
    medians = quantiles(tiered, ["brand_tier"], "cv", {"median": 0.5})
    return moments.join(medians, "brand_tier").select(
        "brand_tier",
        *[round_half_up(F.col(c), 2).alias(f"{c}_cv") for c in ("mean", "median", "std")],
    )


def pairwise(matched: DataFrame, dim: str, spearman: bool = True) -> DataFrame:
    """Correlation of group mean prices for every pair of cities or stores, over groups both have.

    A group is one sparse vector of means, sorted by ``dim``. Its pairs are laid out beside the moments they go
    into, which are combined before the shuffle: no join, and what is shuffled is a row per pair of cities or
    stores and task. Ranks are per pair, for every pair has its own complete cases. Empty unless
    more than ten groups have two or more values. Means are rounded to six decimals, so that equal
    means tie in the ranks whatever the order they were summed in.
    """
    means = (
        matched.filter(F.col(dim).isNotNull() & F.col("match_group").isNotNull())
        .groupBy("match_group", dim)
        .agg(round_half_up(F.avg("price"), 6).alias("mean_price"))
    )
    entry = F.struct(F.col(dim).alias("at"), F.col("mean_price").alias("mean"))
    vectors = stage(
        means.groupBy("match_group").agg(F.array_sort(F.collect_list(entry)).alias("v")).select("v").filter(F.size("v") >= 2),
        "mean-vectors",
    )
    wide = vectors.agg(F.count("*")).scalar()
    firsts = vectors.filter(wide > MIN_OBSERVATIONS).select("v", F.posexplode("v").alias("i", "x"))
    pairs = firsts.select("x", F.explode(F.slice("v", F.col("i") + 2, F.size("v"))).alias("y")).select(
        F.col("x.at").alias("a"), F.col("y.at").alias("b"), F.col("x.mean").alias("price_a"), F.col("y.mean").alias("price_b")
    )
    return correlate(pairs, "price_a", "price_b", ["a", "b"], spearman, stored=True)


def matrix(pairs: DataFrame, dim: str, method: str) -> DataFrame:
    """Full symmetric matrix in long form, ones on the diagonal, four decimals."""
    pairs = stage(pairs.select("a", "b", method), "pairs")
    r = round_half_up(F.col(method), 4).alias("r")
    upper = pairs.select("a", "b", r)
    lower = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), r)
    ends = pairs.select("a").union(pairs.select("b")).distinct()
    diagonal = ends.select("a", F.col("a").alias("b"), F.lit(1.0).alias("r"))
    full = upper.union(lower).union(diagonal)
    return full.withColumnsRenamed({"a": f"{dim}_a", "b": f"{dim}_b"})


def sync_score(store_pairs: DataFrame) -> DataFrame:
    """Mean of the rounded correlations above the diagonal."""
    return store_pairs.agg(round_half_up(F.avg(round_half_up(F.col("pearson"), 4)), 4).alias("cross_store_sync_score"))


def correlation_summary(reports: list[DataFrame], sync: DataFrame) -> DataFrame:
    """One row with every coefficient; null where there were too few observations."""
    facts = [
        r.select(F.concat("metric", F.lit(f"_{m}")).alias("metric"), F.col(m).alias("value"))
        for r in reports
        for m in ("pearson", "spearman")
    ]
    facts.append(sync.select(F.lit("cross_store_sync_score").alias("metric"), F.col("cross_store_sync_score").alias("value")))
    names = [f"{m}_{k}" for m in ("size_vs_cv", "competitors_vs_spread", "brand_tier_vs_cv") for k in ("pearson", "spearman")]
    names.append("cross_store_sync_score")
    return reduce(DataFrame.union, facts).agg(
        *[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name) for name in names]
    )

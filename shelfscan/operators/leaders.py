"""Price leadership: who is cheapest, how often, and where.

All shares come from the group profile, which holds the one cheapest store of a group
(lowest price, then row order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.numbers import round_half_up


def leader_counts(profile: DataFrame) -> DataFrame:
    """Basic index: groups a store leads over all groups, largest share first."""
    total = profile.agg(F.count("*")).scalar()
    led = profile.groupBy(F.col("cheapest_store").alias("store_key")).agg(F.count("*").alias("lowest_price_count"))
    return led.select(
        "store_key",
        "lowest_price_count",
        total.alias("total_matched_groups"),
        round_half_up(F.col("lowest_price_count") / total, 4).alias("ldi"),
    ).orderBy(F.desc("ldi"), "store_key")


def _by_category(profile: DataFrame) -> DataFrame:
    wins = (
        profile.filter("category IS NOT NULL")
        .groupBy("category", F.col("cheapest_store").alias("store_key"))
        .agg(F.count("*").alias("cheapest_count"))
    )
    sizes = profile.groupBy("category").agg(F.count("*").alias("total_in_category"))
    return wins.join(sizes, "category")


def weighted_leader_shares(profile: DataFrame) -> DataFrame:
    """Shares per category weighted by category size."""
    total = profile.agg(F.count("category")).scalar()
    share = F.col("cheapest_count") / F.col("total_in_category") * (F.col("total_in_category") / total)
    return _by_category(profile).groupBy("store_key").agg(round_half_up(F.sum(share), 4).alias("weighted_ldi"))


def category_leader_shares(profile: DataFrame, matched: DataFrame) -> DataFrame:
    """Share per category and store on the full grid of row categories and stores, zero where absent."""
    stores = matched.agg(F.array_sort(F.collect_set("store_key"))).scalar()
    grid = matched.select("category").distinct().withColumn("store_key", F.explode(stores))
    zero = F.lit(0)
    return grid.join(_by_category(profile), ["category", "store_key"], "left").select(
        "category",
        "store_key",
        F.coalesce("cheapest_count", zero).alias("cheapest_count"),
        F.coalesce("total_in_category", zero).alias("total_in_category"),
        F.coalesce(round_half_up(F.col("cheapest_count") / F.col("total_in_category"), 4), F.lit(0.0)).alias(
            "category_ldi"
        ),
    )


def times_cheapest(profile: DataFrame) -> DataFrame:
    """Row-weighted leadership: every matched row counts for the cheapest store of its group."""
    return profile.groupBy(F.col("cheapest_store").alias("store_key")).agg(F.sum("num_rows").alias("times_cheapest"))

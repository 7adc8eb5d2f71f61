"""Store and city level metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.numbers import ratio, round_half_up
from shelfscan.operators.stats import quantiles
from shelfscan.sources.staging import stage


def averages(matched: DataFrame, by: str) -> DataFrame:
    """Mean, median and number of prices per store or per city."""
    rows = matched.filter(F.col(by).isNotNull())
    counts = rows.groupBy(by).agg(F.avg("price").alias("avg_price"), F.count("price").alias("total_products"))
    return counts.join(quantiles(rows, [by], "price", {"median_price": 0.5}), by)


def store_city_metrics(matched: DataFrame, profile: DataFrame) -> DataFrame:
    """Per store and city: category price index, median deviation, volatility, leadership.

    Prices are first counted per (store, city, category, price), combined map-side; all
    price metrics come from that cube. Groups meet their profile over distinct
    (store, city, group) triples, at most one per store and city of a group.
    """
    place = ["store_key", "city"]
    rows = matched.filter("store_key IS NOT NULL AND city IS NOT NULL")
    cube = stage(
        matched.groupBy(*place, "category", "price").agg(F.count("*").alias("n")), "price-cube"
    )
    n, price = F.col("n"), F.col("price")
    market = stage(
        cube.filter("category IS NOT NULL")
        .groupBy("category")
        .agg((F.sum(price * n) / F.sum(n)).alias("market_avg")),
        "market",
    )
    here = cube.filter("store_key IS NOT NULL AND city IS NOT NULL")
    index = (
        here.groupBy(*place, "category")
        .agg((F.sum(price * n) / F.sum(n)).alias("store_avg"))
        .join(market, "category")
        .groupBy(*place)
        .agg(F.avg(ratio(F.col("store_avg"), F.col("market_avg"))).alias("price_index"))
    )
    deviations = here.join(market, "category").withColumn("deviation", price - F.col("market_avg"))
    deviation = quantiles(deviations, place, "deviation", {"median_deviation": 0.5}, n)
    sold = rows.filter("match_group IS NOT NULL").select(*place, "match_group").distinct()
    groups = (
        sold.join(profile.select("match_group", "cv", "cheapest_store"), "match_group")
        .groupBy(*place)
        .agg(
            F.avg("cv").alias("volatility"),
            (F.count_if(F.col("cheapest_store") == F.col("store_key")) / F.count("*") * 100).alias("leadership"),
        )
    )
    counts = here.groupBy(*place).agg(F.sum("n").alias("products_count"))
    joined = counts
    for part in (index, deviation, groups):
        joined = joined.join(part, place, "left")
    return joined.select(
        *place,
        round_half_up(F.col("price_index"), 4).alias("avg_category_price_index"),
        round_half_up(F.col("median_deviation"), 2).alias("median_price_deviation"),
        round_half_up(F.col("volatility"), 2).alias("price_volatility_score"),
        round_half_up(F.col("leadership"), 2).alias("price_leadership_frequency_pct"),
        "products_count",
    )


def pivot_small(df: DataFrame, row: str, column: str, value: str, fill=None) -> DataFrame:
    """Cross-tab of an already unique (row, column) table, one column per value found.

    More values than ``spark.sql.pivotMaxValues`` is an error; nothing is dropped.
    """
    wide = stage(df.select(row, column, value), "pivot").groupBy(row).pivot(column).agg(F.first(value))
    return wide if fill is None else wide.na.fill(fill, subset=[c for c in wide.columns if c != row])

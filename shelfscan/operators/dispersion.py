"""Price dispersion per matched group, its summary, histograms and top differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.numbers import cv_percent, price_position, round_half_up, spread_ratio
from shelfscan.operators.stats import first_known, quantiles
from shelfscan.sources.staging import stage

DISPERSION = (
    "match_group", "product", "brand", "category", "num_stores", "num_cities", "num_obs",
    "mean_price", "median_price", "std_price", "min_price", "max_price", "q25", "q75",
    "cv", "price_range", "iqr", "price_spread_ratio",
)


def group_profile(matched: DataFrame) -> DataFrame:
    """Everything the analytics need per group: dispersion, size, stores, cheapest store.

    Two aggregations on the same key, so their join needs no further shuffle. Quantiles
    work on price counts: a group costs its distinct prices, not its rows.
    """
    facts = matched.groupBy("match_group").agg(
        first_known("product_name_clean", "product"),
        first_known("brand"),
        first_known("category"),
        first_known("quantity"),
        first_known("unit"),
        first_known("qty_normalized"),
        F.array_sort(F.collect_set("store_key")).alias("stores"),
        F.size(F.collect_set("city")).cast("bigint").alias("num_cities"),
        F.count("*").alias("num_rows"),
        F.count("price").alias("num_obs"),
        F.avg("price").alias("mean_price"),
        F.stddev_samp("price").alias("std_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min(F.struct("price", "row_ord", "store_key"))["store_key"].alias("cheapest_store"),
    )
    prices = matched.groupBy("match_group", "price").agg(F.count("*").alias("n"))
    quarters = prices.groupBy("match_group").agg(
        F.percentile("price", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q")
    )
    c = F.col
    return (
        facts.join(quarters, "match_group")
        .withColumns(
            {
                "num_stores": F.size("stores").cast("bigint"),
                "q25": c("q")[0],
                "median_price": c("q")[1],
                "q75": c("q")[2],
                "cv": cv_percent(c("std_price"), c("mean_price")),
                "price_range": round_half_up(c("max_price") - c("min_price"), 2),
                "iqr": round_half_up(c("q")[2] - c("q")[0], 2),
                "price_spread_ratio": spread_ratio(c("min_price"), c("max_price")),
            }
        )
        .drop("q")
    )


def price_dispersion(profile: DataFrame) -> DataFrame:
    return profile.select(*DISPERSION)


def dispersion_summary(profile: DataFrame) -> DataFrame:
    """One row over all groups; averages are of the rounded group values."""
    overall = profile.agg(
        F.count("*").alias("num_groups"),
        F.avg("cv").alias("mean_cv"),
        F.avg("price_range").alias("mean_range"),
        F.max("price_range").alias("max_range"),
        F.avg("iqr").alias("mean_iqr"),
        F.avg("price_spread_ratio").alias("mean_spread"),
        F.count_if(F.col("cv") > 10).alias("groups_cv_over_10"),
        F.count_if(F.col("cv") > 20).alias("groups_cv_over_20"),
    )
    median = quantiles(profile, [], "cv", {"median_cv": 0.5})
    return overall.withColumn("median_cv", median.scalar())


def category_dispersion(profile: DataFrame) -> DataFrame:
    return (
        profile.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.avg("cv").alias("avg_cv"),
            F.avg("price_range").alias("avg_range"),
            F.count("product").alias("num_products"),
        )
        .orderBy(F.desc("avg_cv"), "category")
    )


def top_price_differences(profile: DataFrame, k: int = 20) -> DataFrame:
    """Groups with the largest price range (a top-k report)."""
    return (
        profile.filter(F.col("price_range").isNotNull())
        .orderBy(F.desc("price_range"), "match_group")
        .limit(k)
        .select(
            "product", "brand", "category", "num_stores", "min_price", "max_price",
            "price_range", "cv", "iqr", "price_spread_ratio",
        )
    )


def histogram(df: DataFrame, value: str, bins: int = 50, below_quantile: float | None = None) -> DataFrame:
    """Equal-width bins over the range of a column, empty bins included; ``mean_value`` marks the mean.

    With ``below_quantile`` only values below that quantile are binned; the mean is of all.
    """
    known = df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    mean = known.agg(F.avg("v")).scalar()
    if below_quantile is not None:
        known = known.filter(F.col("v") < quantiles(known, [], "v", {"bound": below_quantile}).scalar())
    # one value only: widen by half a unit on each side
    edge = F.when(F.min("v") == F.max("v"), 0.5).otherwise(0.0)
    span = stage(known.agg((F.min("v") - edge).alias("lo"), (F.max("v") + edge).alias("hi")), "span")
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    number = F.least(F.lit(bins), F.floor((F.col("v") - lo) / (hi - lo) * bins) + 1).cast("bigint").alias("bin")
    counts = known.select(number).groupBy("bin").agg(F.count("*").alias("num_values"))
    width = (F.col("hi") - F.col("lo")) / bins
    numbers = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint")))
    edges = span.filter("lo IS NOT NULL").withColumn("bin", numbers)
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_lo"),
        (F.col("lo") + width * F.col("bin")).alias("bin_hi"),
        F.coalesce("num_values", F.lit(0)).alias("num_values"),
        mean.alias("mean_value"),
    )


def box_plot(df: DataFrame, by: str, value: str) -> DataFrame:
    """Five numbers and the count of a column per key."""
    five = {"low": 0.0, "q25": 0.25, "median": 0.5, "q75": 0.75, "high": 1.0}
    rows = df.filter(F.col(by).isNotNull() & F.col(value).isNotNull())
    counts = rows.groupBy(by).agg(F.count("*").alias("num_values"))
    return quantiles(rows, [by], value, five).join(counts, by)


def category_means(rows: DataFrame) -> DataFrame:
    """Mean price per category, staged: the planner sees its real size and broadcasts only if small."""
    means = rows.filter(F.col("category").isNotNull()).groupBy("category")
    return stage(means.agg(F.avg("price").alias("category_mean")), "category-means")


def price_positions(matched: DataFrame) -> DataFrame:
    """Rows with the relative price position index: price over the category mean."""
    rows = matched.join(category_means(matched), "category", "left")
    return rows.withColumn("rppi", price_position(F.col("price"), F.col("category_mean")))


def price_positions_by_store(matched: DataFrame) -> DataFrame:
    """Mean, median and standard deviation of the index per store, from price counts."""
    offers = matched.groupBy("store_key", "category", "price").agg(F.count("*").alias("n"))
    indexed = offers.join(category_means(matched), "category").withColumn(
        "rppi", price_position(F.col("price"), F.col("category_mean"))
    )
    counts = stage(
        indexed.filter("store_key IS NOT NULL AND rppi IS NOT NULL")
        .groupBy("store_key", "rppi")
        .agg(F.sum("n").alias("n")),
        "rppi-counts",
    )
    x, n = F.col("rppi"), F.col("n")
    total, sum_x, sum_xx = F.sum(n), F.sum(n * x), F.sum(n * x * x)
    moments = counts.groupBy("store_key").agg(
        round_half_up(sum_x / total, 4).alias("rppi_mean"),
        F.when(
            total > 1, round_half_up(F.sqrt(F.greatest((sum_xx - sum_x * sum_x / total) / (total - 1), F.lit(0.0))), 4)
        ).alias("rppi_std"),
    )
    medians = quantiles(counts, ["store_key"], "rppi", {"m": 0.5}, n)
    return moments.join(medians, "store_key").select(
        "store_key", "rppi_mean", round_half_up(F.col("m"), 4).alias("rppi_median"), "rppi_std"
    )

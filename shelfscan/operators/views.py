"""Ready-made user queries: overview, search, comparison, layer browser."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.text import label
from shelfscan.sources.staging import stage


def overview(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """Key figures: rows, stores, cities, groups, matched rows, average and largest price range."""
    places = raw.groupBy("store_key", "city").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("total_products"),
        F.count_distinct("store_key").alias("num_stores"),
        F.count_distinct("city").alias("num_cities"),
    )
    groups = profile.agg(
        F.struct(
            F.count("*").alias("match_groups"),
            F.sum("num_rows").alias("matched_rows"),
            F.avg("price_range").alias("avg_price_range"),
            F.max("price_range").alias("max_price_range"),
        )
    ).scalar()
    return places.withColumn("_g", groups).select("total_products", "num_stores", "num_cities", "_g.*")


def crosstab(df: DataFrame) -> DataFrame:
    """Row counts of every store and city that occur, null ones included: one column per city, zero filled.

    The columns are the cities found; more of them than ``spark.sql.pivotMaxValues`` is an error.
    """
    counts = stage(df.groupBy("store_key", "city").agg(F.count(F.lit(1)).alias("num_rows")), "counts")
    return counts.groupBy("store_key").pivot("city").agg(F.first("num_rows")).na.fill(0)


def search(
    processed: DataFrame,
    pattern: str,
    stores: Sequence[str] | None = None,
    cities: Sequence[str] | None = None,
    literal: bool = False,
) -> DataFrame:
    """Listings whose name contains the pattern (a regex unless ``literal``), ignoring case."""
    text = re.escape(pattern) if literal else pattern
    hits = processed.filter(F.coalesce(F.col("product_name_clean").rlike(f"(?iu){text}"), F.lit(False)))
    if stores is not None:
        hits = hits.filter(F.col("store_key").isin(*stores))
    if cities is not None:
        hits = hits.filter(F.col("city").isin(*cities))
    return hits.select("product_name_clean", "brand", "price", "store_key", "city", "category", "row_ord")


def cheapest_hits(hits: DataFrame, k: int = 200) -> DataFrame:
    """First k hits by price (a top-k report)."""
    return hits.orderBy("price", "row_ord").limit(k).drop("row_ord")


def hits_by_store(hits: DataFrame) -> DataFrame:
    return hits.groupBy("store_key").agg(
        F.count("*").alias("num_hits"),
        F.avg("price").alias("mean_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def compare(summary: DataFrame, min_range: float = 0.0, min_stores: int = 2, k: int = 100) -> DataFrame:
    """Matched products by price range, largest first (a top-k report)."""
    return (
        summary.filter((F.col("price_range") >= min_range) & (F.col("num_stores") >= min_stores))
        .orderBy(F.desc("price_range"), "match_group")
        .limit(k)
        .select("product_name", "brand", "stores", "num_stores", "min_price", "max_price", "price_range", "avg_price")
    )


def labelled(top: DataFrame, name: str = "product_name") -> DataFrame:
    """Bar labels of at most 40 characters with their price range."""
    return top.select(label(F.col(name)).alias("label"), "price_range")


def browse(layer: DataFrame, store: str | None = None, k: int = 500) -> DataFrame:
    """First k rows of a layer in row order, of one store or of all."""
    rows = layer if store is None else layer.filter(F.col("store_key") == store)
    return rows.orderBy("row_ord").limit(k)

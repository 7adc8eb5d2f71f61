"""Data-quality report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.fixed_values import SUSPICIOUS_PRICE, TARGET_MATCHED, TARGET_RAW_ROWS
from shelfscan.functions.numbers import missing_status, target_status
from shelfscan.operators.stats import quantiles
from shelfscan.sources.staging import stage

CHECKED_COLUMNS = ("product_name", "price", "store_key", "city", "category", "brand", "quantity", "unit")


def row_counts(layers: Mapping[str, DataFrame | None], targets: Mapping[str, int] | None = None) -> DataFrame:
    """Rows per layer; a missing layer counts 0. Layers with a target get a status."""
    targets = {"raw": TARGET_RAW_ROWS} if targets is None else targets
    spark = next(df for df in layers.values() if df is not None).sparkSession
    counts = []
    for name, df in layers.items():
        rows = spark.range(1).select(F.lit(0).cast("bigint").alias("num_rows")) if df is None else df.agg(
            F.count("*").alias("num_rows")
        )
        status = target_status(F.col("num_rows"), targets[name]) if name in targets else F.lit(None).cast("string")
        counts.append(rows.select(F.lit(name).alias("layer"), "num_rows", status.alias("status")))
    return reduce(DataFrame.unionByName, counts)


def missing_values(df: DataFrame, columns: Sequence[str] = CHECKED_COLUMNS) -> DataFrame:
    """Missing rows, percent and status per column, in one pass; NOT FOUND for absent columns."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in present])
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            ((F.col("_rows") - F.col(c)) if c in present else F.lit(None).cast("bigint")).alias("missing"),
            F.col("_rows").alias("total"),
        )
        for c in columns
    ]
    percent = F.try_divide(F.col("missing") * 100.0, F.col("total"))
    return (
        counts.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .select(
            "column_name",
            "missing",
            percent.alias("missing_pct"),
            F.when(F.col("missing").isNull(), "NOT FOUND").otherwise(missing_status(percent)).alias("status"),
        )
    )


def duplicates(df: DataFrame, ignore: Sequence[str] = ("row_ord",)) -> DataFrame:
    """Rows that repeat a whole row, and rows that repeat store, name and price."""
    columns = [c for c in df.columns if c not in ignore]
    near = df.groupBy("store_key", "product_name", "price").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()
    return df.sparkSession.range(1).select(repeated_rows(df.select(*columns)).scalar().alias("exact_duplicates"), near.alias("near_duplicates"))


def repeated_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat another row in every column, as one value.

    Rows are counted by a digest of 128 bits first; whole rows are compared only where digests meet. The digests that
    meet are stored, so that their size is known: while they are few, no whole row is shuffled.
    """
    digest = [F.xxhash64(F.lit(seed), *df.columns).alias(f"digest_{seed}") for seed in (1, 2)]
    met = df.select(*digest).groupBy("digest_1", "digest_2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = df.select("*", *digest).join(stage(met, "digests"), ["digest_1", "digest_2"], "left_semi")
    return rows.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def names_per_store(df: DataFrame) -> DataFrame:
    names = df.groupBy("store_key", "product_name").agg(F.count("*").alias("n"))
    return names.groupBy("store_key").agg(F.count("product_name").alias("unique_names"), F.sum("n").alias("num_rows"))


def price_sanity(df: DataFrame) -> DataFrame:
    """Price statistics overall (``store_key`` null) and per store, with suspicious counts.

    All rows collapse to (store, price) counts first; both levels are read from those.
    """
    counts = stage(df.groupBy("store_key", "price").agg(F.count("*").alias("n")), "price-counts")
    price, n = F.col("price"), F.col("n")

    def stats(rows: DataFrame, keys: list[str]) -> DataFrame:
        table = rows.groupBy(*keys).agg(
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
            (F.sum(price * n) / F.sum(F.when(price.isNotNull(), n))).alias("mean_price"),
            F.coalesce(F.sum(F.when(price <= 0, n)), F.lit(0)).alias("not_positive"),
            F.coalesce(F.sum(F.when(price > SUSPICIOUS_PRICE, n)), F.lit(0)).alias("suspicious"),
        )
        medians = quantiles(rows, keys, "price", {"median_price": 0.5}, n)
        if keys:
            return table.join(medians, keys, "left")
        return table.withColumn("median_price", medians.scalar()).withColumn("store_key", F.lit(None).cast("string"))

    return stats(counts, []).unionByName(stats(counts.filter("store_key IS NOT NULL"), ["store_key"]))


def coverage(df: DataFrame) -> DataFrame:
    """Distinct stores, cities and categories, from the distinct combinations."""
    combinations = df.select("store_key", "city", "category").distinct()
    return combinations.agg(
        F.count_distinct("store_key").alias("num_stores"),
        F.count_distinct("city").alias("num_cities"),
        F.count_distinct("category").alias("num_categories"),
    )


def store_city_rows(df: DataFrame) -> DataFrame:
    rows = df.filter("store_key IS NOT NULL AND city IS NOT NULL")
    return rows.groupBy("store_key", "city").agg(F.count("*").alias("num_rows"))


def rows_by_dimension(df: DataFrame) -> DataFrame:
    """Row counts by store, by city, by store and city, and in total.

    Rows collapse to one count per store and city before the grouping sets multiply them.
    """
    cells = df.groupBy("store_key", "city").agg(F.count("*").alias("n"))
    return cells.groupingSets([["store_key"], ["city"], ["store_key", "city"], []], "store_key", "city").agg(
        F.sum("n").alias("num_rows"), F.grouping_id().cast("bigint").alias("level")
    )


def store_reach(df: DataFrame, url: str = "product_url") -> DataFrame:
    """Rows, distinct cities and rows with a link per store, most rows first."""
    per_city = df.groupBy("store_key", "city").agg(F.count("*").alias("n"), F.count(url).alias("u"))
    return (
        per_city.filter("store_key IS NOT NULL")
        .groupBy("store_key")
        .agg(F.sum("n").alias("num_rows"), F.count("city").alias("num_cities"), F.sum("u").alias("with_url"))
        .orderBy(F.desc("num_rows"), "store_key")
    )


def group_size_counts(profile: DataFrame) -> DataFrame:
    """Groups by number of stores, with the 2 / 3 / 4+ bucket each falls in."""
    bucket = F.when(F.col("num_stores") >= 4, "4+").otherwise(F.col("num_stores").cast("string"))
    return profile.groupBy("num_stores").agg(F.count("*").alias("num_groups")).withColumn("bucket", bucket)


def rows_per_store(df: DataFrame) -> DataFrame:
    return df.groupBy("store_key").agg(F.count("*").alias("num_rows"))


def match_quality(profile: DataFrame, target: int = TARGET_MATCHED) -> DataFrame:
    """Group count against its target and matched rows."""
    return profile.agg(
        F.count("*").alias("num_groups"), F.coalesce(F.sum("num_rows"), F.lit(0)).alias("matched_rows")
    ).withColumn("status", target_status(F.col("num_groups"), target))

"""Cross-store identity: three tiers of keys, each over the rows earlier tiers left.

Rows are first reduced to key units (one per full key and name key, with the smallest
and largest store; combined map-side). All tiers run on units; rows join their unit once.
No window or task ever holds all rows of a key, so a key with a third of the rows only
makes one large join partition, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.functions import keys
from shelfscan.operators.stats import first_known
from shelfscan.sources.staging import stage


def with_match_keys(processed: DataFrame) -> DataFrame:
    """Add ``match_key`` and ``name_key``. Each step is a column so that no regex runs twice."""
    slug, text, base = F.col("_slug"), F.col("_text"), F.col("_base")
    return (
        processed.withColumns(
            {
                "_slug": keys.brand_slug(F.col("brand")),
                "_text": F.trim(F.lower("product_name_clean")),
                "_size": keys.size_token(F.col("quantity"), F.col("unit")),
            }
        )
        .withColumn("_at", F.when(slug != "", F.instr(text, slug)).otherwise(F.lit(0)))
        .withColumn("_base", keys.key_base(slug, keys.product_words(keys.without_first(text, slug, F.col("_at")))))
        .withColumn("_full", keys.full_key(base, F.col("_size")))
        .withColumns({"match_key": keys.long_enough(F.col("_full")), "name_key": keys.long_enough(base)})
        .drop("_slug", "_text", "_size", "_at", "_base", "_full")
    )


def _shared(units: DataFrame, key: str) -> DataFrame:
    """Keys that occur in two or more stores."""
    spans = units.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("store_lo").alias("lo"), F.max("store_hi").alias("hi")
    )
    return spans.filter("lo <> hi").select(key)


def key_groups(keyed: DataFrame) -> DataFrame:
    """(match_key, name_key) -> match_group, match_pass, for every unit that matched."""
    units = (
        keyed.filter(F.col("match_key").isNotNull())
        .groupBy("match_key", "name_key")
        .agg(F.min("store_key").alias("store_lo"), F.max("store_key").alias("store_hi"))
    )
    # a full key has at most two name keys (with and without its size tail): tiny windows
    same_key = Window.partitionBy("match_key")
    units = stage(
        units.withColumn("_p1", F.min("store_lo").over(same_key) != F.max("store_hi").over(same_key)), "units"
    )
    left = units.filter("NOT _p1").withColumn("short_key", keys.short_key(F.col("name_key"))).drop("_p1")
    by_name = left.join(_shared(left, "name_key").withColumn("_p2", F.lit(True)), "name_key", "left")
    rest = by_name.filter("_p2 IS NULL")
    by_short = by_name.join(
        _shared(rest, "short_key").withColumn("_p3", F.lit(True)), "short_key", "left"
    )
    later = by_short.select(
        "match_key",
        "name_key",
        F.when(F.col("_p2"), F.concat(F.lit("p2:"), "name_key"))
        .when(F.col("_p3"), F.concat(F.lit("p3:"), "short_key"))
        .alias("match_group"),
        F.when(F.col("_p2"), 2).when(F.col("_p3"), 3).alias("match_pass"),
    ).filter("match_group IS NOT NULL")
    first = units.filter("_p1").select(
        "match_key", "name_key", F.concat(F.lit("p1:"), "match_key").alias("match_group"), F.lit(1).alias("match_pass")
    )
    return first.unionByName(later)


def match_listings(keyed: DataFrame) -> DataFrame:
    """All rows with ``match_group`` and ``match_pass`` (null where nothing matched).

    ``keyed`` is read three times; give it as a stored or staged table. Rows without a key pass the join by.
    """
    groups = key_groups(keyed).withColumnsRenamed({"match_key": "_mk", "name_key": "_nk"})
    same_unit = (F.col("match_key") == F.col("_mk")) & F.col("name_key").eqNullSafe(F.col("_nk"))
    matched = keyed.filter(F.col("match_key").isNotNull()).join(groups, same_unit, "left").drop("_mk", "_nk")
    none = F.lit(None)
    others = keyed.filter(F.col("match_key").isNull())
    return matched.unionByName(others.withColumns({"match_group": none.cast("string"), "match_pass": none.cast("int")}))


def matched_only(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("match_group").isNotNull())


def coverage_by_pass(rows: DataFrame) -> DataFrame:
    """Rows and groups per pass (0 = unmatched), with the rows that got each key."""
    per_group = rows.groupBy(F.coalesce("match_pass", F.lit(0)).alias("match_pass"), "match_group").agg(
        F.count("*").alias("n"), F.count("match_key").alias("fk"), F.count("name_key").alias("nk")
    )
    return per_group.groupBy("match_pass").agg(
        F.count("match_group").alias("num_groups"),
        F.sum("n").alias("num_rows"),
        F.sum("fk").alias("rows_with_full_key"),
        F.sum("nk").alias("rows_with_name_key"),
    )


def match_summary(matched: DataFrame) -> DataFrame:
    """One row per group: first name, brand and size, its stores, and its prices."""
    return (
        matched.groupBy("match_group")
        .agg(
            first_known("product_name_clean", "product_name"),
            first_known("brand"),
            first_known("quantity"),
            first_known("unit"),
            F.array_sort(F.collect_set("store_key")).alias("_stores"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.avg("price").alias("avg_price"),
            (F.max("price") - F.min("price")).alias("price_range"),
            F.count("price").alias("num_rows"),
        )
        .withColumns(
            {
                "num_stores": F.size("_stores").cast("bigint"),
                "stores": F.array_join("_stores", ", "),
            }
        )
        .drop("_stores")
    )

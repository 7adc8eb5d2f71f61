"""First-wins deduplication under named key policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.sources.schemas import ROW_ORDER

# names first where rows are sorted whole: they tell most rows apart, and equal texts lie together in files and shuffles
POLICIES = {
    "listing": ("product_name", "store_key", "city", "price"),
    "listing_any_price": ("store_key", "city", "product_name"),
    "offer": ("product_name", "price"),
    "city_merge": ("product_name", "city"),
    "store_city_merge": ("product_name", "store_key", "city"),
    "item": ("sku",),
}


def keep_first(df: DataFrame, keys: tuple[str, ...], *order: str | Column) -> DataFrame:
    """One row per key, the first in ``order``; nulls in keys are equal.

    The ``= 1`` filter lets Spark prune each key to its first row before the shuffle
    (window group limit), so many copies of one key never meet in one task.
    """
    present = [k for k in keys if k in df.columns]
    window = Window.partitionBy(*present).orderBy(*(order or (ROW_ORDER,)))
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def dedup(df: DataFrame, policy: str = "listing", *order: str | Column) -> DataFrame:
    return keep_first(df, POLICIES[policy], *order)


def unique_per_store(df: DataFrame, policy: str = "offer", by: str = "store_key") -> DataFrame:
    """Rows and distinct keys of a policy per store (nulls count as a value)."""
    keys = [k for k in POLICIES[policy] if k != by]
    offers = df.groupBy(by, *keys).agg(F.count("*").alias("n"))
    return offers.groupBy(by).agg(F.sum("n").alias("num_rows"), F.count("*").alias("unique_rows"))


def unique_by_policy(df: DataFrame, policies: Sequence[str], by: str = "store_key") -> DataFrame:
    """Rows per store, and distinct keys of each policy in a column of its name, in one pass over the rows.

    A row becomes one key for each policy that no other holds all columns of, in which the columns of others are null. Keys are
    counted map-side; the narrower policies take their keys from the counted ones, which are far fewer than the rows.
    """
    keys = {p: {k for k in POLICIES[p] if k != by} for p in policies}
    wide = {p: next((q for q in policies if keys[p] < keys[q] and not any(keys[q] < keys[o] for o in policies)), p) for p in policies}
    used = sorted(set().union(*keys.values()))
    key = lambda p, own=True: F.struct(F.lit(p).alias("policy"), *[(F.col(k) if own and k in keys[p] else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in used])
    widest = [p for p in policies if wide[p] == p]
    rows = df.select(by, F.explode(F.array(*map(key, widest))).alias("k")).select(by, "k.*")
    counted = rows.groupBy(by, "policy", *used).agg(F.count("*").alias("n")).withColumnRenamed("policy", "of")
    # a counted key goes on as itself, without its columns, and as the keys of the policies within its own
    within = [F.when(F.col("of") == p, F.array(key(p, own=False), *[key(q) for q in policies if q != p and wide[q] == p])) for p in widest]
    parts = counted.select(by, "n", F.explode(F.coalesce(*within)).alias("k")).select(by, "n", "k.*")
    counts = parts.groupBy(by, "policy", *used).agg(F.sum("n").alias("n"), F.count("*").alias("keys"))
    size = lambda p: F.sum(F.when(F.col("policy") == p, F.col("keys") if p in widest else F.lit(1)))
    unique = [F.coalesce(size(p), F.lit(0)).cast("bigint").alias(p) for p in policies]
    return counts.groupBy(by).agg(F.sum(F.when(F.col("policy") == policies[0], F.col("n"))).alias("num_rows"), *unique)


def first_new_names(df: DataFrame, known: Column, name: str = "product_name", order: str = ROW_ORDER) -> DataFrame:
    """The first row of every case-folded, trimmed name that no row marked ``known`` has, in one pass.

    Known rows come first in a name's order, so the first row shows whether there are any.
    """
    folded = F.lower(F.trim(F.col(name)))
    marked = df.withColumns({"_folded": folded, "_known": F.coalesce(known, F.lit(False))}).filter("_folded <> ''")
    return keep_first(marked, ("_folded",), F.desc("_known"), order).filter("NOT _known").drop("_folded", "_known")


def new_names_only(df: DataFrame, known: DataFrame, name: str = "product_name", order: str = ROW_ORDER) -> DataFrame:
    """Rows whose case-folded, trimmed name is not yet known, first of each name."""
    folded = F.lower(F.trim(F.col(name)))
    seen = known.select(folded.alias("_folded")).filter("_folded IS NOT NULL").distinct()
    first = keep_first(df.withColumn("_folded", folded).filter("_folded <> ''"), ("_folded",), order)
    return first.join(seen, "_folded", "left_anti").drop("_folded")


def merge_first_wins(old: DataFrame, new: DataFrame, policy: str = "city_merge", order: str = ROW_ORDER) -> DataFrame:
    """Union in which rows of the old partition win over rows of the new one."""
    ranked = old.withColumn("_source", F.lit(0)).unionByName(
        new.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return keep_first(ranked, POLICIES[policy], "_source", order).drop("_source")

"""Cleaning and normalising: raw listings to the processed layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.functions import text, units
from shelfscan.functions.fixed_values import KNOWN_BRANDS, PRICE_CEILING, PROMO_FRAGMENTS
from shelfscan.operators.dedup import POLICIES, dedup

MIN_NAME_LENGTH = 3


def with_clean_names(df: DataFrame, fragments: Sequence[str] = PROMO_FRAGMENTS) -> DataFrame:
    """Add ``product_name_clean``.

    Equals ``text.clean_name``, in steps; the removal chain and the second cleaning only
    run on names in which a fragment occurs. Normalised text is a step of its own, so that one UDF call gives it.
    """
    plain, tidy, promo, rest = F.col("_plain"), F.col("_tidy"), F.col("_promo"), F.col("_rest")
    return (
        df.withColumn("_plain", text.normal_text(F.col("product_name")))
        .withColumn("_tidy", text.single_spaces(plain))
        .withColumn("_promo", text.may_have_promo(F.lower(tidy), fragments))
        .withColumn("_rest", F.when(promo, text.remove_promos(tidy, fragments)))
        .withColumn("_plain", text.normal_text(rest))
        .withColumn("product_name_clean", F.when(promo, text.single_spaces(plain)).otherwise(tidy))
        .drop("_plain", "_tidy", "_promo", "_rest")
    )


def clean_names(df: DataFrame, fragments: Sequence[str] = PROMO_FRAGMENTS) -> DataFrame:
    """Clean names; drop those of two characters or fewer."""
    return with_clean_names(df, fragments).filter(F.char_length("product_name_clean") >= MIN_NAME_LENGTH)


def _numeric(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    return text.to_number(column) if df.schema[name].dataType.simpleString() == "string" else column.try_cast("double")


def valid_prices(df: DataFrame, ceiling: float = PRICE_CEILING) -> DataFrame:
    """Coerce prices to numbers and keep 0 < price <= ceiling."""
    numeric = {c: _numeric(df, c) for c in ("price", "old_price") if c in df.columns}
    return df.withColumns(numeric).filter((F.col("price") > 0) & (F.col("price") <= ceiling))


def with_brands(df: DataFrame, brands: Sequence[str] = KNOWN_BRANDS) -> DataFrame:
    return df.withColumn("brand", text.extract_brand(F.col("product_name_clean"), brands))


def with_sizes(df: DataFrame) -> DataFrame:
    size = df.withColumn("_size", units.size_text(F.col("product_name_clean")))
    return size.withColumns({"quantity": units.quantity(F.col("_size")), "unit": units.unit(F.col("_size"))}).drop("_size")


def with_unit_prices(df: DataFrame) -> DataFrame:
    qty, unit, price = F.col("quantity"), F.col("unit"), F.col("price")
    known = price.isNotNull()
    return df.withColumns(
        {
            "qty_normalized": F.when(known, units.base_quantity(qty, unit)),
            "unit_normalized": F.when(known & unit.isNotNull(), units.base_unit(qty, unit)),
        }
    ).withColumn("price_per_unit", units.unit_price(price, F.col("qty_normalized"), F.col("unit_normalized")))


def clean_listings(raw: DataFrame) -> DataFrame:
    """Dedup on raw values, then prices, names, brands, sizes and unit prices.

    Prices come before names because the two filters commute and only the cheap one
    can reach the scan.
    """
    return with_unit_prices(with_sizes(with_brands(clean_names(valid_prices(dedup(raw, "listing"))))))


def rejection_counts(raw: DataFrame, ceiling: float = PRICE_CEILING) -> DataFrame:
    """Rows each cleaning stage drops.

    Name and price are part of the dedup key, so one count per key (combined before the
    shuffle) is enough for every stage.
    """
    offers = raw.groupBy(*POLICIES["listing"]).agg(F.count("*").alias("n"))
    flagged = with_clean_names(offers).select(
        "n",
        (F.char_length("product_name_clean") >= MIN_NAME_LENGTH).alias("named"),
        _numeric(offers, "price").alias("price"),
    )
    named, price = F.col("named"), F.col("price")
    return flagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(~named).alias("empty_names"),
        F.count_if(named & ~F.coalesce((price > 0) & ~F.isnan(price), F.lit(False))).alias("invalid_prices"),
        F.count_if(named & (price > ceiling) & ~F.isnan(price)).alias("prices_too_high"),
        F.count_if(named & (price > 0) & (price <= ceiling)).alias("clean_rows"),
    )


def extraction_coverage(processed: DataFrame) -> DataFrame:
    """Rows, rows with a size, rows with a unit price."""
    return processed.agg(
        F.count("*").alias("num_rows"),
        F.count(F.when(F.col("unit").isNotNull(), F.col("quantity"))).alias("with_size"),
        F.count("price_per_unit").alias("with_unit_price"),
    )


def top_brands(processed: DataFrame, k: int = 10) -> DataFrame:
    counts = processed.groupBy("brand").agg(F.count("*").alias("num_rows"))
    return counts.orderBy(F.desc("num_rows"), "brand").limit(k)


def replicate_cities(catalogue: DataFrame, cities: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """The same catalogue under each target city, skipping (store, city) pairs that exist."""
    targets = F.explode(F.array(*[F.lit(c) for c in cities]))
    if existing is None:
        return catalogue.withColumn("city", targets)
    stores = catalogue.select("store_key").distinct().withColumn("city", targets)
    missing = stores.join(existing.select("store_key", "city").distinct(), ["store_key", "city"], "left_anti")
    return catalogue.drop("city").join(missing, "store_key")

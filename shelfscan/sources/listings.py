"""Listings derived from the order tables: the raw layer all registered queries start from.

A listing is one order line: store = region of the supplier, city = market segment of
the customer (one row of 101: a city of its own), category = part type. Names and prices carry
the dirt the cleaning steps remove: blank and short names, accents, promo words, listed brands, all kinds
of units; null, zero, suspicious and impossible prices; exact copies.
``row_ord`` is the explicit row order; it determines every other column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SIZE = """concat(cast(p_size AS string), CASE p_partkey % 6 WHEN 0 THEN 'kg' WHEN 1 THEN 'gm'
  WHEN 2 THEN 'ml' WHEN 3 THEN ' ltr' WHEN 4 THEN 'pcs' ELSE ' pack' END)"""

# d picks one row of 101 for each kind of dirt; the rest follow v
_NAME = """CASE d
  WHEN 1 THEN 'ab'
  WHEN 2 THEN '   '
  WHEN 7 THEN concat('Lux Soap ', p_name, ' ', sz)
  WHEN 8 THEN concat('Clearasil ', p_name, ' ', sz)
  WHEN 9 THEN concat('Caf\u00e9\u00a0', p_name, ' ', category, ' ', sz)
  WHEN 10 THEN concat(b, ' \ufb01ne ', p_name, ' ', category, ' ', sz)
  WHEN 11 THEN concat('New! ', b, ' ', p_name, ' ', category, ' ', sz)
  WHEN 12 THEN concat(b, ' hot ', p_name, ' ', category, ' ', sz)
  WHEN 13 THEN concat(b, ' ', p_name, ' Best Seller ', category, ' ', sz)
  WHEN 14 THEN concat(b, ' ', p_name, ' ', category, ' ', sz, ' LIMITED')
  WHEN 15 THEN concat(b, ' ', p_name, ' ', category, ' ', p_size, 'mg')
  WHEN 16 THEN concat(b, ' ', p_name, ' ', category, ' ', p_size, ' lb')
  WHEN 17 THEN concat(b, ' ', p_name, ' ', category, ' ', p_size, 'cc')
  WHEN 18 THEN concat(b, ' ', p_name, ' ', category, ' ', p_size, ' rolls')
  WHEN 19 THEN concat(b, ' ', p_name, ' ', category, ' ', p_size, ' sachets')
  ELSE CASE v
  WHEN 0 THEN concat(b, ' ', p_name, ' ', category)
  WHEN 1 THEN concat('SALE ', b, '  ', p_name, ' ', category, ' ', sz)
  WHEN 2 THEN concat(b, ' ', p_name, ' ', category, ' lot', cast(l_suppkey AS string), ' mix ', sz)
  WHEN 3 THEN concat(replace(store_key, ' ', ''), ' ', p_name, ' ', category, ' ', sz)
  WHEN 4 THEN concat(b, ' ', p_name, ' ', category, ' ', cast(1000 + r_regionkey AS string), 'gm')
  WHEN 5 THEN concat(b, ' ', replace(p_name, 'e', repeat('e', cast(r_regionkey AS int) + 2)), ' ', category, ' ', sz)
  ELSE concat(b, ' ', p_name, ' ', category, ' ', sz) END END"""

_USUAL = "floor(round(p_retailprice * 100) * (90 + 5 * r_regionkey + l_linenumber % 7) / 100e0) / 100e0"
_PRICE = f"CASE d WHEN 3 THEN 0e0 WHEN 4 THEN NULL WHEN 5 THEN floor({_USUAL}) * 1000 WHEN 6 THEN floor({_USUAL}) * 60 ELSE {_USUAL} END"
_OLD = """CASE WHEN l_discount >= 0.05 THEN
  floor(round(p_retailprice * 100) * (125 + round(l_discount * 100)) / 100e0) / 100e0 END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    # orders meet customers, and lines meet orders, while rows are narrow; parts come after that, so that only they
    # widen the rows that are shuffled for the last time; the small tables join one by one: the planner then knows
    # each one's real size and broadcasts only what is small
    cities = (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "c_mktsegment")
    )
    joined = (
        t("lineitem")
        .join(cities, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    keyed = joined.withColumns(
        {
            "store_key": F.lower("r_name"),
            "d": F.expr("(l_orderkey * 3 + l_linenumber * 7 + l_suppkey) % 101"),
            "category": F.lower("p_type"),
            "b": F.expr("replace(p_brand, '#', '')"),
            "v": F.expr("(l_suppkey * 7 + l_partkey) % 10"),
            "sz": F.expr(_SIZE),
        }
    )
    copied = keyed.withColumn("copy", F.expr("explode(sequence(1, if(d = 30, 2, 1)))"))
    return copied.select(
        "store_key",
        F.when(F.col("d") == 21, F.lit("orchard")).otherwise(F.lower("c_mktsegment")).alias("city"),
        "category",
        F.expr(_NAME).alias("product_name"),
        F.expr(_PRICE).alias("price"),
        F.expr(_OLD).alias("old_price"),
        F.lit("PKR").alias("currency"),
        F.col("o_orderdate").alias("scraped_at"),
        F.col("l_partkey").alias("sku"),
        F.expr("struct(l_orderkey AS ok, l_linenumber AS ln, l_partkey AS sku, l_suppkey AS sk, l_discount AS disc)")
        .alias("row_ord"),
    )

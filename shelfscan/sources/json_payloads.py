"""Stored API payloads to listings: parse with a declared schema, explode, project.

Payload tables hold one response per row. Fields of mixed type are read as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.functions import text
from shelfscan.functions.fixed_values import PRICE_CEILING
from shelfscan.operators.dedup import keep_first, new_names_only

_SHOP = """STRUCT<products: ARRAY<STRUCT<title: STRING, product_type: STRING, tags: STRING, vendor: STRING,
  handle: STRING, images: ARRAY<STRUCT<src: STRING>>, variants: ARRAY<STRUCT<price: STRING,
  compare_at_price: STRING, weight: STRING, weight_unit: STRING, sku: STRING, available: BOOLEAN>>>>>"""

_CATALOGUE = """STRUCT<data: ARRAY<STRUCT<product_name: STRING, price: STRING, sale_price: STRING,
  teir1Name: STRING, tier2Name: STRING, tier3Name: STRING, tier4Name: STRING, brand_name: STRING,
  weight: STRING, unit_type: STRING, product_code_app: STRING, url: STRING, available_stock: DOUBLE>>>"""

_SEARCH = """STRUCT<mods: STRUCT<listItems: ARRAY<STRUCT<itemId: STRING, nid: STRING, name: STRING, price: STRING,
  originalPrice: STRING, itemUrl: STRING, productUrl: STRING, image: STRING, categories: ARRAY<STRING>,
  brandName: STRING, inStock: BOOLEAN>>>>"""

_CATEGORIES = "STRUCT<data: ARRAY<STRUCT<id: STRING, parentId: STRING, category_name: STRING, enable: BOOLEAN>>>"


def _items(payloads: DataFrame, schema: str, path: str, *keep: str) -> DataFrame:
    """One row per entry of the array at ``path``: its position and fields."""
    parsed = payloads.select(*keep, F.from_json("payload", schema).alias("body"))
    return parsed.select(*keep, F.posexplode(f"body.{path}").alias("position", "item")).select(
        *keep, "position", "item.*"
    )


def _truthy(c: Column) -> Column:
    """A number from text; null for blank, unparsable and zero values."""
    return F.nullif(text.to_number(c), F.lit(0.0))


def joined_tags(tags: Column) -> Column:
    """Tags given as a text or as a list of texts."""
    as_list = F.array_join(F.from_json(tags, "ARRAY<STRING>"), ", ")
    return F.when(F.startswith(tags, F.lit("[")), as_list).otherwise(tags)


def shop_listings(payloads: DataFrame, site: str, order: str = "page") -> DataFrame:
    """Product pages of a shop; the first variant prices the product."""
    first = F.try_element_at("variants", F.lit(1))
    rows = _items(payloads, _SHOP, "products", order).withColumns({"v": first, "title": F.trim("title")})
    priced = rows.withColumn("price", _truthy(F.col("v.price"))).filter(
        (F.char_length("title") >= 2) & F.col("price").isNotNull()
    )
    weight = F.col("v.weight")
    weight_unit = F.coalesce("v.weight_unit", F.lit(""))
    return priced.select(
        order,
        "position",
        F.lit(None).cast("string").alias("city"),
        text.classify_category(F.col("product_type"), joined_tags(F.col("tags")), F.col("title")).alias("category"),
        F.coalesce("product_type", F.lit("")).alias("category_hierarchy"),
        F.col("title").alias("product_name"),
        "price",
        text.to_number(F.col("v.compare_at_price")).alias("old_price"),
        F.lit("PKR").alias("currency"),
        F.coalesce("vendor", F.lit("")).alias("brand"),
        F.when(_truthy(weight).isNotNull(), F.trim(F.concat_ws(" ", weight, weight_unit))).alias("weight"),
        weight_unit.alias("unit_type"),
        F.coalesce("v.sku", F.lit("")).alias("sku"),
        F.concat(F.lit(f"{site}/products/"), F.coalesce("handle", F.lit(""))).alias("product_url"),
        F.try_element_at("images", F.lit(1))["src"].alias("image_url"),
        F.coalesce("v.available", F.lit(False)).alias("in_stock"),
    )


def catalogue_listings(payloads: DataFrame, site: str, order: str = "page") -> DataFrame:
    """Catalogue pages: the sale price is current when it undercuts the list price.

    ``payloads`` carries the category each page was requested for.
    """
    rows = _items(payloads, _CATALOGUE, "data", order, "category").filter(F.char_length("product_name") >= 3)
    price, sale = _truthy(F.col("price")), _truthy(F.col("sale_price"))
    on_sale = F.coalesce(F.col("_sale") < F.col("_price"), F.lit(False))
    code = F.nullif(F.col("product_code_app"), F.lit(""))
    return rows.withColumns({"_price": price, "_sale": sale}).select(
        order,
        "position",
        "category",
        text.breadcrumb(*[F.col(c) for c in ("teir1Name", "tier2Name", "tier3Name", "tier4Name")]).alias(
            "category_hierarchy"
        ),
        "product_name",
        F.when(on_sale, F.col("_sale")).otherwise(F.col("_price")).alias("price"),
        F.when(on_sale, F.col("_price")).alias("old_price"),
        F.lit("PKR").alias("currency"),
        F.col("brand_name").alias("brand"),
        "weight",
        "unit_type",
        F.col("product_code_app").alias("sku"),
        F.concat(F.lit(f"{site}/product/"), code).alias("product_url"),
        F.col("url").alias("image_url"),
        (F.coalesce("available_stock", F.lit(0.0)) > 0).alias("in_stock"),
    )


def search_listings(payloads: DataFrame, site: str) -> DataFrame:
    """Marketplace search pages (``query_no``, ``page``): first sight of an item id wins, even
    when that sighting is then dropped for its name or price."""
    rows = _items(payloads, _SEARCH, "mods.listItems", "query_no", "page")
    item_id = F.coalesce(F.nullif(F.col("itemId"), F.lit("")), F.nullif(F.col("nid"), F.lit("")))
    sighted = rows.withColumns({"sku": item_id, "product_name": F.trim("name")}).filter("sku IS NOT NULL")
    unique = keep_first(sighted, ("sku",), "query_no", "page", "position")
    priced = unique.withColumns(
        {
            "price": _truthy(F.col("price")),
            "_list": _truthy(F.col("originalPrice")),
            "product_url": text.absolute_url(F.coalesce("itemUrl", F.lit("")), site),
        }
    ).filter((F.char_length("product_name") >= 3) & (F.col("price") > 0))
    image = F.coalesce("image", F.lit(""))
    return priced.select(
        "query_no",
        "page",
        "position",
        text.category_from_url(F.col("product_url"), f"{site}/").alias("category"),
        F.coalesce(F.array_join("categories", " > "), F.lit("")).alias("category_hierarchy"),
        "product_name",
        "price",
        F.when(F.col("_list") > F.col("price"), F.col("_list")).alias("old_price"),
        F.lit("PKR").alias("currency"),
        F.col("brandName").alias("brand"),
        "sku",
        "product_url",
        F.when(F.startswith(image, F.lit("//")), F.concat(F.lit("https:"), image)).otherwise(image).alias("image_url"),
        F.coalesce("inStock", F.lit(True)).alias("in_stock"),
    )


def extra_search_listings(payloads: DataFrame, known: DataFrame, site: str, ceiling: float = PRICE_CEILING) -> DataFrame:
    """Second pass over search pages: only valid prices and names not known yet."""
    rows = _items(payloads, _SEARCH, "mods.listItems", "query_no", "page")
    number = lambda c: text.to_number(F.replace(F.col(c), F.lit(","), F.lit("")))
    priced = rows.withColumns(
        {
            "product_name": F.trim("name"),
            "price": number("price"),
            "old_price": F.nullif(number("originalPrice"), F.lit(0.0)),
            "_seen": F.struct("query_no", "page", "position"),
        }
    ).filter((F.col("price") > 0) & (F.col("price") <= ceiling))
    fresh = new_names_only(priced, known, "product_name", "_seen")
    return fresh.select(
        "query_no",
        "page",
        "position",
        F.coalesce(F.try_element_at("categories", F.lit(1)), F.lit("general")).alias("category"),
        "product_name",
        "price",
        "old_price",
        F.lit("PKR").alias("currency"),
        F.coalesce("brandName", F.lit("")).alias("brand"),
        F.concat(F.lit(site), F.coalesce("productUrl", F.lit(""))).alias("product_url"),
        F.coalesce("image", F.lit("")).alias("image_url"),
    )


def categories(payloads: DataFrame) -> DataFrame:
    """Category responses to rows (id, parent_id, category_name, enabled)."""
    parsed = payloads.select(F.from_json("payload", _CATEGORIES).alias("body"))
    return parsed.select(F.explode("body.data").alias("c")).select(
        F.col("c.id").alias("id"),
        F.col("c.parentId").alias("parent_id"),
        F.col("c.category_name").alias("category_name"),
        F.coalesce("c.enable", F.lit(True)).alias("enabled"),
    )


def leaf_categories(tree: DataFrame) -> DataFrame:
    """Enabled categories that are not the parent of any category."""
    parents = tree.select(F.col("parent_id").alias("id")).filter("id IS NOT NULL AND id <> ''").distinct()
    return tree.filter("enabled").join(parents, "id", "left_anti")

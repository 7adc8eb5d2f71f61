"""Payloads, pages and log lines that Spark derives from the given tables.

The given tables hold no shop responses, so these jobs write the parts and events in
the formats the sources read. Work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.sources.listings import table

PER_PAGE = 40
_KINDS = ("biscuits", "salt", "flour", "unlisted goods", "Tea & Coffee", "toys", "chicken", "misc")
_KIND = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"


def _pages(rows: DataFrame, entry: str, *keys: str) -> DataFrame:
    """Entries of a page of 40 parts as one sorted array."""
    return rows.groupBy(*keys, F.expr(f"p_partkey DIV {PER_PAGE}").alias("page")).agg(
        F.expr(f"transform(array_sort(collect_list(struct(p_partkey AS k, {entry} AS e))), x -> x.e)").alias("entries")
    )


def shop_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = f"""named_struct('title', IF(p_partkey % 13 = 0, 'x', concat(p_name, ' ', p_size, 'g')), 'product_type', {_KIND},
      'tags', array(lower(p_type), IF(p_partkey % 5 = 0, 'baby', 'offer')), 'vendor', p_brand, 'handle', concat('p-', p_partkey),
      'images', array(named_struct('src', 'a.jpg')), 'variants', IF(p_partkey % 11 = 0, array(), array(named_struct(
        'price', IF(p_partkey % 17 = 0, '0.00', cast(p_retailprice AS string)),
        'compare_at_price', IF(p_partkey % 3 = 0, cast(p_retailprice + 50 AS string), ''), 'weight', p_size % 4 * p_size, 'weight_unit', 'g',
        'sku', cast(p_partkey AS string), 'available', p_partkey % 2 = 0))))"""
    entry = entry.replace("p_size % 4 * p_size", "IF(p_size % 4 = 0, 0, p_size)")
    pages = _pages(table(spark, sf_dir, "part"), entry)
    return pages.select("page", F.expr("to_json(named_struct('products', entries))").alias("payload"))


def catalogue_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = """named_struct('product_name', IF(p_partkey % 19 = 0, 'ab', p_name), 'price', p_retailprice,
      'sale_price', IF(p_partkey % 4 = 0, p_retailprice - 100, p_retailprice), 'teir1Name', 'Store', 'tier2Name', p_type,
      'tier3Name', IF(p_partkey % 3 = 0, p_brand, ''), 'brand_name', p_brand, 'product_code_app', cast(p_partkey AS string),
      'available_stock', greatest(p_size - 25, 0))"""
    rows = table(spark, sf_dir, "part").withColumn("category", F.lower("p_type"))
    return _pages(rows, entry, "category").select(
        "page", "category", F.expr("to_json(named_struct('data', entries))").alias("payload")
    )


def search_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page is found by two queries; the second hit of an item has another price."""
    entry = """named_struct('itemId', cast(p_partkey AS string), 'name', concat(' ', p_name), 'price',
      cast(IF(p_partkey % 23 = 0, 0, p_retailprice) + IF(p_partkey % 23 = 0, 0, 7 * query_no) AS string),
      'originalPrice', IF(p_partkey % 5 = 0, p_retailprice + 25, 0), 'itemUrl', concat('/', lower(p_type), '-aisle/i', p_partkey),
      'image', concat('//img.example/', p_partkey, '.jpg'), 'categories', array('Grocery', p_type), 'brandName', p_brand)"""
    rows = table(spark, sf_dir, "part").withColumn("query_no", F.explode(F.array(F.lit(0), F.lit(1))))
    return _pages(rows, entry, "query_no").select(
        "query_no", "page", F.expr("to_json(named_struct('mods', named_struct('listItems', entries)))").alias("payload")
    )


def extra_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = """named_struct('name', concat(' ', p_name, ' ', p_size), 'price', IF(p_partkey % 29 = 0, 'n/a',
      format_number(p_retailprice + 1000, 2)), 'categories', IF(p_partkey % 2 = 0, array(p_type), array()))"""
    pages = _pages(table(spark, sf_dir, "part"), entry)
    return pages.select(
        F.lit(0).alias("query_no"), "page", F.expr("to_json(named_struct('mods', named_struct('listItems', entries)))").alias("payload")
    )


def category_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category tree over the parts: type, then type and brand, then part."""
    parts = table(spark, sf_dir, "part")
    node = "named_struct('id', id, 'parentId', parent, 'category_name', label, 'enable', enable)"
    leaves = parts.selectExpr(
        "p_partkey", "concat('p', p_partkey) AS id", "concat(p_type, '/', p_brand) AS parent", "p_name AS label",
        "p_partkey % 7 <> 3 AS enable",
    )
    brands = parts.groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("p_partkey")).selectExpr(
        "p_partkey", "concat(p_type, '/', p_brand) AS id", "p_type AS parent", "p_brand AS label", "true AS enable"
    )
    types = parts.groupBy("p_type").agg(F.min("p_partkey").alias("p_partkey")).selectExpr(
        "p_partkey", "p_type AS id", "cast(null AS string) AS parent", "p_type AS label", "true AS enable"
    )
    pages = _pages(leaves.unionByName(brands).unionByName(types), node)
    return pages.select("page", F.expr("to_json(named_struct('data', entries))").alias("payload"))


_TITLE = "concat(p_name, ' &amp; ', p_type, '  ', p_size, 'gm')"
_NOW = "cast(cast(floor(p_retailprice * 4) AS bigint) AS string)"
_WAS = "concat('Rs. ', format_number(floor(p_retailprice * 4) + 111, 0))"

_MAGENTO = f"""concat('<li class="item product product-item"><div class="product-item-info"><a class="product-item-link" href="/p/', p_partkey,
  '.html">\\n ', IF(p_partkey % 31 = 0, 'ab', {_TITLE}), ' </a><div class="price-box">', IF(p_partkey % 3 = 0,
  concat('<span class="old-price"><span class="price">', {_WAS}, '</span></span>'), ''), '<span ', IF(p_partkey % 6 < 4,
  concat('data-price-amount="', {_NOW}, '"'), 'class="final"'), '><span class="price">Rs. ', {_NOW}, '</span></span></div><img data-src="/img/', p_partkey, '.jpg" src="x.gif"></div></li>')"""
_TOLERANT = f"""concat('<div class="card-product"><a href="https://store.example/p/', p_partkey, '.html"><h3>', {_TITLE},
  '</h3></a><span class="current-price">PKR ', {_NOW}, '/-</span>', IF(p_partkey % 3 = 0, concat('<del><span class="amount">', {_WAS},
  '</span></del>'), ''), '<br></div>')"""
_TEXT = f"""concat('<div class="col single_product_theme"><a href="/product/', p_partkey, '"><img src="a.jpg"></a><p class="cat-name"> ', p_type,
  '</p><h5 class="product_name_theme">', p_name, ' &amp; ', p_type, ' ', p_size, 'gm</h5><b>', IF(p_partkey % 3 = 0, concat({_WAS}, ' '), ''),
  'Rs ', {_NOW}, '</b></div>')"""


def card_pages(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """HTML pages (page, html) with the parts as product cards of a layout."""
    card = {"magento": _MAGENTO, "tolerant": _TOLERANT, "text": _TEXT}[layout]
    html = "concat('<html><body><script>var x = \"<li>\";</script><ul>', array_join(entries, ''), '</ul></body></html>')"
    return _pages(table(spark, sf_dir, "part"), card).select("page", F.expr(html).alias("html"))


def attempt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines (line, row_ord, chunk): errors are retried, every third one with success on try 2; some lines are no attempts."""
    tries = "CASE WHEN event_type <> 'error' THEN 1 WHEN event_id % 3 = 0 THEN 2 ELSE 3 END"
    rows = table(spark, sf_dir, "events").withColumn("try", F.expr(f"explode(sequence(1, {tries}))"))
    failed = "event_type = 'error' AND NOT (event_id % 3 = 0 AND try = 2)"
    line = f"""concat(rpad(concat('shop', user_id), 12, ' '), ' | GET | https://shop.example/', event_id, ' | try=', try, ' | status=',
      IF({failed}, IF(event_id % 2 = 0, '?', '---'), '200'), ' | ', cast(floor(value * 10) AS bigint) + try, 'ms | ',
      IF({failed}, IF(event_id % 2 = 0, 'FAIL | HTTPError', 'FAIL | ConnectionError: a | b'), 'SUCCESS'))"""
    noise = "IF(event_id % 100 = 0, '  ', 'Traceback (most recent call last):')"
    other = table(spark, sf_dir, "events").filter("event_id % 50 = 0").withColumn("try", F.lit(0))
    written = rows.withColumn("line", F.expr(line)).unionByName(other.withColumn("line", F.expr(noise)))
    return written.select("line", F.struct("ts", "event_id", "try").alias("row_ord"), F.date_trunc("hour", F.col("ts")).alias("chunk"))

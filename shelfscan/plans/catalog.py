"""The registered queries: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import derived_inputs as derived
from shelfscan.functions import keys, text
from shelfscan.functions.numbers import round_half_up
from shelfscan.operators import clean, correlation, dedup, dispersion, fuzzy, leaders, match, quality, sketches, stores, views
from shelfscan.operators.stats import quantiles
from shelfscan.plans.layers import layers_of
from shelfscan.sources import attempt_logs, html_pages, json_payloads, layer_files
from shelfscan.sources.name_index import indexed_search
from shelfscan.sources.schemas import texts
from shelfscan.sources.staging import stage, stage_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

OFFER = ("store_key", "city", "product_name", "price")


def register(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: round_half_up(F.col(c), d) for c, d in digits.items()})


@register
def dedup_listings(spark, sf):
    return dedup.dedup(layers_of(spark, sf).raw).select(*OFFER, "old_price", "category", "sku")


@register
def dedup_policies(spark, sf):
    """Distinct rows per store under each key policy."""
    return dedup.unique_by_policy(layers_of(spark, sf).raw, ("listing", "listing_any_price", "offer", "item"))


@register
def clean_listings(spark, sf):
    return layers_of(spark, sf).processed.select(
        *OFFER, "old_price", "category", "product_name_clean", "brand", "quantity", "unit",
        "qty_normalized", "unit_normalized", "price_per_unit",
    )


@register
def parse_price_text(spark, sf):
    """Prices written as text and parsed back."""
    shown = F.concat(F.lit("Rs. "), F.format_number("price", 2), F.lit("/-"))
    return layers_of(spark, sf).raw.select("store_key", "product_name", "price", text.parse_price(shown).alias("parsed"))


@register
def extract_size(spark, sf):
    return layers_of(spark, sf).processed.select("product_name_clean", "quantity", "unit").distinct()


@register
def price_per_unit(spark, sf):
    total = F.sum(F.col("price_per_unit").cast("decimal(18,2)")).cast("double")
    return layers_of(spark, sf).processed.groupBy("unit_normalized").agg(
        F.count("*").alias("num_rows"), F.count("price_per_unit").alias("priced"), round_half_up(total, 2).alias("total")
    )


@register
def extract_brand(spark, sf):
    names = layers_of(spark, sf).processed.groupBy("brand", "product_name_clean").agg(F.count("*").alias("n"))
    return names.groupBy("brand").agg(F.sum("n").alias("num_rows"), F.count("*").alias("num_names"))


@register
def match_keys(spark, sf):
    return layers_of(spark, sf).keyed.select("product_name_clean", "match_key", "name_key").distinct()


def _match_pass(number: int) -> Query:
    def build(spark, sf):
        rows = layers_of(spark, sf).all_rows.filter(F.col("match_pass") == number)
        per_store = rows.groupBy("match_group", "store_key").agg(F.count("*").alias("n"))
        return per_store.groupBy("match_group").agg(F.sum("n").alias("num_rows"), F.count("*").alias("num_stores"))

    build.__name__ = f"match_pass{number}"
    return build


for _number in (1, 2, 3):
    register(_match_pass(_number))


@register
def match_all(spark, sf):
    return layers_of(spark, sf).all_rows.select(*OFFER, "match_key", "name_key", "match_group", "match_pass")


@register
def match_coverage(spark, sf):
    return match.coverage_by_pass(layers_of(spark, sf).all_rows)


@register
def match_summary(spark, sf):
    return rounded(match.match_summary(layers_of(spark, sf).matched), avg_price=4, price_range=4)


@register
def price_dispersion(spark, sf):
    table = dispersion.price_dispersion(layers_of(spark, sf).profile)
    return rounded(table, mean_price=4, median_price=4, std_price=4, q25=4, q75=4)


@register
def dispersion_summary(spark, sf):
    table = dispersion.dispersion_summary(layers_of(spark, sf).profile)
    return rounded(table, mean_cv=6, median_cv=6, mean_range=6, mean_iqr=6, mean_spread=6)


@register
def category_dispersion(spark, sf):
    return rounded(dispersion.category_dispersion(layers_of(spark, sf).profile), avg_cv=6, avg_range=6)


@register
def top_price_diffs(spark, sf):
    return dispersion.top_price_differences(layers_of(spark, sf).profile)


@register
def rppi_rows(spark, sf):
    return dispersion.price_positions(layers_of(spark, sf).matched).select(*OFFER, "match_group", "rppi")


@register
def rppi_by_store(spark, sf):
    return dispersion.price_positions_by_store(layers_of(spark, sf).matched)


@register
def store_city_metrics(spark, sf):
    layers = layers_of(spark, sf)
    return stores.store_city_metrics(layers.matched, layers.profile)


@register
def price_index_pivot(spark, sf):
    return stores.pivot_small(store_city_metrics(spark, sf), "store_key", "city", "avg_category_price_index")


@register
def store_averages(spark, sf):
    return rounded(stores.averages(layers_of(spark, sf).matched, "store_key"), avg_price=4, median_price=4)


@register
def city_averages(spark, sf):
    return rounded(stores.averages(layers_of(spark, sf).matched, "city"), avg_price=4, median_price=4)


@register
def sketched_quartiles(spark, sf):
    """Quartiles per store from merged store and city sketches: exact ones, and whether the sketched are within the error."""
    layers = layers_of(spark, sf)
    by_store = sketches.sketched_quantiles(sketches.merged(layers.price_sketches, ["store_key"]), ["store_key"])
    errors = sketches.rank_errors(layers.matched, by_store, ["store_key"])
    within = [(F.col(q) <= sketches.RANK_ERROR).alias(f"{q}_within_error") for q in sketches.QUARTERS]
    exact = quantiles(layers.matched.filter("store_key IS NOT NULL"), ["store_key"], "price", {f"exact_{q}": p for q, p in sketches.QUARTERS.items()})
    table = by_store.select("store_key", "num_values").join(errors.select("store_key", *within), "store_key").join(exact, "store_key")
    return rounded(table, exact_q25=4, exact_median=4, exact_q75=4)


@register
def ldi_basic(spark, sf):
    return leaders.leader_counts(layers_of(spark, sf).profile)


@register
def ldi_weighted(spark, sf):
    return leaders.weighted_leader_shares(layers_of(spark, sf).profile)


@register
def ldi_category(spark, sf):
    layers = layers_of(spark, sf)
    return leaders.category_leader_shares(layers.profile, layers.matched)


@register
def category_ldi_pivot(spark, sf):
    return stores.pivot_small(ldi_category(spark, sf), "category", "store_key", "category_ldi", 0.0)


@register
def times_cheapest_rows(spark, sf):
    return leaders.times_cheapest(layers_of(spark, sf).profile)


@register
def corr_size_cv(spark, sf):
    return correlation.size_vs_cv(layers_of(spark, sf).profile)


@register
def corr_competitors_range(spark, sf):
    return correlation.competitors_vs_range(layers_of(spark, sf).profile)


@register
def brand_tiers(spark, sf):
    return rounded(correlation.brand_tiers(layers_of(spark, sf).matched), brand_mean=4)


def _tiered(spark, sf):
    layers = layers_of(spark, sf)
    return correlation.with_tiers(layers.profile, correlation.brand_tiers(layers.matched))


@register
def corr_brand_tier_cv(spark, sf):
    return correlation.tier_vs_cv(_tiered(spark, sf))


@register
def tier_statistics(spark, sf):
    return correlation.tier_statistics(_tiered(spark, sf))


@register
def city_corr_pearson(spark, sf):
    pairs = correlation.pairwise(layers_of(spark, sf).matched, "city", spearman=False)
    return correlation.matrix(pairs, "city", "pearson")


@register
def city_corr_spearman(spark, sf):
    return correlation.matrix(correlation.pairwise(layers_of(spark, sf).matched, "city"), "city", "spearman")


@register
def store_corr(spark, sf):
    return correlation.matrix(correlation.pairwise(layers_of(spark, sf).matched, "store_key", spearman=False), "store", "pearson")


@register
def sync_score(spark, sf):
    return correlation.sync_score(correlation.pairwise(layers_of(spark, sf).matched, "store_key", spearman=False))


@register
def corr_summary(spark, sf):
    reports = [corr_size_cv(spark, sf), corr_competitors_range(spark, sf), corr_brand_tier_cv(spark, sf)]
    return correlation.correlation_summary(reports, sync_score(spark, sf))


@register
def cv_histogram(spark, sf):
    return rounded(dispersion.histogram(layers_of(spark, sf).profile, "cv"), bin_lo=6, bin_hi=6, mean_value=6)


@register
def spread_histogram(spark, sf):
    table = dispersion.histogram(layers_of(spark, sf).profile, "price_spread_ratio", below_quantile=0.99)
    return rounded(table, bin_lo=6, bin_hi=6, mean_value=6)


_FIVE = {"low": 6, "q25": 6, "median": 6, "q75": 6, "high": 6}


@register
def boxplot_range_by_stores(spark, sf):
    return rounded(dispersion.box_plot(layers_of(spark, sf).profile, "num_stores", "price_range"), **_FIVE)


@register
def boxplot_cv_by_tier(spark, sf):
    return rounded(dispersion.box_plot(_tiered(spark, sf), "brand_tier", "cv"), **_FIVE)


@register
def dq_row_counts(spark, sf):
    layers = layers_of(spark, sf)
    return quality.row_counts(
        {"raw": layers.raw, "processed": layers.processed, "all with matches": layers.all_rows, "matched": layers.matched}
    )


@register
def dq_missing(spark, sf):
    return rounded(quality.missing_values(layers_of(spark, sf).processed), missing_pct=6).drop("total")


@register
def dq_duplicates(spark, sf):
    return quality.duplicates(layers_of(spark, sf).processed)


@register
def dq_names_per_store(spark, sf):
    return quality.names_per_store(layers_of(spark, sf).processed)


@register
def dq_price_sanity(spark, sf):
    return rounded(quality.price_sanity(layers_of(spark, sf).processed), mean_price=4, median_price=4)


@register
def dq_coverage(spark, sf):
    return quality.coverage(layers_of(spark, sf).processed)


@register
def dq_store_city_rows(spark, sf):
    return quality.store_city_rows(layers_of(spark, sf).processed)


@register
def dq_match_quality(spark, sf):
    return quality.match_quality(layers_of(spark, sf).profile)


@register
def dq_group_sizes(spark, sf):
    return quality.group_size_counts(layers_of(spark, sf).profile)


@register
def dq_matched_rows_per_store(spark, sf):
    return quality.rows_per_store(layers_of(spark, sf).matched)


@register
def dq_rejections(spark, sf):
    return clean.rejection_counts(layers_of(spark, sf).raw)


@register
def overview_kpis(spark, sf):
    layers = layers_of(spark, sf)
    return rounded(views.overview(layers.raw, layers.profile), avg_price_range=6)


@register
def rows_by_dimension(spark, sf):
    return quality.rows_by_dimension(layers_of(spark, sf).raw)


@register
def store_city_crosstab(spark, sf):
    return views.crosstab(layers_of(spark, sf).raw)


def _hits(spark, sf):
    return views.search(
        layers_of(spark, sf).processed, "red (widget|gear)", ["africa", "asia", "europe"], ["automobile", "building"]
    )


@register
def search_products(spark, sf):
    return views.cheapest_hits(_hits(spark, sf))


@register
def search_stats(spark, sf):
    return rounded(views.hits_by_store(_hits(spark, sf)), mean_price=4)


@register
def search_by_index(spark, sf):
    """A search by way of the name index: only the shards of its trigrams are read."""
    return indexed_search(spark, layers_of(spark, sf).name_index, "large gea?r").drop("row_ord")


@register
def compare_prices(spark, sf):
    table = views.compare(match.match_summary(layers_of(spark, sf).matched), min_range=50, min_stores=3)
    return rounded(table, price_range=4, avg_price=4)


@register
def compare_labels(spark, sf):
    top = views.compare(match.match_summary(layers_of(spark, sf).matched), min_range=50, min_stores=3, k=15)
    return rounded(views.labelled(top), price_range=4)


@register
def browse_layer(spark, sf):
    return views.browse(layers_of(spark, sf).processed, "asia").select(*OFFER, "brand")


@register
def top_brands(spark, sf):
    return clean.top_brands(layers_of(spark, sf).processed)


@register
def extraction_coverage(spark, sf):
    return clean.extraction_coverage(layers_of(spark, sf).processed)


@register
def store_reach(spark, sf):
    raw = layers_of(spark, sf).raw
    return quality.store_reach(raw.withColumn("product_url", F.when(F.col("old_price").isNotNull(), F.col("sku"))))


@register
def replicate_cities(spark, sf):
    """A catalogue copied to other cities, where the store has none yet."""
    raw = layers_of(spark, sf).raw
    source = dedup.dedup(raw).filter("city = 'automobile'")
    return clean.replicate_cities(source, ["automobile", "building", "lahore", "karachi"], raw).select(*OFFER)


@register
def merge_partition(spark, sf):
    """Undiscounted rows as the old partition, discounted rows merged into it."""
    raw = layers_of(spark, sf).raw
    old, new = raw.filter("old_price IS NULL"), raw.filter("old_price IS NOT NULL")
    return dedup.merge_first_wins(old, new, "store_city_merge").select("store_key", "product_name", "city", "price")


def _own_folder(spark, name):
    """A fresh folder beside the stages, for queries that write and read files."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


@register
def layer_round_trip(spark, sf):
    """The rows of merge_partition, by way of files: a version with the old rows, a merge, a merge that fails, the merge again."""
    raw = layers_of(spark, sf).raw
    path = _own_folder(spark, "round-trip")
    layer_files.write_raw(raw.filter("old_price IS NULL"), path, "old")
    new = raw.filter("old_price IS NOT NULL")
    layer_files.merge_into_partitions(spark, path, texts(new), "store_city_merge", "new")
    try:
        failing = F.when(F.col("price") > 0, F.raise_error(F.lit("broken run")).cast("double")).otherwise(F.col("price"))
        layer_files.merge_into_partitions(spark, path, texts(new.withColumn("price", failing)), "store_city_merge", "broken")
    except Exception as error:  # noqa: BLE001
        if "broken run" not in str(error):
            raise
    layer_files.merge_into_partitions(spark, path, texts(new.withColumn("price", F.lit(0.0))), "store_city_merge", "new")
    return layer_files.read_layer(spark, path).select("store_key", "product_name", "city", "price")


@register
def gather_drift(spark, sf):
    """Raw rows written as one dataset per store with drifting schemas, gathered again under the declared one."""
    raw = layers_of(spark, sf).raw.drop("row_ord")
    folder = _own_folder(spark, "drift")
    kinds = {
        0: lambda df: df,
        1: lambda df: df.withColumn("price", F.col("price").cast("string")).drop("old_price", "category"),
        2: lambda df: df.withColumns({"sku": F.concat(F.lit("s"), "sku"), "extra": F.lit(1), "price": F.col("price").cast("decimal(18,4)")}),
    }
    stores = [r["store_key"] for r in raw.select("store_key").distinct().sort("store_key").collect()]  # as many as datasets
    for i, store in enumerate(stores):
        kinds[len(store) % 3](raw.filter(F.col("store_key") == store)).write.parquet(f"{folder}/raw_{i}_all.parquet")
    rows = layer_files.gather_raw(spark, folder)
    return rows.groupBy("store_key", "city").agg(
        F.count(F.lit(1)).alias("num_rows"), F.count("price").alias("priced"), round_half_up(F.sum(F.col("price").cast("decimal(18,2)")).cast("double"), 2).alias("total"),
        F.count("old_price").alias("discounted"), F.count("category").alias("categorised"), F.max(F.length("sku")).cast("long").alias("longest_sku"),
    )


@register
def raw_duplicates(spark, sf):
    """Whole rows and offers that the raw layer repeats."""
    return quality.duplicates(layers_of(spark, sf).raw)


@register
def new_names(spark, sf):
    """Listings of all stores from 1996 on whose name no store had before."""
    raw = layers_of(spark, sf).raw
    since = F.col("scraped_at") >= F.lit("1996-01-01").cast("date")
    fresh = dedup.first_new_names(raw, ~F.coalesce(since, F.lit(False)))
    return fresh.select("store_key", "product_name", "price")


@register
def catalogue_keys(spark, sf):
    name = F.col("product_name_clean")
    key = keys.catalogue_key(name, F.col("quantity"), F.col("unit"))
    return layers_of(spark, sf).processed.select(name, key.alias("catalogue_key")).distinct()


@register
def json_shop_listings(spark, sf):
    rows = json_payloads.shop_listings(derived.shop_payloads(spark, sf), "https://shop.example")
    return rows.select("product_name", "sku", "price", "old_price", "brand", "category", "in_stock", "weight", "product_url")


@register
def json_catalogue_listings(spark, sf):
    rows = json_payloads.catalogue_listings(derived.catalogue_payloads(spark, sf), "https://shop.example")
    return rows.select("product_name", "category", "price", "old_price", "category_hierarchy", "sku", "in_stock")


@register
def json_search_listings(spark, sf):
    rows = json_payloads.search_listings(derived.search_payloads(spark, sf), "https://market.example")
    return rows.select(
        "sku", "product_name", "price", "old_price", "category", "category_hierarchy", "product_url", "image_url"
    )


@register
def json_extra_listings(spark, sf):
    known = derived.table(spark, sf, "part").filter("p_type = 'PROMO'").select(
        F.expr("concat(p_name, ' ', p_size)").alias("product_name")
    )
    rows = json_payloads.extra_search_listings(derived.extra_payloads(spark, sf), known, "https://market.example")
    return rows.select("product_name", "price", "category")


@register
def html_magento(spark, sf):
    pages = derived.card_pages(spark, sf, "magento")
    rows = html_pages.card_listings(pages, html_pages.MAGENTO, "https://store.example")
    return rows.select("product_name", "price", "old_price", "product_url", "image_url")


@register
def html_tolerant(spark, sf):
    pages = derived.card_pages(spark, sf, "tolerant")
    rows = html_pages.card_listings(pages, html_pages.TOLERANT, "https://store.example", amount_first=False)
    return rows.select("product_name", "price", "old_price", "product_url")


@register
def html_tolerant_magento(spark, sf):
    """The tolerant reading of the first layout's pages."""
    pages = derived.card_pages(spark, sf, "magento")
    rows = html_pages.card_listings(pages, html_pages.TOLERANT_MAGENTO, "https://store.example")
    return rows.select("product_name", "price", "old_price", "product_url")


@register
def html_text_priced(spark, sf):
    rows = html_pages.text_priced_listings(derived.card_pages(spark, sf, "text"), "https://store.example")
    return rows.select("product_name", "price", "old_price", "category", "product_url")


@register
def leaf_categories(spark, sf):
    tree = json_payloads.categories(derived.category_payloads(spark, sf))
    return json_payloads.leaf_categories(tree).select("id", "parent_id", "category_name")


def _attempts(spark, sf):
    return stage(attempt_logs.parse_attempts(derived.attempt_lines(spark, sf), "row_ord", "chunk"), "attempts")


@register
def request_audit(spark, sf):
    other = attempt_logs.unparsed_lines(derived.attempt_lines(spark, sf)).select("unparsed_lines").scalar()
    totals = rounded(attempt_logs.attempt_totals(_attempts(spark, sf)), fail_pct=6, ms_median=6, ms_p95=6)
    return totals.withColumn("unparsed_lines", other)


@register
def failure_streaks(spark, sf):
    requests = stage(attempt_logs.requests(_attempts(spark, sf)), "requests")
    streaks = attempt_logs.failure_streaks(requests)
    return streaks.select(
        "store",
        "failures",
        F.col("first_failure.event_id").alias("first_event"),
        F.col("last_failure.event_id").alias("last_event"),
    )


@register
def fuzzy_scores(spark, sf):
    """For every unmatched name and every later store, the most similar name there, if similar enough."""
    best = fuzzy.best_scores(fuzzy.unmatched_names(layers_of(spark, sf).all_rows))
    return best.select("store_a", "name_a", "store_b", "name_b", round_half_up(F.col("score"), 4).alias("score"))


@register
def fuzzy_matches(spark, sf):
    """Fuzzy groups of the unmatched names: groups, their rows and their similarity."""
    links = fuzzy.fuzzy_links(fuzzy.unmatched_names(layers_of(spark, sf).all_rows))
    return links.select(
        "match_group", "store_a", "name_a", "store_b", "name_b",
        (F.col("rows_a") + F.col("rows_b")).alias("num_rows"), round_half_up(F.col("score"), 4).alias("score"),
    )


@register
def match_coverage_fuzzy(spark, sf):
    """Rows by pass, fuzzy links (pass 4) included."""
    return match.coverage_by_pass(layers_of(spark, sf).boosted)

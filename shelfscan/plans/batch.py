"""The full batch over one raw table: clean, match, analyse, check; every layer and result is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.operators import correlation, dispersion, leaders, quality, stores
from shelfscan.operators.clean import clean_listings, rejection_counts
from shelfscan.operators.dispersion import group_profile
from shelfscan.operators.fuzzy import fuzzy_boost
from shelfscan.operators.match import match_listings, match_summary, matched_only, with_match_keys
from shelfscan.sources.layer_files import read_layer, write_matched, write_processed, write_raw, write_results
from shelfscan.sources.staging import stage, tune


def result_tables(matched: DataFrame, profile: DataFrame) -> dict[str, DataFrame]:
    """The analysis tables: one per workbook sheet of the price analysis, plus store, city and leader tables."""
    tiered = correlation.with_tiers(profile, correlation.brand_tiers(matched))
    cities = correlation.pairwise(matched, "city")
    shops = correlation.pairwise(matched, "store_key", spearman=False)
    basic = leaders.leader_counts(profile)
    reports = [
        correlation.size_vs_cv(profile),
        correlation.competitors_vs_range(profile),
        correlation.tier_vs_cv(tiered),
    ]
    return {
        "price_dispersion": dispersion.price_dispersion(profile),
        "dispersion_summary": dispersion.dispersion_summary(profile),
        "relative_price_position_index": dispersion.price_positions_by_store(matched),
        "store_level_metrics": stores.store_city_metrics(matched, profile),
        "store_averages": stores.averages(matched, "store_key"),
        "city_averages": stores.averages(matched, "city"),
        "category_dispersion": dispersion.category_dispersion(profile),
        "basic_ldi": basic.join(leaders.weighted_leader_shares(profile), "store_key", "left"),
        "category_ldi": leaders.category_leader_shares(profile, matched),
        "tier_statistics": correlation.tier_statistics(tiered),
        "city_price_correlation_pearson": correlation.matrix(cities, "city", "pearson"),
        "city_price_correlation_spearman": correlation.matrix(cities, "city", "spearman"),
        "cross_store_synchronization": correlation.matrix(shops, "store", "pearson"),
        "correlation_summary": correlation.correlation_summary(reports, correlation.sync_score(shops)),
        "top_price_differences": dispersion.top_price_differences(profile),
    }


def quality_tables(raw: DataFrame, processed: DataFrame, all_rows: DataFrame, profile: DataFrame) -> dict[str, DataFrame]:
    matched = matched_only(all_rows)
    return {
        "row_counts": quality.row_counts({"raw": raw, "processed": processed, "all": all_rows, "matched": matched}),
        "missing_values": quality.missing_values(processed),
        "duplicates": quality.duplicates(processed),
        "names_per_store": quality.names_per_store(processed),
        "price_sanity": quality.price_sanity(processed),
        "coverage": quality.coverage(processed),
        "store_city_rows": quality.store_city_rows(processed),
        "match_quality": quality.match_quality(profile),
        "group_sizes": quality.group_size_counts(profile),
        "matched_rows_per_store": quality.rows_per_store(matched),
        "rejections": rejection_counts(raw),
    }


def run(spark: SparkSession, raw: DataFrame, folder: str, fuzzy: bool = True, run_name: str | None = None) -> dict[str, str]:
    """Run every step; returns the path of each written table.

    Each layer is written once, as a version, and read back for the next. The processed layer has the match
    keys. ``fuzzy`` turns the links by similarity on or off. A run that is broken off leaves the layers it has not
    reached as they were; under the same ``run_name`` it goes on where it was, and writes no table twice.
    """
    tune(spark)
    written = {"raw": write_raw(raw, f"{folder}/raw", run_name)}
    raw = read_layer(spark, f"{folder}/raw")
    written["processed"] = write_processed(with_match_keys(clean_listings(raw)), f"{folder}/processed", run_name)
    keyed = read_layer(spark, f"{folder}/processed")
    processed = keyed.drop("match_key", "name_key")
    all_rows = match_listings(keyed)
    if fuzzy:
        all_rows = fuzzy_boost(stage(all_rows, "matches"))
    written |= write_matched(all_rows, f"{folder}/matched", run_name)
    all_rows = read_layer(spark, f"{folder}/matched/all_with_matches")
    matched = read_layer(spark, f"{folder}/matched/matched_products")
    written |= write_results({"match_summary": match_summary(matched)}, f"{folder}/matched", run=run_name)
    profile = stage(group_profile(matched), "groups")
    written |= write_results(result_tables(matched, profile), f"{folder}/results", run=run_name)
    written |= write_results(quality_tables(raw, processed, all_rows, profile), f"{folder}/quality", run=run_name)
    return written

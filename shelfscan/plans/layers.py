"""The three layers (raw, processed, matched) and the group profile, each built once per session."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfscan.operators.clean import clean_listings
from shelfscan.operators.dispersion import group_profile
from shelfscan.operators.fuzzy import fuzzy_boost
from shelfscan.operators.match import match_listings, matched_only, with_match_keys
from shelfscan.operators.sketches import price_sketches
from shelfscan.sources.listings import listings
from shelfscan.sources.name_index import build_name_index
from shelfscan.sources.staging import stage, stage_root, tune

_KEYS = ("match_key", "name_key")
_memo: dict[tuple[str, str], Layers] = {}


class Layers:
    """Layers over one raw table. Every layer that is read more than once is staged."""

    def __init__(self, raw: DataFrame):
        self._view = raw

    @cached_property
    def raw(self) -> DataFrame:
        return stage(self._view, "raw")

    @cached_property
    def keyed(self) -> DataFrame:
        return stage(with_match_keys(clean_listings(self.raw)), "processed")

    @cached_property
    def processed(self) -> DataFrame:
        return self.keyed.drop(*_KEYS)

    @cached_property
    def all_rows(self) -> DataFrame:
        return stage(match_listings(self.keyed), "all-with-matches")

    @cached_property
    def matched(self) -> DataFrame:
        return matched_only(self.all_rows)

    @cached_property
    def boosted(self) -> DataFrame:
        """All rows with fuzzy links as pass 4."""
        return stage(fuzzy_boost(self.all_rows), "all-with-fuzzy")

    @cached_property
    def name_index(self) -> str:
        """Folder of the name index of the processed layer."""
        path = f"{stage_root(self.raw.sparkSession)}/name-index-{uuid.uuid4().hex}"
        build_name_index(self.processed, path)
        return path

    @cached_property
    def price_sketches(self) -> DataFrame:
        """A quantile sketch of the prices of every store and city."""
        return stage(price_sketches(self.matched.filter("store_key IS NOT NULL")), "price-sketches")

    @cached_property
    def profile(self) -> DataFrame:
        return stage(group_profile(self.matched), "groups")


def layers_of(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers over the listings of a table folder, shared by all queries of an application."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    tune(spark)
    if key not in _memo:
        _memo[key] = Layers(listings(spark, str(sf_dir)))
    return _memo[key]

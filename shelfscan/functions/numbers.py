"""Numeric expressions shared by the analytics: rounding, guarded ratios, indices, verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, so 0.125 never depends on float noise; nine decimals are kept before, as sums differ beyond."""
    return F.round(c.cast("double").try_cast("decimal(38,9)"), digits).cast("double")


def ratio(a: Column, b: Column) -> Column:
    """Division that gives null instead of an error on zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def cv_percent(std: Column, mean: Column) -> Column:
    return round_half_up(ratio(std, mean) * 100, 2)


def spread_ratio(lo: Column, hi: Column) -> Column:
    return F.when(lo > 0, round_half_up(ratio(hi, lo), 3))


def price_position(price: Column, reference_mean: Column) -> Column:
    """Relative price position index: price over its category mean."""
    return round_half_up(ratio(price, reference_mean), 4)


def missing_status(percent: Column) -> Column:
    return F.when(percent < 5, "OK").when(percent < 20, "WARNING").otherwise("BAD")


def target_status(count: Column, target: int) -> Column:
    return F.when(count >= target, "OK").otherwise("WARN")


def correlation_verdict(r: Column) -> Column:
    """Sign of a correlation outside the +-0.1 band."""
    return F.when(r > 0.1, "positive").when(r < -0.1, "negative").when(r.isNotNull(), "none")


def tier(mean: Column, q33: Column, q66: Column) -> Column:
    """Economy / mid-range / premium from the tercile bounds of brand means."""
    return (
        F.when(mean.isNull(), "unknown")
        .when(mean <= q33, "economy")
        .when(mean <= q66, "mid-range")
        .otherwise("premium")
    )


def tier_code(name: Column) -> Column:
    return F.when(name == "economy", 1).when(name == "mid-range", 2).when(name == "premium", 3)

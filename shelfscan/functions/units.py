"""Pack sizes: extraction, base units and price per unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscan.functions.fixed_values import (
    COUNT_FACTORS,
    SIZE_UNITS,
    UNIT_ALIASES,
    VOLUME_FACTORS,
    WEIGHT_FACTORS,
)
from shelfscan.functions.numbers import round_half_up
from shelfscan.functions.text import literal_map

# a letter, digit or underscore must not follow the unit; possessive, since a unit begins with none of the characters before it
_SIZE = rf"\p{{Nd}}++\.?+\p{{Nd}}*+[\s\p{{Z}}]*+(?:{SIZE_UNITS})(?![\p{{L}}\p{{N}}_])"
_ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"


def size_text(name: Column) -> Column:
    """First ``number unit`` of a name, as written in lower case; '' without one."""
    return F.regexp_extract(F.lower(name), _SIZE, 0)


def quantity(size: Column) -> Column:
    """Number of a size text."""
    plain = F.translate(size, _ARABIC_DIGITS, "0123456789" * 2)
    return F.regexp_extract(plain, r"^[\d.]+", 0).try_cast("double")


def unit(size: Column) -> Column:
    """Canonical unit of a size text."""
    found = F.nullif(F.regexp_extract(size, "[a-z]+$", 0), F.lit(""))
    return F.coalesce(F.try_element_at(literal_map(UNIT_ALIASES), found), found)


def _factor(table: dict, u: Column) -> Column:
    return F.try_element_at(literal_map(table), u)


def base_quantity(qty: Column, u: Column) -> Column:
    """Quantity in grams, millilitres or pieces; unknown units keep their number."""
    factor = F.coalesce(
        _factor(WEIGHT_FACTORS, u), _factor(VOLUME_FACTORS, u), _factor(COUNT_FACTORS, u), F.lit(1.0)
    )
    return F.when(u.isNotNull(), qty * factor)


def base_unit(qty: Column, u: Column) -> Column:
    return F.when(
        qty.isNotNull(),
        F.when(u.isin(*WEIGHT_FACTORS), "g")
        .when(u.isin(*VOLUME_FACTORS), "ml")
        .when(u.isin(*COUNT_FACTORS), "pcs")
        .otherwise(u),
    )


def unit_price(price: Column, base_qty: Column, base: Column) -> Column:
    """Price per kilogram, litre or piece with two decimals; null without a positive base."""
    scale = F.when(base.isin("g", "ml"), 1000.0).when(base == "pcs", 1.0)
    return F.when(base_qty > 0, round_half_up(price / base_qty * scale, 2))

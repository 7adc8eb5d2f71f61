"""Match keys: key base, size token, full key, short key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscan.functions.fixed_values import FILLER_WORDS, KEY_SIZE_UNITS

# possessive: a unit begins with none of the characters before it, so giving some of them back never helps
_SIZES = rf"\p{{Nd}}++\.?+\p{{Nd}}*+[\s\p{{Z}}]*+(?:{KEY_SIZE_UNITS})(?![\p{{L}}\p{{N}}_])"


def brand_slug(brand: Column) -> Column:
    """Brand in lower case with everything but letters and digits squeezed out."""
    named = F.when(F.trim(brand) != "", brand).otherwise(F.lit("unknown"))
    return F.regexp_replace(F.lower(named), "[^a-z0-9]", "")


def without_first(text: Column, part: Column, at: Column) -> Column:
    """Text without ``part`` at position ``at`` (0 = it does not occur)."""
    tail = F.substring(text, at + F.char_length(part), F.char_length(text))
    return F.when(at > 0, F.concat(F.left(text, at - F.lit(1)), tail)).otherwise(text)


def product_words(text: Column, filler: Sequence[str] = FILLER_WORDS) -> Column:
    """Words of a brandless lower-case name joined by underscores: no sizes, punctuation,
    filler or one-character words. A set lookup per word is cheaper than one more regex."""
    plain = F.regexp_replace(F.regexp_replace(text, _SIZES, " "), "[^a-z0-9]+", " ")
    words = F.filter(F.split(plain, " "), lambda word: (F.char_length(word) > 1) & ~word.isin(*filler))
    return F.array_join(words, "_")


def size_token(qty: Column, unit: Column) -> Column:
    """``950_g``, ``1.5_l``; whole quantities without a decimal point, never an exponent."""
    exact = F.regexp_replace(qty.cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    number = (
        F.when((qty == F.floor(qty)) & (qty < 1e15), qty.cast("bigint").cast("string"))
        .when((qty >= 0.001) & (qty < 1e7), qty.cast("string"))
        .otherwise(exact)
    )
    return F.when(unit != "", F.concat(number, F.lit("_"), F.lower(unit)))


def key_base(slug: Column, words: Column) -> Column:
    """Brand and words joined by an underscore."""
    return F.btrim(F.concat_ws("_", slug, words), F.lit("_"))


def long_enough(key: Column) -> Column:
    """Keys of five characters or fewer identify nothing."""
    return F.when(F.char_length(key) > 5, key)


def full_key(base: Column, size: Column) -> Column:
    return F.concat_ws("_", F.nullif(base, F.lit("")), size)


def short_key(key: Column) -> Column:
    """First four tokens of a name key that has more of them (never shorter than seven characters)."""
    return F.nullif(F.regexp_extract(key, r"^([^_]+_[^_]+_[^_]+_[^_]+)_", 1), F.lit(""))


def catalogue_key(name: Column, qty: Column, unit: Column) -> Column:
    """Alternative key ``name__qty_unit`` with the quantity printed as a float."""
    slug = F.replace(
        F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9\s]", ""), r"\s+", " ")),
        F.lit(" "),
        F.lit("_"),
    )
    size = F.when(unit != "", F.concat_ws("_", qty.cast("double").cast("string"), unit))
    sized = F.when(qty.isNotNull(), size)
    key = F.concat_ws("__", F.when(name != "", slug), sized)
    return F.when(key != "", key).otherwise(F.lit("unknown"))

"""Text expressions: cleaning, price text, brands, categories, links.

Everything stays in JVM expressions except Unicode NFKD, which Spark has no builtin
for; that Arrow UDF only ever receives the values that contain non-ASCII characters.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfscan.functions.fixed_values import (
    CATEGORY_BY_KEYWORD,
    CATEGORY_BY_TYPE,
    KNOWN_BRANDS,
    PROMO_FRAGMENTS,
)

# every white-space character other than the plain space
_ODD_SPACES = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
# a marker no cleaned text contains, used to shield word boundaries from initcap
_MARK = "\u0001 "


@F.arrow_udf(StringType())
def _normalize(values: pa.Array) -> pa.Array:
    return pc.utf8_normalize(values, form="NFKD")


# Declared non-deterministic as a fence: a filter on cleaned text would otherwise be
# pushed below the projection (and below a dedup) and run the whole chain a second time.
_nfkd = _normalize.asNondeterministic()


def non_ascii(c: Column) -> Column:
    return F.octet_length(c) > F.char_length(c)


def plain_spaces(c: Column) -> Column:
    """Every white-space character as a plain space."""
    return F.translate(c, _ODD_SPACES, " " * len(_ODD_SPACES))


def single_spaces(plain: Column) -> Column:
    """Runs of plain spaces to one, trimmed; the regex only runs where a run exists."""
    return F.trim(F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain))


def collapse_spaces(c: Column) -> Column:
    """White-space runs to one space, trimmed."""
    return single_spaces(plain_spaces(c))


def normal_text(c: Column) -> Column:
    """NFKD with plain spaces; null becomes ''. Use it as a column of its own: every mention is one more call of the UDF."""
    return plain_spaces(F.coalesce(_nfkd(F.when(non_ascii(c), c)), c, F.lit("")))


def clean_text(c: Column) -> Column:
    """NFKD, white-space runs to one space, trimmed; null becomes ''."""
    return single_spaces(normal_text(c))


def may_have_promo(lower: Column, fragments: Sequence[str] = PROMO_FRAGMENTS) -> Column:
    """Guard in front of the removal chain: a fragment occurs, or case folding is not plain ASCII."""
    guard = non_ascii(lower)
    for fragment in fragments:
        guard = guard | F.contains(lower, F.lit(fragment.lower()))
    return guard


def remove_promos(c: Column, fragments: Sequence[str] = PROMO_FRAGMENTS) -> Column:
    """Remove each fragment in turn, ignoring case and word boundaries."""
    for fragment in fragments:
        c = F.regexp_replace(c, f"(?iu)\\Q{fragment}\\E", "")
    return c


def clean_name(c: Column, fragments: Sequence[str] = PROMO_FRAGMENTS) -> Column:
    return clean_text(remove_promos(clean_text(c), fragments))


def parse_price(c: Column) -> Column:
    """First number of a price text; signs and thousands commas are ignored."""
    bare = F.regexp_replace(c, r"[Rr][Ss]\.?|PKR|pkr|/-|,", "")
    return F.nullif(F.regexp_extract(bare, r"\d+\.?\d*", 0), F.lit("")).try_cast("double")


def to_number(c: Column) -> Column:
    """Numeric coercion: anything that is not a plain number becomes null."""
    text = F.trim(c.cast("string"))
    return F.when(~text.rlike("[dDfF]$"), text).try_cast("double")


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter (``7up`` -> ``7Up``)."""
    shielded = F.regexp_replace(F.lower(c), r"([^a-z ])([a-z])", f"$1{_MARK}$2")
    return F.replace(F.initcap(shielded), F.lit(_MARK), F.lit(""))


def extract_brand(c: Column, brands: Sequence[str] = KNOWN_BRANDS) -> Column:
    """First listed brand that prefixes the name, else the first word, else Unknown.

    Ordered alternation anchored at the start is list order without word boundaries.
    """
    listed = "^(?:" + "|".join(re.escape(b.lower()) for b in brands) + ")"
    known = F.regexp_extract(F.lower(c), listed, 0)
    first = F.regexp_extract(c, r"(?U)^\s*(\S+)", 1)
    # ASCII letters and digits by their name: Java takes ten times as long over the three ranges
    word = F.regexp_replace(first, r"[^\p{Alnum}-]+", "")
    return F.coalesce(F.nullif(title_case(F.coalesce(F.nullif(known, F.lit("")), word)), F.lit("")), F.lit("Unknown"))


def literal_map(entries: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def classify_category(
    product_type: Column,
    tags: Column,
    title: Column,
    by_type: Mapping[str, str] = CATEGORY_BY_TYPE,
    by_keyword: Mapping[str, str] = CATEGORY_BY_KEYWORD,
) -> Column:
    """Exact type, else the first keyword contained in type, tags and title, else general."""
    ptype = F.lower(F.trim(F.coalesce(product_type, F.lit(""))))
    text = F.concat_ws(
        " ", ptype, F.lower(F.coalesce(tags, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    )
    keyword = F.lit("general")
    for word, category in reversed(by_keyword.items()):
        keyword = F.when(F.contains(text, F.lit(word)), F.lit(category)).otherwise(keyword)
    return F.coalesce(F.try_element_at(literal_map(by_type), ptype), keyword)


def category_from_url(url: Column, base: str = "", last: bool = False) -> Column:
    """First (or last) path segment, dashes to spaces, title case; General when blank."""
    path = F.replace(url, F.lit(base), F.lit("")) if base else url
    segment = F.split_part(path, F.lit("/"), F.lit(-1 if last else 1))
    readable = title_case(F.replace(segment, F.lit("-"), F.lit(" ")))
    return F.when(F.coalesce(readable, F.lit("")) != "", readable).otherwise(F.lit("General"))


def breadcrumb(*parts: Column) -> Column:
    """Join the non-blank parts with ' > '."""
    return F.concat_ws(" > ", *[F.nullif(p, F.lit("")) for p in parts])


def absolute_url(url: Column, base: str) -> Column:
    """Complete ``//host/x`` with https: and any other relative link with the base."""
    return (
        F.when(url.isNull() | (url == "") | F.startswith(url, F.lit("http")), url)
        .when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url))
        .otherwise(F.concat(F.lit(base), url))
    )


def label(c: Column, width: int = 40) -> Column:
    return F.left(c, F.lit(width))

"""Product cards of stored HTML pages to listings, by expressions only.

A page is cut at the opening tags of its cards; fields are cut out of a card by patterns,
freed of tags and entities, and cleaned like any other text. A layout is a set of such patterns. An
element is taken to end at the next closing tag of its kind, so a field that holds an element of
its own kind inside is not for these patterns; card pages of the known shops have none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.functions import text


def _opening(tag: str, cls: str) -> str:
    """Pattern of an opening tag with a class that has the given part."""
    return rf"<(?:{tag})\b[^>]*\bclass=[\"'][^\"']*(?:{cls})[^\"']*[\"'][^>]*>"


def _word(cls: str) -> str:
    """A class as a whole word."""
    return rf"(?<![\w-])(?:{cls})(?![\w-])"


@dataclass(frozen=True)
class CardRules:
    """Patterns of a shop's product cards; each field's text is what its groups hold."""

    card: str
    name: str
    price: str = ""
    amount: str = ""
    old: str = ""
    label: str = ""
    link: str = r"<a\b[^>]*\bhref=[\"']([^\"']*)"
    image: tuple[str, ...] = ("data-lazy", "data-src", "src")
    fallback_card: str = ""
    min_name: int = 3
    tight_text: bool = False
    link_from_name: bool = True


_PRICE = _opening(r"\w+", _word("price")) + r"(.*?)</"
# Card patterns per shop layout.
MAGENTO = CardRules(
    card=_opening("li", _word("product-item")),
    fallback_card=_opening(r"\w+", _word("product-item")),
    name=_opening("a", _word("product-item-link")) + r"(.*?)</a>|" + _opening(r"\w+", _word("product-item-name")) + r"\s*<a\b[^>]*>(.*?)</a>",
    amount=r"\bdata-price-amount=[\"']([^\"']*)",
    price=_PRICE,
    old=_opening(r"\w+", _word("old-price")) + r"\s*" + _PRICE,
)
TOLERANT = CardRules(
    card=_opening("li|div|article|section", "product"),
    name=r"<h[234]\b[^>]*>(.*?)</h[234]>|" + _opening(r"\w+", "name|title") + r"(.*?)</",
    price=_opening(r"\w+", "price|" + _word("amount")) + r"(.*?)</",
    old=_opening(r"\w+", "original-price|old-price") + r"(.*?)</|<del\b[^>]*>\s*" + _opening(r"\w+", _word("amount")) + r"(.*?)</",
    image=("data-src", "src"),
    min_name=1,
    link_from_name=False,
)
TOLERANT_MAGENTO = CardRules(
    card=_opening("li|div|article", "product-item|product-card|product-box|" + _word("product")),
    name=_opening("a", _word("product-item-link")) + r"(.*?)</a>|<h[234]\b[^>]*>\s*<a\b[^>]*>(.*?)</a>|"
    + _opening("strong|div|p|span", "name|title") + r"\s*(?:<a\b[^>]*>)?(.*?)</",
    price=_opening(r"\w+", _word("price|product-price")) + r"(.*?)</",
    amount=r"\bdata-price-amount=[\"']([^\"']*)",
    old=r"(?:" + _opening(r"\w+", "old-price|was-price|regular-price") + r"|<del\b[^>]*>)\s*(?:" + _opening(r"\w+", _word("price")) + r")?(.*?)</",
)
TEXT_PRICED = CardRules(
    card=_opening(r"\w+", "single_product_theme"),
    name=_opening("h[1-6]", _word("product_name_theme")) + r"(.*?)</h[1-6]>|" + _opening("b", _word("product_name_theme")) + r"(.*?)</b>",
    link=r"<a\b[^>]*\bhref=[\"']([^\"']*/product/[^\"']*)",
    label=_opening(r"\w+", "cat") + r"(.*?)</",
    image=("src",),
    min_name=1,
    tight_text=True,
    link_from_name=False,
)
# Entities that occur in card texts; the ampersand comes last.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def _shown(html: Column, tight: bool) -> Column:
    """Text of a piece of HTML; tight: white space around tags goes too."""
    bare = F.trim(F.regexp_replace(html, r"\s*<[^>]*>\s*", "")) if tight else F.regexp_replace(html, "<[^>]*>", "")
    for entity, character in _ENTITIES.items():
        bare = F.replace(bare, F.lit(entity), F.lit(character))
    return bare


def _found(card: Column, pattern: str) -> tuple[Column, Column]:
    """What the first match of a pattern covers, and what its groups hold; both null without a match."""
    if not pattern:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    whole = F.nullif(F.regexp_extract(card, "(?is)" + pattern, 0), F.lit(""))
    n = pattern.replace("\\(", "").count("(") - pattern.count("(?")
    held = F.concat(*(F.regexp_extract(card, "(?is)" + pattern, i) for i in range(1, n + 1)))
    return whole, F.when(whole.isNotNull(), held)


def cards(pages: DataFrame, rules: CardRules, html: str = "html") -> DataFrame:
    """One row per card with raw fields; the other page columns stay."""
    others = [c for c in pages.columns if c != html]
    body = F.concat(F.lit(" "), F.regexp_replace(F.col(html), r"(?is)<(script|style|template)\b.*?</\1\s*>|<!--.*?-->", ""))
    cut = F.split(body, f"(?i)(?={rules.card})")
    if rules.fallback_card:
        cut = F.when(body.rlike("(?i)" + rules.card), cut).otherwise(F.split(body, f"(?i)(?={rules.fallback_card})"))
    rows = pages.select(*others, F.posexplode(F.slice(cut, F.lit(2), F.size(cut))).alias("position", "card"))
    card = F.col("card")
    named, name = _found(card, rules.name)
    link = _found(card, rules.link)[1]
    if rules.link_from_name:
        own = F.regexp_extract(named, r"(?is)<a\b[^>]*\bhref=[\"']([^\"']*)", 1)
        link = F.when(named.rlike(r"(?i)<a\b"), F.nullif(own, F.lit(""))).otherwise(link)
    image = F.regexp_extract(card, r"(?is)<img\b[^>]*>", 0)
    source = F.coalesce(*(F.nullif(F.regexp_extract(image, rf"(?is)\s{a}=[\"']([^\"']*)", 1), F.lit("")) for a in rules.image))
    shown = lambda pattern: _shown(_found(card, pattern)[1], rules.tight_text)
    return rows.select(
        *others,
        "position",
        _shown(name, rules.tight_text).alias("name"),
        _found(card, rules.amount)[1].alias("amount"),
        shown(rules.price).alias("price_text"),
        shown(rules.old).alias("old_text"),
        _shown(link, False).alias("link"),
        source.alias("image"),
        shown(rules.label).alias("label"),
        _shown(card, False).alias("all_text"),
    ).filter(F.col("name").isNotNull())


def card_listings(pages: DataFrame, rules: CardRules, site: str, amount_first: bool = True) -> DataFrame:
    """Listings of card pages; the price is the amount attribute, else the price text (or the reverse)."""
    rows = cards(pages, rules)
    others = [c for c in pages.columns if c != "html"]
    amount = text.to_number(F.col("amount"))
    shown = text.parse_price(text.clean_text(F.col("price_text")))
    price = F.coalesce(amount, shown) if amount_first else F.coalesce(shown, amount)
    relative = (F.col("link") != "") & ~F.startswith("link", F.lit("http"))
    return (
        rows.withColumn("product_name", text.clean_text(F.col("name")))
        .filter(F.char_length("product_name") >= rules.min_name)
        .select(
            *others,
            "position",
            "product_name",
            price.alias("price"),
            text.parse_price(text.clean_text(F.col("old_text"))).alias("old_price"),
            F.lit("PKR").alias("currency"),
            F.when(relative, F.concat(F.lit(site), "link")).otherwise(F.col("link")).alias("product_url"),
            F.col("image").alias("image_url"),
        )
    )


def text_priced_listings(pages: DataFrame, site: str, rules: CardRules = TEXT_PRICED) -> DataFrame:
    """Listings of cards whose prices are only text: of the first two prices the higher is the old one."""
    rows = cards(pages, rules)
    others = [c for c in pages.columns if c != "html"]
    numbers = F.transform(
        F.regexp_extract_all("all_text", F.lit(r"Rs\.?\s*([\d,]+)"), 1),
        lambda p: F.replace(p, F.lit(","), F.lit("")).try_cast("double"),
    )
    one, two = F.get("_p", 0), F.get("_p", 1)
    link = F.coalesce("link", F.lit(""))
    relative = (link != "") & ~F.startswith(link, F.lit("http"))
    return (
        rows.filter(F.char_length("name") >= rules.min_name)
        .withColumn("_p", numbers)
        .select(
            *others,
            "position",
            F.coalesce(F.lower("label"), F.lit("general")).alias("category"),
            F.col("name").alias("product_name"),
            F.least(one, two).alias("price"),
            F.when(one != two, F.greatest(one, two)).alias("old_price"),
            F.lit("PKR").alias("currency"),
            F.when(relative, F.concat(F.lit(site), link)).otherwise(link).alias("product_url"),
            F.col("image").alias("image_url"),
        )
    )

"""Declared layer schemas. Sources drift (11 to 18 columns); every read conforms to these."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

_TEXTS = (
    "store store_key source_url city category category_hierarchy product_name currency brand weight unit_type sku "
    "product_url image_url scraped_at"
).split()
RAW = StructType(
    [StructField(name, StringType()) for name in _TEXTS]
    + [StructField("price", DoubleType()), StructField("old_price", DoubleType()), StructField("in_stock", BooleanType())]
)

ROW_ORDER = "row_ord"


def conform(df: DataFrame, schema: StructType = RAW, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the declared columns by name: missing ones null, present ones cast leniently."""
    present = set(df.columns)
    columns = [
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    return df.select(*columns, *[c for c in keep if c in present])


def combine(*frames: DataFrame) -> DataFrame:
    """Union all by column name; columns a frame lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def texts(df: DataFrame, columns=("sku", "product_url", "brand", "category", "source_url")) -> DataFrame:
    """Force columns of mixed type to string before a write."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns if c in df.columns})

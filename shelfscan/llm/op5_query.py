"""Query of the secret scan over all documents; values are shown as digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.secrets import scan_secrets


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return scan_secrets(docs).select(
        F.col("id").alias("doc_id"),
        F.col("at").cast("long").alias("word"),
        F.sha2("value", 256).alias("value_sha256"),
        F.col("length").cast("long").alias("length"),
        "transitions",
        "dictionary",
        "probability",
        "is_secret",
    )


QUERIES = {"op5_secret_scan": secret_scan}

"""Query of SimHash near-dedup over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.simhash import near_duplicates


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return marked.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES = {"op7_simhash_near_dedup": simhash_near_dedup}

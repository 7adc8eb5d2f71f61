"""Query of the quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm.quality import quality_measures


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_measures(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


QUERIES = {"op6_quality_rules": quality_rules}

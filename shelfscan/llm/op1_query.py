"""Query of line dedup over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm.line_dedup import remove_repeated_passages


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


QUERIES = {"op1_line_dedup": line_dedup}

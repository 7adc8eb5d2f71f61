"""Query of approximate nearest neighbours over all embeddings, for every fiftieth of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.nn_descent import nearest


def approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = nearest(rows, F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {"op12_approximate_neighbours": approximate_neighbours}

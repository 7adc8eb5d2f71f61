"""Query of BPE encoding and decoding over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm.bpe import encode_rows


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


QUERIES = {"op3_bpe_round_trip": bpe_round_trip}

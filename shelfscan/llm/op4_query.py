"""Query of benchmark decontamination over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.decontamination import contamination


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {"op4_decontamination": decontamination}

ORACLE = {
    "op4_decontamination": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS run
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i) WHERE len(words) > 0
), windows AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS run
  FROM texts, (SELECT DISTINCT n FROM phrases), LATERAL (SELECT unnest(range(1, len(words) - n + 2)) AS i)
), found AS (
  SELECT doc_id, i, n, item_id FROM windows JOIN phrases USING (n, run)
), hits AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, LATERAL (SELECT unnest(range(0, n)) AS k) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
}

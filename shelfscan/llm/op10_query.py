"""Query of substring dedup over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.substring_dedup import remove_repeats


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op10_substring_dedup": substring_dedup}

ORACLE = {
    "op10_substring_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run
  FROM texts, LATERAL (SELECT unnest(range(1, len(words) - 11)) AS i)
), repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT run, min(doc_id) AS owner FROM windows GROUP BY run) USING (run)
  WHERE owner < doc_id
), removed AS (
  SELECT DISTINCT doc_id, i + k AS i FROM repeated, (SELECT unnest(range(0, 13)) AS k)
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
  FROM placed ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
}

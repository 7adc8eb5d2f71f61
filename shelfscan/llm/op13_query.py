"""Query of the conversation prefix trie over all conversations, each rebuilt from its hundred's first one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.prefix_trie import prefix_trie

#: A base every so many ids, and heads of fewer turns than this.
EVERY, HEADS = 100, 6


def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    conv = F.col("conv_id")
    plan = rows.where(conv.isNotNull()).select("conv_id").distinct().select(
        conv.alias("conv"), (conv - conv % EVERY).alias("base"), (F.crc32(conv.cast("string").cast("binary")) % HEADS).alias("head")
    )
    nodes = prefix_trie(rows, plan)
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


QUERIES = {"op13_conversation_prefix_trie": conversation_prefix_trie}

#: crc32 bit by bit over the digits; sequences as lists; descendants by comparing list prefixes.
ORACLE = {
    "op13_conversation_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), planned AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(list_reduce(
    [4294967295::BIGINT] || list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
    lambda c, d: list_reduce([xor(c, d)] || range(8), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))
  ), 4294967295) % 6 AS head
  FROM turns
), rebuilt AS (
  SELECT p.conv_id, coalesce(b.own[1:p.head], []) || p.own[p.head + 1:] AS path
  FROM planned p LEFT JOIN turns b ON b.conv_id = p.base
), prefixes AS (
  SELECT conv_id, d AS depth, path[1:d] AS node, len(path) AS size FROM rebuilt, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN (count(*) - 1) * length(node[depth].text) ELSE 0 END AS saved
  FROM prefixes GROUP BY depth, node
), children AS (
  SELECT p.depth, p.node, count(*) AS n_children FROM nodes p JOIN nodes c ON c.depth = p.depth + 1 AND c.node[1:p.depth] = p.node GROUP BY ALL
), below AS (
  SELECT a.depth, a.node, sum(b.saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM nodes a JOIN (SELECT * FROM nodes LEFT JOIN children USING (depth, node)) b ON b.depth >= a.depth AND b.node[1:a.depth] = a.node
  GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (depth, node) LEFT JOIN children USING (depth, node)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""
}

"""Query of periodic run detection over all documents, a tenth of which get a repeated tail first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.periodic_runs import periodic_runs


def _with_tails(docs: DataFrame) -> DataFrame:
    """In every document whose crc32 ends in 0, the words from a on become repeats of the p words from a on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    chosen = chosen.withColumn("n", n).withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    chosen = chosen.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = F.col("n") - F.col("a")
    times = F.ceil(left / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), left)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(_with_tails(docs))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("length")))
    best = F.array_min(order)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        _digest(F.array_join(line, "")).alias("runs_sha256"),
        _digest(F.col("kept")).alias("collapsed_sha256"),
    )


QUERIES = {"op11_periodic_run_detection": periodic_run_detection}

#: Equal words at every distance up to a quarter of the text, islands of them, smallest period of each stretch.
ORACLE = {
    "op11_periodic_run_detection": r"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, xor(list_reduce(
    [4294967295::BIGINT] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda c, d: list_reduce([xor(c, d)] || range(8), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))
  ), 4294967295) AS h
  FROM documents
), sized AS (
  SELECT *, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a, h // 10 AS g FROM hashed
), chosen AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM sized
), placed AS (
  SELECT doc_id, n, i, words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM chosen, LATERAL (SELECT unnest(range(0, n)) AS i)
), equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM placed x JOIN placed y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
    first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM placed ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
}

"""Query of the license scan over all documents; a document's path is source/language/id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.llm.licenses import KEYWORDS, MIN_FILE, MIN_HEADER, TEMPLATES, TERM, scan_licenses


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan_licenses(docs, "doc_id", path).withColumnRenamed("id", "doc_id")


QUERIES = {"op8_license_scan": license_scan}

_ROWS = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
ORACLE = {
    "op8_license_scan": rf"""
WITH RECURSIVE templates(template, license, text) AS (VALUES {_ROWS}),
files AS (
  SELECT doc_id, coalesce(source || '/', '') || coalesce(lang || '/', '') || doc_id AS path, text,
    coalesce(source, '') || CASE WHEN source IS NULL OR lang IS NULL THEN '' ELSE '/' END || coalesce(lang, '') AS dir FROM documents
), candidates AS (
  SELECT doc_id, dir, 'file' AS kind, text FROM files WHERE regexp_matches(text, '{KEYWORDS}')
  UNION ALL
  SELECT doc_id, dir, 'header', line FROM (SELECT doc_id, dir, unnest(string_split(text, chr(10))) AS line FROM files)
  WHERE regexp_matches(line, '{KEYWORDS}')
), counted AS (
  SELECT text, count(*) AS n FROM candidates WHERE kind = 'header' GROUP BY text UNION ALL SELECT text, 1 FROM templates
), total AS (SELECT sum(n) AS total FROM counted),
idf AS (
  SELECT term, ln((1 + max(total)) / (1.0 + sum(n))) + 1 AS idf
  FROM (SELECT n, unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) AS term FROM counted), total GROUP BY term
), texts AS (SELECT DISTINCT text FROM candidates UNION SELECT text FROM templates),
weighed AS (
  SELECT text, term, count(*) * coalesce(max(idf), (SELECT ln(1 + total) + 1 FROM total)) AS w
  FROM (SELECT text, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM texts) LEFT JOIN idf USING (term)
  GROUP BY text, term
), unit AS (SELECT text, term, w / sqrt(sum(w * w) OVER (PARTITION BY text)) AS w FROM weighed),
scores AS (
  SELECT u.text, t.license, t.template, sum(u.w * v.w) AS score
  FROM unit u JOIN unit v USING (term) JOIN templates t ON t.text = v.text GROUP BY u.text, t.license, t.template
), best AS (
  SELECT text, license, round(max(score), 6) AS score FROM scores GROUP BY text, license
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY round(max(score), 6) DESC, license) = 1
), own AS (
  SELECT doc_id, dir, license, score, kind FROM candidates JOIN best USING (text)
  WHERE score >= CASE kind WHEN 'file' THEN {MIN_FILE} ELSE {MIN_HEADER} END
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY kind, score DESC, license) = 1
), ruled AS (
  SELECT dir, license FROM own WHERE kind = 'file' QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
)
SELECT f.doc_id, f.path, coalesce(o.license, r.license) AS license, o.score,
  CASE WHEN o.license IS NOT NULL THEN o.kind WHEN r.license IS NOT NULL THEN 'inherited' END AS found_in,
  CASE WHEN o.license IS NULL THEN r.dir END AS licensed_by
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN ruled r ON r.dir = f.dir
"""
}

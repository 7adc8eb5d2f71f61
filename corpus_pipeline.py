"""From raw documents to token ids: five stages, each written and read again before the next.

Quality rules drop rejected documents; line dedup cuts repeated chunks out of texts; of near-duplicate
documents the one with the smallest id stays; documents that hold a benchmark passage
go; the rest is encoded. All stages but the last return the columns of documents.

* null, empty and very short texts: rejected by the quality rules; a text that line dedup empties goes on as an empty one, and all
  empty ones are near duplicates of each other
* null id: judged by its text as others; it owns no first occurrence of a line, and stays in the near-duplicate stage
* ties and repeated rows: equal texts are near duplicates, so rows of one id stay; repeated rows of that id all stay
* very long texts: every stage works on the whole text
* empty table: every stage returns an empty table with its columns; other columns are kept, whatever their names
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm import bpe, decontamination, line_dedup, quality, simhash
from shelfscan.sources.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_rows(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_rows(docs, keep_ids=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("bpe encoding and decoding", encode),
]

#: Fertility and fingerprints have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{i}")
    return docs

"""An index of listing names by trigrams, as clustered parquet tables.

* ``postings``: (gram, name_id), a folder per shard of the gram's hash, sorted by gram
* ``names``: (name_id, name, part)
* ``rows``: the layer's rows, a folder per part of the name's hash

A search takes the trigrams that every hit must hold from the pattern, reads their shards, keeps names that have all of
them, verifies these with the pattern itself, and reads the parts of the layer that hold verified names. Rows are those of the scan
(``views.search``): trigrams are of lower-case ASCII characters only, and names with other characters are always verified,
since they may match a pattern in ways that lower case does not show. A pattern without a sure trigram
verifies all names, once each.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, PARTS = 64, 64
_GRAM = 3
_RESULT = ("product_name_clean", "brand", "price", "store_key", "city", "category", "row_ord")


def _shard(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SHARDS)).cast("int")


def build_name_index(layer: DataFrame, path: str, name: str = "product_name_clean") -> None:
    """Write the index of a layer; null names are in no hit and are left out."""
    rows = layer.filter(F.col(name).isNotNull())
    part = F.pmod(F.xxhash64(name), F.lit(PARTS)).cast("int")
    rows.withColumn("part", part).hint("rebalance", "part").write.mode("overwrite").option("compression", "zstd").partitionBy("part").parquet(f"{path}/rows")
    names = rows.select(F.col(name).alias("name")).distinct().withColumn("name_id", F.monotonically_increasing_id())
    names.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(PARTS)).cast("int")).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/names")
    stored = layer.sparkSession.read.parquet(f"{path}/names")
    lower = F.lower("name")
    starts = F.sequence(F.lit(1), F.length(lower) - _GRAM + 1)
    grams = F.when(F.length(lower) >= _GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(lower, i, F.lit(_GRAM)))))
    plain = F.octet_length("name") == F.length("name")
    held = stored.select("name_id", F.explode(F.when(plain, grams).otherwise(F.array(F.lit("")))).alias("gram"))
    # a common trigram is in very many names: a large shard is split over files. No ranges: to sample them, all trigrams would be made twice
    clustered = held.withColumn("shard", _shard(F.col("gram"))).hint("rebalance", "shard").sortWithinPartitions("shard", "gram", "name_id")
    clustered.write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(f"{path}/postings")


def sure_trigrams(pattern: str, literal: bool = False) -> list[str]:
    """Trigrams of plain characters that stand next to each other in every match of the pattern; fewer than there may be, never too many."""
    runs, run = [], ""
    if literal:
        runs = re.findall(r"[ -~]+", pattern)
    elif not re.search(r"[|()]|\\[QE]", pattern):
        # one piece: an escape, a class, or a character, with its quantifier
        for piece, quantifier in re.findall(r"(\\.|\[(?:\\.|[^\]\\])*\]|.)([?*+]|\{[^}]*\})?[?+]?", pattern, re.DOTALL):
            plain = piece[1] if piece[0] == "\\" and not piece[1].isalnum() else piece
            if len(plain) == 1 and " " <= plain <= "~" and (piece != plain or plain not in ".^$"):
                if quantifier:
                    runs.append(run + plain if quantifier == "+" else run)
                    run = plain if quantifier == "+" else ""
                else:
                    run += plain
            else:
                runs.append(run)
                run = ""
        runs.append(run)
    return sorted({r[i : i + _GRAM].lower() for r in runs for i in range(len(r) - _GRAM + 1)})


def candidate_postings(spark: SparkSession, path: str, grams: Sequence[str]) -> DataFrame:
    """The postings of the given trigrams; other shards are not read."""
    shards = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "gram STRING").select(_shard(F.col("gram"))).distinct().collect()]
    return spark.read.parquet(f"{path}/postings").filter(F.col("shard").isin(shards) & F.col("gram").isin(list(grams)))


def indexed_search(
    spark: SparkSession,
    path: str,
    pattern: str,
    stores: Sequence[str] | None = None,
    cities: Sequence[str] | None = None,
    literal: bool = False,
) -> DataFrame:
    """Listings whose name contains the pattern (a regex unless ``literal``), ignoring case."""
    names = spark.read.parquet(f"{path}/names")
    grams = sure_trigrams(pattern, literal)
    if grams:
        found = candidate_postings(spark, path, grams).groupBy("name_id").agg(F.count(F.lit(1)).alias("n"))
        others = candidate_postings(spark, path, [""]).select("name_id")
        names = names.join(found.filter(F.col("n") == len(grams)).select("name_id").unionByName(others), "name_id", "left_semi")
    text = re.escape(pattern) if literal else pattern
    verified = names.filter(F.col("name").rlike(f"(?iu){text}")).select(F.col("name").alias("product_name_clean"), "part")
    hits = spark.read.parquet(f"{path}/rows").join(verified, ["part", "product_name_clean"])
    if stores is not None:
        hits = hits.filter(F.col("store_key").isin(*stores))
    if cities is not None:
        hits = hits.filter(F.col("city").isin(*cities))
    return hits.select(*_RESULT)

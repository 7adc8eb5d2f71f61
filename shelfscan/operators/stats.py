"""Distributed statistics: first value, exact quantiles, average ranks, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.functions.numbers import ratio
from shelfscan.sources.schemas import ROW_ORDER
from shelfscan.sources.staging import stage

# buckets per doubling of a value; a bucket is what one task sorts
_RESOLUTION = 1024
_ORIGIN = 2_000_000


def first_known(source: str, alias: str | None = None, order: str = ROW_ORDER) -> Column:
    """First non-null value of a column in row order (an aggregate)."""
    present = F.when(F.col(source).isNotNull(), F.struct(F.col(order).alias("o"), F.col(source).alias("v")))
    return F.min(present)["v"].alias(alias or source)


def _bucket(value: Column) -> Column:
    """A monotone bucket number: nearby values share one, and the data does not decide which."""
    size = F.floor(F.log2(F.abs(value)) * _RESOLUTION) + _ORIGIN
    number = F.when(value > 0, size).when(value < 0, -size).cast("bigint")
    # never null: a null check on the join key would differ between the two uses of the counts
    return F.coalesce(number, F.lit(0).cast("bigint"))


def ranked_values(df: DataFrame, keys: Sequence[str], value: str, weight: Column | None = None) -> DataFrame:
    """Distinct values per key with ``n``, the number of smaller entries ``below`` and ``total``.

    Values are counted first (combined map-side), then laid out in buckets whose totals
    give each bucket its offset. The largest unit of work is one bucket of distinct values,
    whatever the skew: there is no global sort and no key is held by one task. Rows with a
    null key or value are left out. The join and the last window share one partitioning.
    """
    keys = list(keys)
    place = [*keys, "_bucket"]
    n = F.count("*") if weight is None else F.sum(weight)
    counts = (
        df.na.drop(subset=[*keys, value])
        .groupBy(*keys, F.col(value).cast("double").alias(value))
        .agg(n.cast("bigint").alias("n"))
        .withColumn("_bucket", _bucket(F.col(value)))
    )
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))
    before = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.groupBy(*place)
        .agg(F.sum("n").alias("_n"))
        .withColumns({"_offset": F.coalesce(F.sum("_n").over(before), F.lit(0)), "total": F.sum("_n").over(by_key)})
        .drop("_n")
    )
    inside = Window.partitionBy(*place).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return counts.join(buckets, place).withColumn("below", below).select(*keys, value, "n", "below", "total")


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    weight: Column | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per key: one column per entry of ``probs``."""
    ranked = ranked_values(df, keys, value, weight)
    last = (F.col("total") - 1).cast("double")
    aggregates = []
    for i, p in enumerate(probs.values()):
        for side, index in (("lo", F.floor(last * p)), ("hi", F.ceil(last * p))):
            hit = (F.col("below") <= index) & (index < F.col("below") + F.col("n"))
            aggregates.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}{i}"))
    picked = ranked.groupBy(*keys).agg(F.max("total").alias("_total"), *aggregates)
    at = [(F.col("_total") - 1).cast("double") * p for p in probs.values()]
    return picked.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at[i] - F.floor(at[i]))).alias(name)
            for i, name in enumerate(probs)
        ],
    )


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, rank: str) -> DataFrame:
    """Distinct values per key with their average rank (ties share the mean of their places)."""
    ranked = ranked_values(df, keys, value)
    return ranked.select(*keys, value, (F.col("below") + (F.col("n") + 1) / 2).alias(rank))


def pearson(x: str, y: str) -> Column:
    """Correlation aggregate that is null, not an error, when a side does not vary."""
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlate(df: DataFrame, x: str, y: str, keys: Sequence[str] = (), spearman: bool = True, stored: bool = False) -> DataFrame:
    """Pearson, and Spearman unless it is not wanted, of two columns per key over complete cases.

    Spearman is Pearson on average ranks, of both columns in one ranking. The complete cases are read by the rows and by
    the ranking, so they are staged, unless ``stored`` says that they are cheap to read twice.
    """
    keys = list(keys)
    complete = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    complete = complete.na.drop()
    results = [F.count("*").alias("n"), pearson("x", "y").alias("pearson")]
    if spearman:
        complete = ranked = complete if stored else stage(complete, "complete")
        both = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("value")) for side in ("x", "y")]))
        entries = complete.select(*keys, both.alias("e")).select(*keys, "e.side", "e.value")
        # staged: few distinct values are then broadcast, many are joined by a shuffle
        ranks = stage(average_ranks(entries, [*keys, "side"], "value", "rank"), "ranks")
        for side in ("x", "y"):
            of_side = ranks.filter(F.col("side") == side).drop("side").withColumnsRenamed({"value": side, "rank": f"rank_{side}"})
            ranked = ranked.join(of_side, [*keys, side])
        complete = ranked
        results.append(pearson("rank_x", "rank_y").alias("spearman"))
    return complete.groupBy(*keys).agg(*results)

"""Request-attempt log lines to rows, requests, totals and failure streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfscan.operators.stats import quantiles

_LINE = (
    r"^\s*(?:.* \| )??([^|\s]+)\s*\| ([A-Z]+) \| (.*?) \| try=(\d+) \| status=(\S+) \| (\d+)ms \| (SUCCESS|FAIL)(?: \| (.*))?$"
)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with an order (file, block, place in the block) and the block as chunk, as ``requests`` wants them.

    Files are ordered by name. A block is what one task reads of a file; lines never cross it.
    """
    block = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    order = F.struct(block.alias("at"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select(F.col("value").alias("line"), order.alias("row_ord"), block.alias("chunk"))


def unparsed_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no attempts: their number, and how many of them are blank."""
    other = lines.filter(~F.coalesce(F.col("line").rlike(_LINE), F.lit(False)))
    return other.agg(
        F.count(F.lit(1)).alias("unparsed_lines"), F.count_if(F.trim(F.coalesce("line", F.lit(""))) == "").alias("blank_lines")
    )


def parse_attempts(lines: DataFrame, *keep: str) -> DataFrame:
    """Fields of attempt lines; ``unparsed_lines`` counts the others. The detail may contain the separator."""
    group = lambda i: F.regexp_extract("line", _LINE, i)
    return lines.filter(F.col("line").rlike(_LINE)).select(
        *keep,
        group(1).alias("store"),
        group(2).alias("method"),
        group(3).alias("url"),
        group(4).cast("int").alias("attempt"),
        group(5).alias("status"),
        group(6).cast("bigint").alias("ms"),
        (group(7) == "FAIL").alias("failed"),
        F.nullif(group(8), F.lit("")).alias("detail"),
    )


def attempt_totals(attempts: DataFrame) -> DataFrame:
    """Per store: attempts, failures, failure percent, latency median and 95th percentile."""
    counts = attempts.groupBy("store").agg(
        F.count("*").alias("total_requests"), F.count_if("failed").alias("failed_requests")
    )
    latency = quantiles(attempts, ["store"], "ms", {"ms_median": 0.5, "ms_p95": 0.95})
    return counts.join(latency, "store").withColumn(
        "fail_pct", F.col("failed_requests") * 100.0 / F.col("total_requests")
    )


def _running_count(rows: DataFrame, flag: Column, order: str, chunk: str, name: str) -> DataFrame:
    """Number of flagged rows of a store up to and including each row.

    Counted inside chunks (pieces of the order), then shifted by the totals of earlier
    chunks, so a store with most of the log is still spread over its chunks.
    """
    inside = Window.partitionBy("store", chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("store").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    flagged = rows.withColumn("_flag", flag.cast("bigint"))
    offsets = (
        flagged.groupBy("store", chunk)
        .agg(F.sum("_flag").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return (
        flagged.join(offsets, ["store", chunk])
        .withColumn(name, F.col("_offset") + F.sum("_flag").over(inside))
        .drop("_flag", "_offset")
    )


def requests(attempts: DataFrame, order: str = "row_ord", chunk: str = "chunk") -> DataFrame:
    """Attempts joined into requests: a request starts at try 1 and has the outcome of its last try.

    Reads ``attempts`` twice, as ``failure_streaks`` reads its requests: give stored or staged tables.
    """
    numbered = _running_count(attempts, F.col("attempt") == 1, order, chunk, "request_no")
    last = F.max(F.struct(F.col(order), F.col("failed"), F.col(chunk)))
    return (
        numbered.groupBy("store", "request_no")
        .agg(last.alias("_l"), F.count("*").alias("attempts"))
        .select(
            "store",
            "request_no",
            "attempts",
            F.col("_l.failed").alias("failed"),
            F.col(f"_l.{order}").alias(order),
            F.col(f"_l.{chunk}").alias(chunk),
        )
    )


def failure_streaks(
    reqs: DataFrame, at_least: int = 3, order: str = "row_ord", chunk: str = "chunk"
) -> DataFrame:
    """Runs of failed requests per store: a success resets, a run of ``at_least`` marks the store down.

    Failures with the same number of earlier successes are one run, also across chunks.
    """
    counted = _running_count(reqs, ~F.col("failed"), order, chunk, "_successes")
    runs = counted.filter("failed").groupBy("store", "_successes").agg(
        F.count("*").alias("failures"), F.min(order).alias("first_failure"), F.max(order).alias("last_failure")
    )
    return runs.filter(F.col("failures") >= at_least).drop("_successes")

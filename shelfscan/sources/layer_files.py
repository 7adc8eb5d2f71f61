"""Layer files: reading drifting sources, writing partitioned layers and result tables as versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfscan.operators.clean import replicate_cities
from shelfscan.operators.dedup import merge_first_wins
from shelfscan.sources.schemas import ROW_ORDER, combine, conform, texts
from shelfscan.sources.staging import stage
from shelfscan.sources.versions import Snapshot, glob, read_version, snapshot, write_version

#: Datasets whose footers are read at a time.
_FOOTERS = 16


def with_row_order(df: DataFrame) -> DataFrame:
    """Add the row order of file sources: file name, then row index."""
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return df.withColumn(ROW_ORDER, place)


def read_layer(spark: SparkSession, path: str) -> DataFrame | None:
    """A layer's newest version (or plain parquet) as one table, or None when it does not exist."""
    versioned = read_version(spark, path)
    if versioned is not None:
        return versioned
    return spark.read.parquet(path) if glob(spark, path) else None


def read_matched_pair(spark: SparkSession, matched: str, processed: str) -> tuple[DataFrame, DataFrame | None]:
    """The matched layer, which must exist, and the processed layer, which may be missing."""
    rows = read_layer(spark, matched)
    if rows is None:
        raise FileNotFoundError(matched)
    return rows, read_layer(spark, processed)


def gather_raw(spark: SparkSession, folder: str, pattern: str = "raw_*_*.parquet") -> DataFrame:
    """All ``raw_STORE_CITY`` datasets of a folder under the declared raw schema.

    Physical schemas drift between datasets (an id may be a number in one and text in
    the next). Datasets with the same physical schema are one scan; the scans are conformed, and unioned by
    name. Footers are read by Spark tasks, several datasets at a time; only schemas pass through the driver. A dataset that
    cannot be read is an error; see ``readable_datasets``.
    """
    return gather_datasets(spark, glob(spark, f"{folder}/{pattern}"))


def _schemas(spark: SparkSession, paths: Sequence[str]) -> list[StructType | Exception]:
    """Each dataset's schema, or why it has none."""

    def schema(path: str) -> StructType | Exception:
        try:
            return spark.read.parquet(path).schema
        except (PySparkException, Py4JJavaError) as error:
            return error

    with ThreadPoolExecutor(_FOOTERS) as pool:
        return list(pool.map(schema, paths))


def gather_datasets(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The given datasets under the declared raw schema: one scan for each physical schema among them."""
    if not paths:
        raise FileNotFoundError("no raw dataset")
    classes: dict[str, tuple[StructType, list[str]]] = {}
    for path, schema in zip(paths, _schemas(spark, paths), strict=True):
        if isinstance(schema, Exception):
            raise schema
        classes.setdefault(schema.json(), (schema, []))[1].append(path)
    scans = (with_row_order(spark.read.schema(schema).parquet(*members)) for schema, members in classes.values())
    return combine(*(conform(scan, keep=(ROW_ORDER,)) for scan in scans))


def readable_datasets(spark: SparkSession, folder: str, pattern: str = "raw_*_*.parquet") -> DataFrame:
    """(path, error) of every dataset of a folder; the error is null where its footer can be read.

    For callers who want to leave datasets out: they pass the good paths to ``gather_datasets``
    and keep this table as the record of what was skipped.
    """
    paths = glob(spark, f"{folder}/{pattern}")
    states = [str(s).splitlines()[0] if isinstance(s, Exception) else None for s in _schemas(spark, paths)]
    return spark.createDataFrame(list(zip(paths, states, strict=True)), "path STRING, error STRING")


def write_raw(df: DataFrame, path: str, run: str | None = None) -> str:
    return folder_of(write_version(texts(df), path, ("store_key", "city"), run))


def write_processed(df: DataFrame, path: str, run: str | None = None) -> str:
    """One dataset for all stores; reading one store prunes to its partition."""
    return folder_of(write_version(df, path, ("store_key",), run))


def folder_of(held: Snapshot) -> str:
    """Where a version without folders of older ones lies."""
    return f"{held.path}/data/{held.folders[0].split('/')[0]}" if held.folders else f"{held.path}/data"


def write_matched(all_rows: DataFrame, folder: str, run: str | None = None) -> dict[str, str]:
    """All rows with match information, and the matched rows only, read back from those."""
    paths = {"all_with_matches": folder_of(write_version(all_rows, f"{folder}/all_with_matches", run=run))}
    stored = read_version(all_rows.sparkSession, f"{folder}/all_with_matches").filter(F.col("match_group").isNotNull())
    return paths | {"matched_products": folder_of(write_version(stored, f"{folder}/matched_products", run=run))}


def write_results(tables: Mapping[str, DataFrame], folder: str, form: str = "parquet", run: str | None = None) -> dict[str, str]:
    """One dataset per result table, parquet (a new version of each) or csv."""
    paths = {}
    for name, table in tables.items():
        if form == "csv":
            paths[name] = f"{folder}/{name}"
            table.write.mode("overwrite").option("header", True).csv(paths[name])
        else:
            paths[name] = folder_of(write_version(table, f"{folder}/{name}", run=run))
    return paths


def merge_into_partitions(
    spark: SparkSession, path: str, new: DataFrame, policy: str = "city_merge", run: str | None = None
) -> None:
    """A new version with the partitions that ``new`` touches replaced or added; rows already there win over equal keys.

    The touched partitions are stored first: their size is then known, and while they are few no old row is shuffled to meet them.
    """
    base = snapshot(spark, path)
    if base is not None and run in base.runs:
        return
    merged = new
    if base is not None:
        touched = stage(new.select("store_key", "city").distinct(), "touched")
        old = read_version(spark, path, base.number).join(touched, ["store_key", "city"], "left_semi")
        merged = merge_first_wins(old, new, policy)
    write_version(merged, path, ("store_key", "city"), run, keep_others=True, base=base)


def replicate_store(
    spark: SparkSession, path: str, store: str, source_city: str, cities: Sequence[str], run: str | None = None
) -> None:
    """Add a store's catalogue under further cities, as a new version; cities it already has are skipped."""
    base = snapshot(spark, path)
    rows = read_version(spark, path, base.number).filter(F.col("store_key") == store)
    copies = replicate_cities(rows.filter(F.col("city") == source_city), cities, rows)
    write_version(copies, path, ("store_key", "city"), run, keep_others=True, base=base)

"""Versioned tables of parquet files: every write goes to a fresh folder, a small manifest makes it visible.

``PATH/data/version=ID/[partition=VALUE/...]`` holds what one write produced. ``PATH/manifests/NUMBER.json`` lists the
folders that make up a version, its schema and the runs that led to it. Readers take the highest
manifest and read the folders it lists, so they see one version as a whole; a run that
fails before its manifest changes nothing, and a run name that has been committed before is not written again.
A version may take over folders of the one before, so a merge writes the partitions it touches and no others.
A manifest is renamed into place; if its number is taken, another run came first, and the write is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_RUNS_KEPT = 100


class VersionConflict(RuntimeError):
    """Another run has committed since the version that a write started from."""


@dataclass(frozen=True)
class Snapshot:
    path: str
    number: int
    runs: tuple[str, ...]
    folders: tuple[str, ...]
    schema: str

    @property
    def locations(self) -> list[str]:
        return [f"{self.path}/data/{f}" for f in self.folders]


def glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot | None:
    """The newest version (or a given one); None where there is none."""
    numbers = {int(p.rsplit("/", 1)[1].removesuffix(".json")): p for p in glob(spark, f"{path}/manifests/*.json")}
    if not numbers or number is not None and number not in numbers:
        return None
    number = max(numbers) if number is None else number
    fs, Path = _files(spark, path)
    stream = fs.open(Path(numbers[number]))
    try:
        held = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(path, number, tuple(held["runs"]), tuple(held["folders"]), held["schema"])


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """One version as a table; partition filters prune its folders."""
    held = snapshot(spark, path, number)
    if held is None:
        return None
    schema = StructType.fromJson(json.loads(held.schema))
    if not held.folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*held.locations).select(*schema.names)


def _commit(spark: SparkSession, held: Snapshot) -> None:
    fs, Path = _files(spark, held.path)
    text = json.dumps({"runs": held.runs, "folders": held.folders, "schema": held.schema})
    fs.mkdirs(Path(f"{held.path}/manifests"))
    draft, final = Path(f"{held.path}/manifests/.{uuid.uuid4().hex}"), Path(f"{held.path}/manifests/{held.number:012d}.json")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise VersionConflict(f"{held.path}: version {held.number} is taken")


def write_version(
    df: DataFrame, path: str, partitions: Sequence[str] = (), run: str | None = None, keep_others: bool = False, base: Snapshot | None = None
) -> Snapshot:
    """Write rows as a new version and commit it. ``keep_others``: partitions without new rows stay as they were.

    ``base`` is the version that ``df`` was made from (by default the newest); if it is no longer the newest, nothing is committed.
    """
    spark = df.sparkSession
    base = base or snapshot(spark, path)
    run = run or uuid.uuid4().hex
    if base is not None and run in base.runs:
        return base
    name = f"version={uuid.uuid4().hex}"
    # rebalancing gathers the rows of a partition and lets adaptive execution split large ones: no task writes a whole large one
    rows = df.hint("rebalance", *partitions) if partitions else df
    rows.write.partitionBy(*partitions).parquet(f"{path}/data/{name}")
    depth = "/*" * len(partitions)
    written = [f"{name}/" + "/".join(p.split("/")[len(p.split("/")) - len(partitions) :]) for p in glob(spark, f"{path}/data/{name}{depth}")] if partitions else [name]
    written = [f for f in written if all("=" in part for part in f.split("/"))]
    schema = df.schema
    if keep_others and base is not None:
        new = {f.split("/", 1)[1] for f in written}
        written += [f for f in base.folders if f.split("/", 1)[1] not in new]
        have = set(schema.names)
        schema = StructType(list(schema) + [f for f in StructType.fromJson(json.loads(base.schema)) if f.name not in have])
    number, runs = (base.number + 1, base.runs) if base else (1, ())
    held = Snapshot(path, number, (*runs, run)[-_RUNS_KEPT:], tuple(written), schema.json())
    _commit(spark, held)
    return held

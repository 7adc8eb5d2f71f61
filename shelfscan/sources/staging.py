"""Intermediate tables on shared storage.

A stage is a parquet table in the folder named by ``spark.checkpoint.dir``. It cuts
lineage, survives the loss of executors, keeps column pruning, and gives the planner
real sizes, so that a staged table is broadcast only when its files are small enough.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfscan.sources.shipping import ship

_SETTING = "spark.checkpoint.dir"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> None:
    """Ship the package to the workers and lower the generated-method limit to the JIT's own.

    The cleaning projections fuse into methods above 8000 bytes of bytecode, which the
    JVM only ever interprets; split up, the cleaning stage runs about a quarter faster. The files of
    a shuffle are deleted as soon as the write or collection that made them has ended: a stage is
    read from its table, and nothing else would delete them before the driver's next garbage collection.
    Settings of the session are kept.
    """
    ship(spark)
    given = dict(spark.sparkContext.getConf().getAll())
    for name, value in ((_METHOD_LIMIT, "8000"), (_DROP_SHUFFLES, "true")):
        if name not in given:
            spark.conf.set(name, value)


def stage_root(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/shelfscan-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="shelfscan-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and return the written table."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> None:
    """Delete every stage this application has written."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)

"""Makes the package importable on Python workers, wherever the session was started."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark as a zip, once per application.

    Spark serves the file from the driver; executors fetch it before their first task.
    The zip is a driver-side upload only, nothing is read from its folder on executors; it goes when the process ends.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent.parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="shelfscan-ship-")) / "shelfscan_package.zip"
    atexit.register(shutil.rmtree, target.parent, ignore_errors=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)

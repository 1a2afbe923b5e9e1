"""Makes this package importable in Spark's Python workers, as ``--py-files`` would."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import paylake

# Texts are long: batches between the JVM and Python are bounded by bytes, 64 MB if nobody says less.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark once per application; Spark copies it to every executor.

    The archive lies in the driver's own folder, from where Spark serves it. A session without a
    bound of its own on the bytes of Arrow batches gets ``BATCH_BYTES``.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(paylake.__file__).resolve().parent
    if root.is_dir():  # else it already came as an archive
        archive = Path(tempfile.mkdtemp(prefix="paylake-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, Path(root.name) / file.relative_to(root))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)

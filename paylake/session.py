"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs rely on for speed, never for correctness.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str, cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **ENGINE_CONF,
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": "8",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only in local mode, where one
    machine has it all, an unset folder is replaced by one below the warehouse.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/paylake-{label}-{uuid.uuid4().hex}"
    for paths in _watched:
        paths.append(path)
    return path


# Lists that get the scratch paths handed out while they are watched.
_watched: list[list[str]] = []


@contextmanager
def reclaimed_scratch(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Remove the scratch that is handed out inside, but for ``kept``, once the block has come through.

    For blocks that end with a written result, which nothing reads the scratch for any more. After
    an error it stays for inspection.
    """
    made: list[str] = []
    _watched.append(made)
    try:
        yield
    finally:
        _watched[:] = [paths for paths in _watched if paths is not made]
    for path in made:
        if path not in kept:
            remove_scratch(spark, path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

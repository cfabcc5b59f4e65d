"""Where a job keeps its own tables and checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import SparkSession

_LOCAL: list[str] = []


def _local_folder() -> str:
    """One folder of this machine for the process, removed when the process ends."""
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tidegate-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder that the cluster names.

    Only a session without ``spark.checkpoint.dir`` (a local test) gets a folder of this machine. The
    session's settings stay as they are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/tidegate/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder as ``workspace`` gives it, which goes when the block ends."""
    place = workspace(spark, name)
    try:
        yield place
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(place)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

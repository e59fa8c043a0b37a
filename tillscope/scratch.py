"""Where intermediate tables are written, and how they are removed."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder the session names.

    The folder is ``spark.checkpoint.dir``, which every executor can reach. Only
    a session whose executors are in this process gets a temporary folder without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir() or _own_folder(spark)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tillscope-"))
    return _own[0]


def remove_folders(spark: SparkSession, *paths: str) -> None:
    """Remove written tables that nothing will read any more."""
    configuration = spark._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(configuration).delete(folder, True)

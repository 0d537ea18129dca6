"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "pluvio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Time is UTC everywhere, and adaptive execution coalesces small shuffle
    partitions and splits skewed ones. On a cluster pass ``master=None`` and
    let the submit command decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without the setting a local session gets one temporary folder, as in
    tests; on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="pluvio-")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and a maker of paths below it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    root = path.rstrip("/")
    return make(root).getFileSystem(spark._jsc.hadoopConfiguration()), lambda *parts: make("/".join([root, *parts]))


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path under the shared folder whose content is deleted in the end."""
    path = fresh_path(spark, name)
    try:
        yield path
    finally:
        system, below = file_system(spark, path)
        system.delete(below(), True)

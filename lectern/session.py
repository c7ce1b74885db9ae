"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.outputTimestampType": "INT96",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: Shuffled bytes that adaptive execution gives to one task, and bytes of input that are worth
#: one partition of a shuffle before it joins small ones.
TASK_BYTES, PARTITION_INPUT = 32 << 20, 8 << 20
_TARGET = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_tasks(spark: SparkSession, paths: list[str]) -> None:
    """Let the number of shuffle partitions follow the bytes of the input, so that the memory
    of a task does not grow with it.

    A task size that the session names stays; a number of partitions is only raised.
    """
    if spark.conf.get(_TARGET, None) is None:
        spark.conf.set(_TARGET, str(TASK_BYTES))
    size = 0
    for path in paths:
        file = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = file.getFileSystem(spark._jsc.hadoopConfiguration())
        size += fs.getContentSummary(file).getLength() if fs.exists(file) else 0
    held = spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if size // PARTITION_INPUT > int(held):
        spark.conf.set(_PARTITIONS, str(size // PARTITION_INPUT))


#: Files that a task keeps open side by side when it writes to several folders.
OPEN_FILES = 40
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def keep_files_open(spark: SparkSession) -> None:
    """Let a task that writes to a few folders keep a file open for each, instead of sorting
    its rows by folder first.  Of more folders it sorts the rest.  A number that the session
    names stays."""
    if int(spark.conf.get(_WRITERS, "0")) == 0:
        spark.conf.set(_WRITERS, str(OPEN_FILES))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Where the setting is absent a temporary folder serves a local master only; a
    cluster without the setting is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL or not os.path.isdir(_LOCAL[0]):
        _LOCAL[:] = [tempfile.mkdtemp(prefix="lectern-")]
    return _LOCAL[0]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a written folder is there and its job was committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"

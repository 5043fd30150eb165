"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "ebbtide",
    master: str | None = None,
    partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the jobs expect; cluster settings win when given by spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Stack traces for every column expression cost more than building the plans themselves.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder stands in for it only on a local master.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="ebbtide-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; ``clear_scratch`` removes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch() -> int:
    """Remove what was written below the scratch paths handed out so far; returns how many there were.

    Frames read from them are lost, so call it when the results of a job have been used.
    """
    removed = 0
    while _SCRATCH:
        path = _SCRATCH.pop()
        system, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else os.path.abspath(path))
        if system.get_file_info(place).type == fs.FileType.Directory:
            system.delete_dir(place)
            removed += 1
    return removed


def discard(path: str) -> None:
    """Removes one scratch path that nothing reads any more."""
    system, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else os.path.abspath(path))
    if path in _SCRATCH:
        _SCRATCH.remove(path)
        if system.get_file_info(place).type == fs.FileType.Directory:
            system.delete_dir(place)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that row positions stay fixed when an executor is lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

"""The shared folder for checkpoints, stage tables and round trips."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Threads that are inside ``shuffles_removed``, and what the setting was before the first of them.
_lock = threading.Lock()
_inside: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    if not named:
        named = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="refrain-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, stem: str) -> str:
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, stem: str) -> DataFrame:
    """Write a stage once and read it back, so later jobs neither recompute nor depend on it in memory.

    Once it is written, nothing reads the shuffle files behind it: Spark is told to remove them.
    """
    path = fresh_path(df.sparkSession, stem)
    with shuffles_removed(df.sparkSession):
        df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside remove their shuffle files when they end, as far as this version of Spark can.

    Threads may be inside at the same time: the last one to leave sets back what the first one found.
    """
    with _lock:
        _inside.append(_inside[0] if _inside else spark.conf.get(SHUFFLE_CLEANUP, "false"))
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            before = _inside.pop()
            if not _inside:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_stages(*tables: DataFrame) -> None:
    """Delete the folders of tables that ``stage_table`` gave, when nothing is going to read them any more.

    Folders outside the shared one are left alone.
    """
    for table in tables:
        spark = table.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(shared_dir(spark)).toUri().getPath()
        folders = {hadoop(f).getParent().toString() for f in table.inputFiles()}
        for folder in folders:
            path = hadoop(folder)
            if path.toUri().getPath().startswith(f"{root}/"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def finished_folders(spark: SparkSession, path: str, part: str = "") -> list[str]:
    """Names of the folders in ``path`` that hold a finished table (in their subfolder ``part``), in order; none if
    ``path`` does not exist. Tables left behind by a job that died carry no success mark."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    mark = f"{part}/_SUCCESS" if part else "_SUCCESS"
    return sorted(n for n in names if system.exists(hadoop(f"{path}/{n}/{mark}")))


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

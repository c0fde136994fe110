"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "battlelake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; callers may override any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Keyed streaming state lives on disk beside the executor, not on its heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        # The context appends an id of its own to the folder it was given.
        return current.rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="battlelake-")
    context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder; never reused, so that no run reads another's files."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


_scopes = threading.local()


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as the cluster sees them."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Store a small text so that it is there whole or not at all; an earlier one at the path is replaced."""
    draft, files = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.draft")
    target, _ = hadoop_path(spark, path)
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"{path} could not be written")


def get_text(spark: SparkSession, path: str) -> str | None:
    target, files = hadoop_path(spark, path)
    if not files.exists(target):
        return None
    source = files.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; drafts of texts are left out."""
    target, files = hadoop_path(spark, path)
    if not files.exists(target):
        return []
    found = (status.getPath().getName() for status in files.listStatus(target))
    return sorted(name for name in found if not name.endswith(".draft") and not name.startswith("."))


@contextmanager
def step_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the steps stored inside the block when it ends; its results must be written by then."""
    outer, _scopes.paths = getattr(_scopes, "paths", None), []
    try:
        yield
    finally:
        for path in _scopes.paths:
            target, files = hadoop_path(spark, path)
            files.delete(target, True)
        _scopes.paths = outer


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    Later steps read stored rows, also after an executor is lost; being parquet, they read only the columns
    they use, and the planner knows the table's size.
    """
    path = work_path(df.sparkSession, "step")
    # One file for each task, whatever the session says: places in a file mean something to some readers.
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    if getattr(_scopes, "paths", None) is not None:
        _scopes.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

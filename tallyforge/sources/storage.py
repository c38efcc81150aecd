"""The few file-system calls publishing needs, through Spark's own Hadoop client."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession


#: Folder that scratch goes to while somebody owns it.
_OWNER: ContextVar[str | None] = ContextVar("scratch_owner", default=None)


def _locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted child names of a directory; empty when it does not exist."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def tree_bytes(spark: SparkSession, path: str) -> int:
    """Total size of a file or directory tree, from metadata."""
    fs, target = _locate(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _locate(spark, path)
    size = fs.getFileStatus(target).getLen()
    stream = fs.open(target)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file whole: readers see it complete or not at all."""
    fs, target = _locate(spark, path)
    _, draft = _locate(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        raise FileExistsError(f"{path} was written by another run")


def modified_at(spark: SparkSession, path: str) -> datetime | None:
    """When a file or directory was last changed; None when it does not exist."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return None
    return datetime.fromtimestamp(fs.getFileStatus(target).getModificationTime() / 1000, UTC)


def files_under(spark: SparkSession, path: str) -> dict[str, datetime]:
    """Every file below a directory, by its name relative to it, and when each was last changed."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return {}
    root, found, left = fs.getFileStatus(target).getPath().toString().rstrip("/") + "/", {}, fs.listFiles(target, True)
    while left.hasNext():
        status = left.next()
        name = status.getPath().toString().removeprefix(root)
        found[name] = datetime.fromtimestamp(status.getModificationTime() / 1000, UTC)
    return found


def delete_tree(spark: SparkSession, path: str) -> None:
    """Delete a file or directory tree; nothing happens when it does not exist."""
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory under the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session may do
    without it, because there driver and executors are one machine.
    """
    owner = _OWNER.get()
    if owner is not None:
        return f"{owner}/{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tallyforge-")
    return f"{shared.rstrip('/')}/tallyforge-{uuid.uuid4().hex}"


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[str]:
    """Everything that goes to scratch inside is deleted at the end, also after an error.

    Only for work whose result has been written elsewhere by then.
    """
    root = scratch_dir(spark)
    token = _OWNER.set(root)
    try:
        yield root
    finally:
        _OWNER.reset(token)
        delete_tree(spark, root)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A ``materialize`` whose copies are deleted at the end, also after an error.

    Only for copies that nothing lazy outlives.
    """
    root = scratch_dir(spark)

    def keep(df: DataFrame) -> DataFrame:
        path = f"{root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        delete_tree(spark, root)


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to scratch and read it back, so that later jobs do not recompute it."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

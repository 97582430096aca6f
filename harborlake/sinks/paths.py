"""Places for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return base.rstrip("/")


def share_locally(spark: SparkSession) -> None:
    """Give a session on this machine alone, as in tests, a checkpoint folder if it has none.

    A cluster session is left as it is: its folder is for the cluster to name.
    """
    context = spark.sparkContext
    unset = not spark.conf.get(CHECKPOINT_DIR, None) and not context.getCheckpointDir()
    if unset and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="harborlake-"))


def scratch_path(spark: SparkSession, name: str, *, keep: bool = False) -> str:
    """A fresh path below the folder that driver and executors share.

    What is written there goes away when the application ends, unless it is to be kept.
    """
    base = shared_folder(spark)
    if keep:
        return f"{base}/{name}-{uuid.uuid4().hex}"
    root = f"{base}/harborlake-{spark.sparkContext.applicationId}"
    files, jvm_root = _file_system(spark, root)
    if files.mkdirs(jvm_root):
        files.deleteOnExit(jvm_root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    files, jvm_path = _file_system(spark, path)
    return files.exists(jvm_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    files, jvm_path = _file_system(spark, path)
    files.delete(jvm_path, True)


def names(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder, and when each was modified; empty for a folder that is not there."""
    files, jvm_path = _file_system(spark, folder)
    if not files.exists(jvm_path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(jvm_path)}


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file."""
    files, jvm_path = _file_system(spark, path)
    stream = files.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file; False if there is one of that name, which then stays as it is."""
    files, jvm_path = _file_system(spark, path)
    if files.exists(jvm_path):
        return False
    try:
        stream = files.create(jvm_path, False)
    except Exception:
        if files.exists(jvm_path):  # another writer was faster
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another, which is set aside until the new one is there."""
    files, jvm_staged = _file_system(spark, staged)
    _, jvm_path = _file_system(spark, path)
    _, jvm_old = _file_system(spark, f"{path}__replaced-{uuid.uuid4().hex}")
    if files.exists(jvm_path):
        if not files.rename(jvm_path, jvm_old):
            raise OSError(f"{path} could not be set aside")
    if not files.rename(jvm_staged, jvm_path):
        raise OSError(f"{staged} could not be moved to {path}")
    files.delete(jvm_old, True)

"""Session settings that the queries rely on."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _own_folder() -> str:
    """A folder of this machine, for a session that is one process; removed at its end."""
    path = tempfile.mkdtemp(prefix="lacquer-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Where none is named, a session of one process gets a folder of its own; on a
    cluster that is an error, as executors do not share a machine's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder shared by the executors of {master}")
    return _own_folder()


def workspace(spark: SparkSession, what: str) -> str:
    """A new path inside the shared folder."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern names, in name order, in whatever file system it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder within its file system."""
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to)]
    if not paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(*paths):
        raise OSError(f"cannot move {path} to {to}")


def exists(spark: SparkSession, path: str) -> bool:
    return bool(listed(spark, path))


def prepare(spark: SparkSession) -> SparkSession:
    """UTC days, and checkpoints in the shared folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return spark


def local(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and measurements on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.ui.enabled", "false").config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())

"""Helpers shared by the training-data operators: written intermediate tables
in the cluster's shared folder and file access from tasks."""

from __future__ import annotations

import contextlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package


__all__ = ["forget", "release_memory", "scratch_dir", "scratch_scope", "ship_package", "shuffle_partitions", "task_fs", "written"]


_OPEN_SCOPES: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    for made in _OPEN_SCOPES:
        made.append(path)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables made inside are deleted at the end; what must outlive
    it is written inside to a path made before."""
    made: list[str] = []
    _OPEN_SCOPES.append(made)
    try:
        yield
    finally:
        _OPEN_SCOPES.remove(made)
        for path in made:
            forget(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back:
    cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_fs(uri: str):
    """(pyarrow filesystem, path) of a folder URI, for use inside tasks."""
    from pyarrow import fs
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri)


def release_memory() -> None:
    """Give back what a finished batch held: Python workers go on into later
    stages, and a freed heap otherwise stays theirs."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass            # another C library


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

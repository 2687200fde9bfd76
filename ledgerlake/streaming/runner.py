"""Structured Streaming plumbing: table streams, idempotent sinks, and a
runner that drives a query to the end of its input.

* :func:`table_stream` reads a given table as a stream (``availableNow`` takes
  all its files; a long-lived deployment sets ``max_files``).
* :func:`batch_sink` is the ``foreachBatch`` sink: every micro-batch overwrites
  a folder of its own, so a replayed batch (after a failure) changes nothing.
  :func:`read_latest` keeps the newest version per key of update-mode
  aggregates, :func:`read_appended` all rows of append-mode ones.
* Checkpoints and sink folders live under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table

BATCH = "batch_id"


def run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"streams/{name}/{uuid.uuid4().hex[:12]}")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """The table ``name`` as a stream of its Parquet files."""
    known = table(spark, sf_dir, name)
    reader = spark.readStream.schema(known.schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    base, files = sf_dir.rstrip("/"), known.inputFiles()
    if len(files) == 1 and files[0].rsplit("/", 1)[-1] == f"{name}.parquet":
        # A table of one file: streams read folders.
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(base)
    return reader.parquet(f"{base}/{name}.parquet")


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={epoch_id}")
    return write


def run(query_df: DataFrame, checkpoint: str, sink: str, mode: str = "update", write=None):
    """Run to the end of the available input (``availableNow``); ``write``
    replaces the default sink.  An empty first version makes a stream without
    input read back as an empty table."""
    spark = query_df.sparkSession
    if write is None:
        spark.createDataFrame([], query_df.schema).write.mode("overwrite").parquet(f"{sink}/{BATCH}=-1")
    q = (query_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(write or batch_sink(sink)).start())
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    return q


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version per key of an update-mode sink."""
    df = spark.read.parquet(path)
    cols = [c for c in df.columns if c not in keys and c != BATCH]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), BATCH).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols])


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)

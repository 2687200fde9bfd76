"""Spark session and checkpoint-directory helpers.

Library code never builds its own session: every operator takes the caller's
``SparkSession``.  ``local_session`` exists for tests, the bench and examples.
"""

from __future__ import annotations

import logging
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings every job of this package expects.  AQE re-plans joins and
# coalesces partitions at run time; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (not for cluster use)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LEDGERLAKE_DRIVER_MEM", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (Spark's own file distribution), once
    per context, so that functions of its modules can run in tasks whatever
    the folder the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-pkg-"), "ledgerlake_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "ledgerlake")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._ledgerlake_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's ``spark.checkpoint.dir``; only a local session without
    one (tests) falls back to a fresh local folder, a cluster must name a
    folder that the driver and all executors share."""
    ship_package(spark)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # already set: setting it again would nest a new sub-folder each time
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or None
    if d is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        d = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        log.warning("spark.checkpoint.dir is unset; using local %s (tests only)", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate
    tables and streaming checkpoints."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"

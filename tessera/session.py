"""Spark session settings and lineage checkpoints."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partial top-N per key before the shuffle for row_number() <= N filters, for any N.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    # Remove checkpoint files once their DataFrames are gone (long sessions).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    # Python workers inherit this: silence pandas deprecation chatter in task logs
    os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    scratch folder serves local masters only (tests, one machine); on a cluster
    executors could not share it, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared checkpoint folder, removed when the driver exits.

    Results that read it stay valid until then; a path of the caller's own is never removed.
    """
    path = os.path.join(checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark, path))
    return path


def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            jvm = spark._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

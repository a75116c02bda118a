"""Session defaults and the shared scratch location.

Everything this package writes outside a user-given path (merge staging,
CSV round trips, stream checkpoints of the registered queries) goes under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent do we set our own, and only where driver and executors share one machine
(local tests): a folder beside the working directory's warehouse. On a cluster a
missing setting is an error, since a machine-local folder would be seen by one
executor only.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
# Local runs without that setting: this folder, or the one the variable names.
LOCAL_SCRATCH_ENV = "LAKEOPS_LOCAL_SCRATCH"
DEFAULT_LOCAL_SCRATCH = "/tmp/lakeops-scratch"


def get_session(
    app: str = "lakeops",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    UTC session time zone, ANSI mode, AQE with skew-join splitting and
    partition coalescing. ``shuffle_partitions`` should be sized so one shuffle
    partition is ~128-256 MB at the target scale; AQE coalesces downwards.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.parquet.compression.codec": "snappy",
        # Partitioned writes (row kind of a rewrite, partition columns): keep up to
        # this many files open per task instead of sorting each task's rows first;
        # beyond it Spark falls back to the sort.
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session; when unset in a local run, set our own and register
    it, so ``DataFrame.checkpoint()`` and this package agree.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = f"file://{os.environ.get(LOCAL_SCRATCH_ENV, DEFAULT_LOCAL_SCRATCH)}/{uuid.uuid4().hex[:12]}"
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/lakeops/{name}-{uuid.uuid4().hex[:12]}"

"""SparkSession construction and per-session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library assumes.  UTC because trade timestamps are
# Unix milliseconds and every time bucket (minute, hour, day) is a UTC bucket.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE sizes post-shuffle partitions to this target (coalescing small ones,
    # splitting skewed ones), so shuffle.partitions can be set high once.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "tradelake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB after the first aggregation); AQE then
    coalesces small partitions and splits skewed ones at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session created elsewhere use UTC, which every bucket relies on
    (an error if that is not possible); its other settings stay as they are."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, written tables and stream state.

    Taken from the session (``spark.checkpoint.dir``, as set by the cluster).
    Only when nothing is configured and the master is local -- tests -- a
    private folder is created and registered, so later calls agree on it.  On a
    cluster executors could not see such a folder, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:
            root = None
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tradelake-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint root."""
    return "/".join([checkpoint_root(spark), *parts])


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint root."""
    return scratch_path(spark, f"{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}")

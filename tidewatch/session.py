"""Session settings the pipeline relies on, and the shared work folder.

The pipeline keeps wall-clock semantics in UTC (the raw timestamps are UTC
ISO strings), so the session time zone is pinned. Lineage cuts and scratch
tables go to the folder the cluster names in ``spark.checkpoint.dir``; only
when that is unset (tests, a laptop) do we make one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC and make sure a checkpoint folder is known. Idempotent."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


_local_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; one of our own only if unset and the master is local."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get(_CKPT_KEY, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set and the master is {master or 'unknown'!r}: "
                "name a folder there that the driver and all executors share")
        # Local runs only: a cluster sets spark.checkpoint.dir to shared storage.
        configured = _local_fallback.setdefault("dir", tempfile.mkdtemp(prefix="tidewatch-ckpt-"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name inside the shared checkpoint folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewatch") -> SparkSession:
    """Session for tests and the local bench: no UI, AQE on, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWATCH_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)

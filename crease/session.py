"""Session helpers: a local session for tests and the bench, and scratch folders
under the cluster's shared checkpoint directory."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", shuffle_partitions: int | None = None, app: str = "crease", extra: dict[str, str] | None = None
) -> SparkSession:
    """A ``local[cpus]`` session configured the way tests and the bench expect
    (``extra``: further settings, e.g. an event log for stage times).

    On a cluster the driver/launcher owns the session; nothing here is needed.
    """
    n = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(2, n)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CREASE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset *and* Spark runs in local mode
    (tests) is a private temporary folder chosen.  On a cluster an unset value
    is an error: a machine-local folder would not survive a lost executor.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            root = current.rsplit("/", 1)[0]
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="crease-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/crease/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Delete the scratch folders under the checkpoint root that were last changed
    more than so many hours ago, and return their names.  Results are read lazily
    from such folders, so this is for runs that are over: choose more hours than the
    longest run takes."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/crease")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    before = (time.time() - older_than_hours * 3600) * 1000
    dropped = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        if status.getModificationTime() < before:
            fs.delete(status.getPath(), True)
            dropped.append(status.getPath().getName())
    return sorted(dropped)

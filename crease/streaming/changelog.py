"""Changelogs of Parquet batch folders, and folding them while a stream writes.

A table is a folder of ``batch_id=<n>`` parts.  A fold writes the rows that still
count as a snapshot beside it (``<table>.snapshots/upto=<n>``) and then drops the
parts that an earlier snapshot already covers, so a reader that listed files before
the fold still finds them.  Readers take the newest finished snapshot and the
parts after it; a part that both hold changes nothing, because readers keep the
newest row of each key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _numbered(spark: SparkSession, path: str, prefix: str, finished: bool = False) -> dict[int, str]:
    """Sub-folders ``<prefix>=<n>`` of ``path`` by n; one name per micro-batch since the last fold."""
    fs, target = _folder(spark, path)
    if not fs.exists(target):
        return {}
    found = {}
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith(f"{prefix}=") and name.removeprefix(f"{prefix}=").isdigit():
            if not finished or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found[int(name.removeprefix(f"{prefix}="))] = f"{path}/{name}"
    return found


def _snapshots(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.snapshots"


def read_changelog(spark: SparkSession, table_path: str) -> DataFrame:
    """All rows that count: the newest snapshot and the parts after it."""
    snapshots = _numbered(spark, _snapshots(table_path), "upto", finished=True)
    number = F.col("batch_id").cast("bigint")  # a folder's name alone would be read as an int
    if not snapshots:
        return spark.read.parquet(table_path).withColumn("batch_id", number)
    upto = max(snapshots)
    base = spark.read.parquet(snapshots[upto])
    later = [p for n, p in _numbered(spark, table_path, "batch_id").items() if n > upto]
    return base.unionByName(spark.read.schema(base.schema).parquet(*later)) if later else base


def fold(spark: SparkSession, table_path: str, keep: Callable[[DataFrame], DataFrame]) -> str:
    """Write ``keep`` of all rows as a snapshot up to the last finished part, and
    drop parts and snapshots that the snapshot before it covers."""
    parts = _numbered(spark, table_path, "batch_id", finished=True)
    if not parts:
        return table_path
    before, upto = sorted(_numbered(spark, _snapshots(table_path), "upto", finished=True)), max(parts)
    out = f"{_snapshots(table_path)}/upto={upto}"
    if not before or before[-1] < upto:
        rows = keep(read_changelog(spark, table_path).filter(F.col("batch_id") <= upto))
        rows.write.mode("overwrite").parquet(out)
    covered = before[-1] if before and before[-1] < upto else -1
    fs, _ = _folder(spark, table_path)
    for n, path in parts.items():
        if n <= covered:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    for n in before[:-1]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{_snapshots(table_path)}/upto={n}"), True)
    return out

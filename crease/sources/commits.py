"""Sets of tables that appear together or not at all.

A run writes its tables to a folder of its own; one commit row, written last, names
them.  Readers resolve the newest commit, so a run that fails half-way leaves the
set before it readable, and no reader sees tables of two runs.  One job publishes
under a root at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from crease.sources.sinks import JDBC_MARK, save_tables

_COMMIT = "seq bigint, run_id string, tables map<string,string>"


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_COMMIT).parquet(f"{root.rstrip('/')}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_commit(spark: SparkSession, root: str):
    """The newest commit row (seq, run_id, tables), or None."""
    rows = _commits(spark, root)
    found = rows.orderBy("seq", "run_id", ascending=False).limit(1).collect() if rows is not None else []
    return found[0] if found else None


def new_run(root: str) -> tuple[str, str]:
    """(run id, folder of its tables)."""
    run_id = uuid.uuid4().hex[:12]
    return run_id, f"{root.rstrip('/')}/runs/{run_id}"


def commit_set(spark: SparkSession, root: str, run_id: str, where: Mapping[str, str]) -> int:
    """Make ``where`` (table -> place) the current set: one row in one file."""
    last = latest_commit(spark, root)
    seq = 1 if last is None else last["seq"] + 1
    row = spark.createDataFrame([(seq, run_id, dict(where))], _COMMIT).coalesce(1)
    row.write.mode("append").parquet(f"{root.rstrip('/')}/commits")
    return seq


def save_set(tables: Mapping[str, DataFrame], root: str, **options) -> dict[str, str]:
    """Write every table under a run of its own and commit them together;
    ``options`` as for :func:`crease.sources.sinks.save_tables`.  Tables that go to a
    database are overwritten there one by one; for them the commit row only says
    which run they are of."""
    spark = next(iter(tables.values())).sparkSession
    run_id, folder = new_run(root)
    where = save_tables(tables, folder, **options)
    commit_set(spark, root, run_id, where)
    return where


def current_set(spark: SparkSession, root: str) -> dict[str, str]:
    """Table -> place of the newest commit; empty before the first."""
    last = latest_commit(spark, root)
    return {} if last is None else dict(last["tables"])


def read_set(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The Parquet tables of the newest commit, all of one run."""
    return {name: spark.read.parquet(path) for name, path in current_set(spark, root).items() if not path.startswith(JDBC_MARK)}


def drop_old_runs(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the newest ``keep`` commits, and those of runs
    that never committed; returns their names.  Not while a run is writing."""
    rows = _commits(spark, root)
    kept = {r["run_id"] for r in rows.orderBy("seq", ascending=False).limit(keep).collect()} if rows is not None else set()
    runs = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/runs")
    fs = runs.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(runs) if fs.exists(runs) else []:
        name = status.getPath().getName()
        if name not in kept:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)

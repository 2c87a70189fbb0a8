"""Sinks: Parquet (S-6), JDBC with a per-table Parquet fallback (S-5), and the
output-set assembly (S-11, S-12)."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crease.operators.flatten import for_sink

log = logging.getLogger(__name__)

JDBC_MARK = "jdbc:"  # where a table went, if to the database


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite ``path`` with ``df``.  Partitioning on a low-cardinality
    column (season) lets later filters prune whole folders."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet_like(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a table written by :func:`write_parquet` with its original
    schema and column order (partition values keep their declared types
    instead of being re-inferred, e.g. season '2009' stays a string)."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_saved(
    spark: SparkSession, where: str, schema: T.StructType, jdbc_url: str | None = None, jdbc_properties: Mapping[str, str] | None = None
) -> DataFrame:
    """Read a table back from where :func:`save_tables` says it went."""
    if where.startswith(JDBC_MARK):
        return spark.read.jdbc(jdbc_url, where.removeprefix(JDBC_MARK), properties=dict(jdbc_properties or {})).select(*schema.fieldNames())
    return read_parquet_like(spark, where, schema)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], truncate: bool = True) -> None:
    """Overwrite a database table.  ``truncate`` keeps a table declared ahead
    of time (its keys and column types) instead of dropping and recreating it.
    Each partition opens its own connection; ``numPartitions`` in
    ``properties`` caps the concurrent connections."""
    props = dict(properties)
    df.write.mode("overwrite").option("truncate", str(truncate).lower()).jdbc(url, table, properties=props)


_DATABASE = re.compile(r"\bjava\.sql\.(SQL|Batch)\w*Exception\b|\bPSQLException\b|No suitable driver|\bjava\.lang\.ClassNotFoundException\b")


def database_error(exc: BaseException) -> bool:
    """Whether a failed write is the database's (connection, driver, table)
    and not the computation's: a JDBC exception among the causes, or no
    driver for the address.  A class of ``java.sql`` that is no exception (a
    Timestamp that a computation failed on) does not count."""
    if isinstance(exc, ConnectionError):
        return True
    cause = getattr(exc, "java_exception", None)
    text = str(cause if cause is not None else getattr(exc, "_stackTrace", None) or exc)
    while cause is not None:
        text += f"\n{cause.toString()}"
        cause = cause.getCause()
    return _DATABASE.search(text) is not None


def output_tables(stats: Mapping[str, DataFrame], matches: DataFrame, balls: DataFrame) -> dict[str, DataFrame]:
    """S-12: the seven output tables (S-11: nested match columns dropped)."""
    out = dict(stats)
    out["matches"] = for_sink(matches)
    out["balls_by_ball"] = balls
    return out


def save_tables(
    tables: Mapping[str, DataFrame],
    parquet_root: str,
    *,
    jdbc_url: str | None = None,
    jdbc_properties: Mapping[str, str] | None = None,
    table_prefix: str = "ipl_",
    jdbc_writer: Callable[..., None] = write_jdbc,
    partition_by: Mapping[str, list[str]] | None = None,
    landed: Mapping[str, str] | None = None,
    parallel: int = 4,
) -> dict[str, str]:
    """Write every table to the database, falling back to Parquet per table.

    A database failure on one table sends only that table to
    ``<parquet_root>/<name>``; tables already saved stay where they are.
    ``landed`` names tables that already exist as Parquet (the silver
    tables): their fallback is that copy, not a second write.
    Returns where each table went.
    """

    def save(name: str, df: DataFrame) -> str:
        if jdbc_url:
            try:
                jdbc_writer(df, jdbc_url, f"{table_prefix}{name}", jdbc_properties or {})
                return f"{JDBC_MARK}{table_prefix}{name}"
            except Exception as exc:
                if not database_error(exc):
                    raise
                log.warning("JDBC write of %s failed (%s); writing Parquet", name, exc)
        if landed and name in landed:
            return landed[name]
        path = f"{parquet_root.rstrip('/')}/{name}"
        write_parquet(df, path, (partition_by or {}).get(name))
        return path

    # independent tables: one Spark job each, submitted together so small
    # jobs overlap instead of queueing (Spark runs jobs from separate threads
    # concurrently)
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(tables)))) as pool:
        futures = {name: pool.submit(save, name, df) for name, df in tables.items()}
        where = {name: f.result() for name, f in futures.items()}
    return where

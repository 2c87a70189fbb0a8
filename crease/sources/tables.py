"""Table-level sources: Parquet read-back (S-7), literal relations (S-8) and
temp-view registration for the SQL path (S-9)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS_PER_TASK = 200_000  # rows that a task of a shuffle takes where the table is large


def tasks_for(rows: DataFrame) -> int | None:
    """Partitions for a shuffle of ``rows``, so that a task's share does not grow with
    the table; None where the session's number of shuffle partitions is enough.  For
    tables read from files: the count reads the Parquet footers."""
    n = math.ceil(rows.count() / ROWS_PER_TASK)
    return n if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def by_key(rows: DataFrame, n: int | None, key: str) -> DataFrame:
    """``rows`` dealt by ``key`` to ``n`` partitions; as they are where ``n`` is None."""
    return rows if n is None else rows.repartition(n, key)


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Parquet read-back; naming the columns keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def literal_relation(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal relation (e.g. the three-row team-titles smoke table)."""
    return spark.createDataFrame(list(rows), schema)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "ipl_") -> list[str]:
    """Register every table as ``<prefix><name>`` so users can run ``spark.sql``."""
    names = []
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names

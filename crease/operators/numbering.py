"""Numbers of rows within a key, for keys of any size.

Rows are range-partitioned by key and order, counted per partition, and each
partition numbers its own rows from what the ones before it hold: a key that fills
many partitions is numbered by as many tasks, none of which sees all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.session import scratch_path


def occurrence_numbers(rows: DataFrame, key: str, order: list[str], start: DataFrame | None = None) -> DataFrame:
    """``rows`` and ``occurrence``: the row's number from 0 among those of its
    ``key``, by ``order`` (distinct within a key).  ``start`` (key, n): numbers of a
    key begin at n."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "numbering")
    rows.repartitionByRange(n, key, *order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = placed.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    before = counts.select(key, "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    if start is not None:
        before = before.join(start.select(key, F.col("n").alias("__start")), key, "left")
        before = before.select(key, "__part", (F.col("__before") + F.coalesce("__start", F.lit(0))).alias("__before"))
    within = F.row_number().over(Window.partitionBy(key, "__part").orderBy(*order)) - 1
    numbered = placed.withColumn("__within", within).join(before, [key, "__part"])
    return numbered.withColumn("occurrence", (F.col("__before") + F.col("__within")).cast("bigint")).drop("__part", "__within", "__before")

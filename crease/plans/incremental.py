"""Incremental load: only files that were not loaded before are opened.

A file-source stream with ``availableNow`` keeps the log of files it has taken; each
micro-batch is parsed once and written as a part of every table (``batch_id=<n>``):
bronze, quarantine, silver matches and balls, content ids, and the partial sums of
the five statistics.  A batch that is replayed overwrites its own parts, and readers
see a batch only when its commit row is there.  Documents equal to ones loaded
earlier are numbered on from there, so loads in parts and one load give the same
ids.  A match lies in one batch whole, so partial sums, distinct match counts
among them, add up: the statistics are read without touching silver.

``python -m crease.plans.incremental INPUT ROOT``
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators.flatten import balls_by_ball, for_sink, matches_table
from crease.operators.stats import STATISTICS, merge_partials
from crease.schemas import CORRUPT_COLUMN, MATCH_DOCUMENT_READ
from crease.sources.documents import separate_repeats, split_corrupt, with_ids
from crease.sources.sinks import write_parquet


def _part(root: str, table: str, batch_id: int) -> str:
    return f"{root}/{table}/batch_id={batch_id}"


def _committed(spark: SparkSession, root: str) -> int:
    """The last batch whose parts are all there, -1 before the first: batches are written one after another."""
    try:
        last = spark.read.schema("batch_id bigint").parquet(f"{root}/commits").agg(F.max("batch_id")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return -1 if last is None else last


def _read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table's committed parts; folders of other batches are not opened."""
    return spark.read.parquet(f"{root}/{table}").filter(F.col("batch_id") <= _committed(spark, root)).drop("batch_id")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``matches``, ``balls_by_ball``, ``quarantine`` or ``bronze`` as loaded so far."""
    return _read(spark, root, table)


def read_statistics(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The five statistics of all that was loaded, from the stored partial sums."""
    out = {}
    for name, s in STATISTICS.items():
        out[name] = s.figures(merge_partials(_read(spark, root, f"partials/{name}"), s.keys))
    return out


def loaded_documents(spark: SparkSession, root: str) -> int:
    return 0 if _committed(spark, root) < 0 else _read(spark, root, "ids").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _load_batch(root: str):
    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= _committed(spark, root):
            return  # replayed after its commit
        landed = spark.read.parquet(write_parquet(batch, _part(root, "bronze", batch_id)))
        earlier = None
        if _committed(spark, root) >= 0:
            # only ids that come again: a small batch is broadcast, a large one filters the scan at run time
            here = landed.select("match_id").distinct()
            earlier = _read(spark, root, "ids").join(here, "match_id", "left_semi").groupBy("match_id").agg(F.sum("n").alias("n"))
        ids = write_parquet(landed.groupBy("match_id").agg(F.count(F.lit(1)).alias("n")), _part(root, "ids", batch_id))
        valid, quarantine = split_corrupt(separate_repeats(landed, earlier, counts=spark.read.parquet(ids)))
        write_parquet(quarantine, _part(root, "quarantine", batch_id))
        balls = balls_by_ball(valid)  # in the tasks that read their documents: a part has no season folders to fill
        silver = {
            "matches": spark.read.parquet(write_parquet(for_sink(matches_table(valid)), _part(root, "matches", batch_id))),
            "balls_by_ball": spark.read.parquet(write_parquet(balls, _part(root, "balls_by_ball", batch_id))),
        }
        for name, s in STATISTICS.items():
            write_parquet(s.partials(silver[s.of]), _part(root, f"partials/{name}", batch_id))
        spark.range(batch_id, batch_id + 1, numPartitions=1).select(F.col("id").alias("batch_id")).write.mode("append").parquet(f"{root}/commits")

    return load


def load_new(
    spark: SparkSession, input_path: str, root: str, *, multi_line: bool = False, glob: str = "*.json", max_files: int | None = None
) -> int:
    """Load the files that came since the last call and return how many documents
    they held.  ``root`` takes tables and the log of files, on shared storage;
    ``max_files`` bounds a micro-batch."""
    before = loaded_documents(spark, root)
    reader = (
        spark.readStream.schema(MATCH_DOCUMENT_READ)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("pathGlobFilter", glob)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        with_ids(reader.json(input_path))
        .writeStream.foreachBatch(_load_batch(root.rstrip("/")))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return loaded_documents(spark, root) - before


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="crease.plans.incremental", description="load match documents that came since the last load")
    ap.add_argument("input", help="folder of match documents")
    ap.add_argument("root", help="root of tables and of the log of files, on shared storage")
    ap.add_argument("--multi-line", action="store_true", help="one document per file")
    ap.add_argument("--glob", default="*.json")
    ap.add_argument("--max-files", type=int)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("crease-incremental").getOrCreate()
    n = load_new(spark, args.input, args.root, multi_line=args.multi_line, glob=args.glob, max_files=args.max_files)
    print(f"{n} documents loaded")
    return n


if __name__ == "__main__":
    main()

"""Match documents: directory scan with an explicit nested schema (S-1, S-3),
input guard (S-2) and corrupt-record quarantine (S-4)."""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators.numbering import occurrence_numbers
from crease.schemas import CORRUPT_COLUMN, MATCH_DOCUMENT_READ
from crease.session import scratch_path


class NoMatchDocuments(RuntimeError):
    """The input folder exists but holds no file matching the glob."""


def _has_input(df: DataFrame) -> bool:
    """Whether the scan found any file.  The split count is one integer from
    the JVM's own listing; ``inputFiles()`` would ship every path to Python
    (a hundred million strings for a hundred million match files)."""
    try:
        return df.rdd.getNumPartitions() > 0
    except (PySparkAttributeError, PySparkNotImplementedError):  # a client session without an RDD view
        return bool(df.inputFiles())


def read_match_documents(
    spark: SparkSession,
    path: str,
    *,
    multi_line: bool = True,
    glob: str = "*.json",
) -> DataFrame:
    """Read match documents with the explicit schema.

    ``multi_line=True`` is the one-document-per-file layout (each file is one
    split); ``multi_line=False`` reads JSON Lines, which Spark splits inside a
    file -- the layout to land at scale.  PERMISSIVE mode keeps an unparsable
    document as a row whose ``_corrupt_record`` holds the raw text.

    ``match_id`` is assigned here, before any explode: 128 bits of the content
    (info, innings, meta, or the text of a corrupt document) as hex digits -- the
    same on a task retry, in any file layout and on the next run, so incremental
    loads keep their ids.  Different documents share one with odds of n^2 / 2^129:
    6e-21 for two thousand million matches.  Documents that are equal share it
    too; :func:`separate_repeats` numbers them.

    A missing folder raises PATH_NOT_FOUND from Spark itself; a folder without
    a matching file raises :class:`NoMatchDocuments` (with an explicit schema
    Spark would silently return no rows).
    """
    df = (
        spark.read.schema(MATCH_DOCUMENT_READ)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("pathGlobFilter", glob)
        .json(path)
    )
    if not _has_input(df):
        raise NoMatchDocuments(f"no {glob} files in {path}")
    return with_ids(df)


def with_ids(df: DataFrame) -> DataFrame:
    """Content ids and source files of documents as read, from a batch or a stream."""
    # the JSON text names every field, so that nulls cannot change places
    content = F.to_json(F.struct("info", "innings", "meta"))
    return df.select(
        F.md5(F.concat_ws("\n", content, F.col(CORRUPT_COLUMN))).alias("match_id"),
        "info",
        "innings",
        "meta",
        CORRUPT_COLUMN,
        F.col("_metadata.file_path").alias("source_file"),
    )


def separate_repeats(bronze: DataFrame, earlier: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Give equal documents ids of their own: the first keeps the content id, the
    k-th after it gets ``-k`` behind it, whatever files they came in.

    ``bronze``: documents read from a landed Parquet table.  ``earlier``
    (match_id, n): how many documents with a content id older loads hold; numbers
    go on from there.  ``counts`` (match_id, n): those of ``bronze``, if they are there.
    Only rows of ids that come again are numbered, and their new numbers landed: few
    of them are broadcast, and the documents stay where they are.  Where nothing
    repeats, the documents are returned as they are.
    """
    spark = bronze.sparkSession
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    rows = bronze.select("match_id", *place)
    if counts is None:
        counts = rows.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumnRenamed("n", "here")
    if earlier is None:
        known = counts.filter("here > 1").withColumn("n", F.lit(0).cast("bigint"))
    else:
        known = counts.join(earlier, "match_id", "left").filter("here > 1 or n > 0").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    again = scratch_path(spark, "repeated-ids")
    known.select("match_id", "n").write.parquet(again)
    known = spark.read.parquet(again)
    if known.isEmpty():
        return bronze
    repeated = rows.join(known, "match_id", "left_semi")
    later = occurrence_numbers(repeated, "match_id", ["__file", "__row"], start=known).filter("occurrence > 0")
    numbers = scratch_path(spark, "repeat-numbers")
    later.select("__file", "__row", F.col("occurrence").alias("__k")).write.parquet(numbers)
    told = bronze.select("*", *place).join(spark.read.parquet(numbers), ["__file", "__row"], "left")
    number = F.when(F.col("__k") > 0, F.concat("match_id", F.lit("-"), F.col("__k").cast("string"))).otherwise(F.col("match_id"))
    return told.withColumn("match_id", number).drop("__file", "__row", "__k")


def split_corrupt(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid documents, quarantine) -- one scan, two filters on the same plan.

    The quarantine keeps the source file, the raw text and a reason so a bad
    document is neither lost nor turned into an all-null match: text that is no
    JSON, and JSON without ``info`` and ``innings`` (a number, a list, an empty object).

    Apply it to landed (bronze Parquet) or cached documents: Spark refuses a
    query on a raw JSON scan that reads only the corrupt-record column (a
    plain count of either side would be one).
    """
    # a document with a field of another type than declared is still a match, and that field null in it
    parsed = F.try_parse_json(CORRUPT_COLUMN)
    held = F.try_variant_get(parsed, "$.info", "variant").isNotNull() | F.try_variant_get(parsed, "$.innings", "variant").isNotNull()
    unreadable = F.col(CORRUPT_COLUMN).isNotNull() & ~held
    # one field of the list tells whether the list is null, without reading the rest of it
    empty = F.col(CORRUPT_COLUMN).isNull() & F.col("info").isNull() & F.col("innings.team").isNull()
    bad = unreadable | empty
    reason = F.when(parsed.isNull() & ~empty, F.lit("unparsable document")).otherwise(F.lit("no match in the document"))
    valid = docs.filter(~bad).drop(CORRUPT_COLUMN)
    quarantine = docs.filter(bad).select(
        "match_id",
        "source_file",
        F.col(CORRUPT_COLUMN).alias("raw_text"),
        reason.alias("reason"),
    )
    return valid, quarantine

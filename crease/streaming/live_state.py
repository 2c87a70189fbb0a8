"""The live current-state table as a Structured Streaming job (S-10, U-1).

readStream (landed API responses, JSON) -> the same column functions as the
batch path -> ``groupBy(match_id).agg(min_by, max_by)`` in update mode ->
``foreachBatch`` into a Parquet changelog partitioned by batch id.

* Exactly once: each micro-batch overwrites only its own ``batch_id=<n>``
  folder, so a batch replayed after a failure rewrites the same files.
* Order: state keeps the earliest and latest snapshot by (fetched_at, seq,
  pos), so a late file cannot overwrite a newer state.
* Reading the table: the newest changelog row per match (an aggregate, again
  partial-aggregated map-side).  ``compact_live_state`` folds it while the
  stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crease.operators.live import ARRIVAL, current_state_aggregate, current_state_columns, live_rows, snapshot_rows, validate_snapshots
from crease.schemas import CORRUPT_COLUMN, LIVE_RESPONSE_READ
from crease.streaming import changelog

# microsecond timestamps in landed JSON (Spark's default text keeps milliseconds)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def land_responses(responses: DataFrame, path: str, files: int | None = None) -> str:
    """Land API responses as JSON Lines files (what a collector would drop), by
    default as many as the session has shuffle partitions."""
    by = ("fetched_at", "seq")
    (
        (responses.repartitionByRange(files, *by) if files else responses.repartitionByRange(*by))
        .write.mode("overwrite")
        .option("timestampNTZFormat", TS_FORMAT)
        .option("timestampFormat", TS_FORMAT)
        .json(path)
    )
    return path


def read_responses_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed responses; the text of one that does not parse is in the
    corrupt-record column, the time of the file in ``arrived_at``."""
    reader = spark.readStream.schema(LIVE_RESPONSE_READ).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).withColumn(ARRIVAL, F.col("_metadata.file_modification_time"))


def responses_from_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Parse API responses carried as JSON text in one column -- a Kafka
    topic's ``value`` (cast to string) or a text source's line -- into the
    landed-response shape.  The text of a message that does not parse is in
    the corrupt-record column, as with the JSON reader.  ``arrived_at`` stays, if
    the messages have it (a Kafka record's ``timestamp``)."""
    options = {"timestampNTZFormat": TS_FORMAT, "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = F.from_json(F.col(column).cast("string"), LIVE_RESPONSE_READ, options)
    arrival = [ARRIVAL] if ARRIVAL in df.columns else []
    return df.select(parsed.alias("r"), *arrival).select("r.*", *arrival)


def read_responses_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Responses as JSON lines through the text source: the same ``value``
    column a Kafka source gives (``spark.readStream.format("kafka")``), so
    the parse is identical for both."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return responses_from_json(reader.load(path).withColumn(ARRIVAL, F.col("_metadata.file_modification_time")))


def open_responses(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, source_format: str = "json") -> DataFrame:
    """The response stream, by the JSON reader or as text lines."""
    read = read_responses_text_stream if source_format == "text" else read_responses_stream
    return read(spark, path, max_files_per_trigger)


def _changelog_writer(table_path: str, compact_every: int | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            current_state_columns(batch)
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .parquet(f"{table_path}/batch_id={batch_id}")
        )
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_live_state(batch.sparkSession, table_path)

    return write


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_live_state(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "60 seconds",
    state_partitions: int | None = None,
    rocksdb_state: bool = True,
    source_format: str = "json",
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start the current-state stream.

    The checkpoint (offsets and per-match state) must live on shared storage.
    ``state_partitions`` fixes the number of state-store partitions for the
    life of the checkpoint (default: the session's shuffle partitions);
    ``rocksdb_state`` keeps the state off the JVM heap, which matters when it
    grows with the number of matches.  Both are set in a session of the query's
    own (:func:`stream_session`); the caller's settings are not touched.
    ``max_files_per_trigger`` should be at least the number of cores, or a
    micro-batch parses its files with idle cores.  ``source_format="text"``
    reads the responses as text lines parsed with ``from_json`` -- the path a
    Kafka topic's ``value`` column takes.  ``compact_every``: fold the changelog
    after every so many micro-batches (:func:`compact_live_state`).
    """
    session = stream_session(spark, state_partitions, rocksdb_state)
    responses = open_responses(session, source_path, max_files_per_trigger, source_format)
    # rejects are kept by the quarantine stream (live_quarantine.py)
    valid, _ = validate_snapshots(snapshot_rows(responses))
    agg = current_state_aggregate(live_rows(valid))
    writer = (
        agg.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(_changelog_writer(table_path, compact_every))
    )
    return triggered(writer, available_now, processing_time).start()


def triggered(writer, available_now: bool, processing_time: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)


def stream_session(spark: SparkSession, state_partitions: int | None = None, rocksdb_state: bool = True) -> SparkSession:
    """A session of its own for one stateful query: the caller's settings as they
    are now, the number of state partitions and the state store."""
    session = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            session.conf.set(k, v)
    if state_partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if rocksdb_state:
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return session


def _newest_per_match(log: DataFrame) -> DataFrame:
    cols = [c for c in log.columns if c not in ("match_id", "batch_id")]
    latest = log.groupBy("match_id").agg(F.max_by(F.struct(*cols, "batch_id"), F.col("batch_id")).alias("s"))
    return latest.select("match_id", *[F.col(f"s.{c}").alias(c) for c in cols], F.col("s.batch_id").alias("batch_id"))


def read_live_state(spark: SparkSession, table_path: str) -> DataFrame:
    """The current state: the newest changelog row of each match."""
    return _newest_per_match(changelog.read_changelog(spark, table_path)).drop("batch_id")


def compact_live_state(spark: SparkSession, table_path: str) -> str:
    """Fold the changelog to one row per match; what readers see stays the same."""
    return changelog.fold(spark, table_path, _newest_per_match)


def compact(spark: SparkSession, table_path: str, out_path: str) -> str:
    """A copy of the table as a changelog of a single batch."""
    state = read_live_state(spark, table_path).withColumn("batch_id", F.lit(0).cast("bigint"))
    state.write.mode("overwrite").partitionBy("batch_id").parquet(out_path)
    return out_path

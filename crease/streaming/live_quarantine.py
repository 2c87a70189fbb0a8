"""Rejected live responses and snapshots as a stream.

The state and cache streams emit aggregates, so what they leave out is kept by
a query of its own over the same landed responses: readStream -> the batch
function ``rejected_snapshots`` -> ``dropDuplicatesWithinWatermark`` on the
snapshot's key -> Parquet in append mode.  The file sink's log makes it exactly
once, and a response that is landed again is kept once.  The watermark runs on the
time of landing, which a response without a readable time has too.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from crease.operators.live import ARRIVAL, reject_key, rejected_snapshots
from crease.streaming.live_state import open_responses, stream_session, triggered


def start_live_quarantine(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "60 seconds",
    source_format: str = "json",
    repeat_horizon: str = "1 day",
    state_partitions: int | None = None,
    rocksdb_state: bool = True,
) -> StreamingQuery:
    """Start the quarantine stream: ``fetched_at, seq, pos, match_id, raw,
    reason`` of every response or snapshot that the current-state table leaves
    out.  Read the table with ``spark.read.parquet``.

    A response landed again within ``repeat_horizon`` of its first landing adds
    nothing; keys older than that leave the state."""
    session = stream_session(spark, state_partitions, rocksdb_state)
    rejected = rejected_snapshots(open_responses(session, source_path, max_files_per_trigger, source_format))
    keyed = rejected.withColumn("__key", reject_key()).withWatermark(ARRIVAL, repeat_horizon)
    once = keyed.dropDuplicatesWithinWatermark(["__key"]).drop("__key", ARRIVAL)
    writer = once.writeStream.format("parquet").outputMode("append").option("path", table_path).option("checkpointLocation", checkpoint_path)
    return triggered(writer, available_now, processing_time).start()

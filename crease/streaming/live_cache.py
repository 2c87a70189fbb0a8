"""The recent-state cache (U-2) as a Structured Streaming job with TTL state.

The reference writes a JSON summary of every valid snapshot under
``live:<match_id>`` with a 600 s expiry, so at time t the cache holds, per
match, the newest summary if it was written after t - 600 s.  Such a write
lies in the current or the previous 600 s event-time window, so the stream
only needs per-(match, window) state for the last two windows:

readStream (landed responses) -> the batch functions for validation and live
rows -> summary JSON built JVM-side -> ``withWatermark(event_time, ttl)`` ->
``groupBy(match_id, window(event_time, ttl)).agg(max_by(summary, order))`` in
update mode -> ``foreachBatch`` into a Parquet changelog (``batch_id=<n>``
folders, rewritten on replay).

* State is bounded by the TTL: once the watermark (latest event time minus
  the TTL) passes a window's end, Spark drops it from state, so state holds
  only matches written in the last two windows -- unlike the current-state
  table, which keeps every match.
* A snapshot older than the watermark is dropped by Spark; its entry would
  already have expired, so the cache does not change.
* No Python in the stream: parsing, flags, payload and the windowed aggregate
  all run in the JVM, with partial aggregation before the shuffle.

Two more streams over the same writes answer what the update stream forgets:

* ``start_cache_log`` appends every write, so the cache can be read as of any
  past instant (``cache_at``) and each entry's validity is known
  (``cache_intervals``: until its next write or its expiry).
* ``start_cache_sessions`` emits an entry's life when it has expired: session
  windows with a gap of the lifetime, in append mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crease.operators.live import live_rows, snapshot_rows, validate_snapshots
from crease.schemas import CACHE_TTL_SECONDS
from crease.streaming import changelog
from crease.streaming.live_state import open_responses, stream_session, triggered

_EPOCH = _dt.datetime(1970, 1, 1)


def cache_writes(valid_rows: DataFrame) -> DataFrame:
    """One cache write per valid snapshot: match, JSON payload, times.

    ``event_time`` is the snapshot time as an instant -- the wall-clock value
    read as UTC, independent of the session time zone -- for the watermark
    and the window (both need an instant, not a local time).
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col("fetched_at"))
    summary = F.struct(
        F.concat_ws(" vs ", "team1", "team2").alias("teams"),
        F.col("team1_score").alias("score1"),
        F.col("team2_score").alias("score2"),
        "status",
    )
    return valid_rows.select(
        "match_id",
        F.to_json(summary).alias("payload"),
        "fetched_at",
        F.timestamp_micros(micros).alias("event_time"),
        "seq",
        "pos",
    )


def cache_windows(writes: DataFrame, ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """Per match and ``ttl``-long event-time window: the newest payload and
    its write time.  Works on a batch or a stream."""
    order = F.struct("fetched_at", "seq", "pos")
    return writes.groupBy("match_id", F.window("event_time", f"{ttl_seconds} seconds")).agg(
        F.max_by(F.struct("payload", F.col("fetched_at").alias("written_at")), order).alias("last")
    )


def _changelog_writer(table_path: str, ttl_seconds: int, compact_every: int | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.select(
                F.concat(F.lit("live:"), F.col("match_id")).alias("cache_key"),
                F.col("last.payload").alias("payload"),
                F.col("last.written_at").alias("written_at"),
                (F.col("last.written_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"),
                F.lit(batch_id).cast("bigint").alias("batch_id"),
            )
            .write.mode("overwrite")
            .parquet(f"{table_path}/batch_id={batch_id}")
        )
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_live_cache(batch.sparkSession, table_path)

    return write


def _open_writes(session: SparkSession, source_path: str, max_files_per_trigger: int | None, source_format: str) -> DataFrame:
    valid, _ = validate_snapshots(snapshot_rows(open_responses(session, source_path, max_files_per_trigger, source_format)))
    return cache_writes(live_rows(valid))


def start_live_cache(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    ttl_seconds: int = CACHE_TTL_SECONDS,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "60 seconds",
    state_partitions: int | None = None,
    rocksdb_state: bool = True,
    source_format: str = "json",
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start the cache stream; the checkpoint must live on shared storage.
    The other options are those of the current-state stream."""
    session = stream_session(spark, state_partitions, rocksdb_state)
    writes = _open_writes(session, source_path, max_files_per_trigger, source_format).withWatermark("event_time", f"{ttl_seconds} seconds")
    writer = (
        cache_windows(writes, ttl_seconds)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(_changelog_writer(table_path, ttl_seconds, compact_every))
    )
    return triggered(writer, available_now, processing_time).start()


def read_live_cache(spark: SparkSession, table_path: str, as_of: _dt.datetime | None = None) -> DataFrame:
    """The cache as of ``as_of`` (default: the latest write seen): each key's
    newest entry, kept while it has not expired.

    The changelog keeps the newest write of a window only, so an instant before
    the latest write is refused; :func:`cache_at` reads past instants from the
    write log."""
    log = changelog.read_changelog(spark, table_path)
    if as_of is not None:
        latest = log.agg(F.max("written_at")).first()[0]
        if latest is not None and as_of < latest:
            raise ValueError(f"writes after {as_of} may have replaced older ones: read past instants from the write log (cache_at)")
    # the latest time stays in the plan as a scalar subquery (null for an empty log: no entry)
    as_of_col = log.agg(F.max("written_at")).scalar() if as_of is None else F.lit(str(as_of))
    as_of_col = as_of_col.cast("timestamp_ntz")
    # expiry grows with the write time: unexpired entries first, then the
    # newest per key (same result, and only recent rows are aggregated)
    latest = (
        log.filter((F.col("expires_at") > as_of_col) & (F.col("written_at") <= as_of_col))
        .groupBy("cache_key")
        .agg(F.max_by(F.struct("payload", "written_at", "expires_at"), F.struct("written_at", "batch_id")).alias("c"))
    )
    return latest.select(
        "cache_key",
        F.col("c.payload").alias("payload"),
        F.col("c.written_at").alias("written_at"),
        F.col("c.expires_at").alias("expires_at"),
    )


def compact_live_cache(spark: SparkSession, table_path: str) -> str:
    """Fold the changelog to the newest entry of each key that was still alive at
    the latest write; expired entries go."""

    def alive(log: DataFrame) -> DataFrame:
        now = log.agg(F.max("written_at")).scalar()
        kept = log.filter(F.col("expires_at") > now)
        newest = kept.groupBy("cache_key").agg(
            F.max_by(F.struct("payload", "written_at", "expires_at", "batch_id"), F.struct("written_at", "batch_id")).alias("c")
        )
        return newest.select("cache_key", "c.*")

    return changelog.fold(spark, table_path, alive)


# --- every write, validity intervals, past instants ----------------------------------------


def log_rows(writes: DataFrame) -> DataFrame:
    """The write log's columns; ``written_day`` names its folders."""
    return writes.select(
        F.concat(F.lit("live:"), F.col("match_id")).alias("cache_key"),
        "payload",
        F.col("fetched_at").alias("written_at"),
        "seq",
        "pos",
        F.to_date("fetched_at").alias("written_day"),
    )


def start_cache_log(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "60 seconds",
    source_format: str = "json",
) -> StreamingQuery:
    """Append every cache write to a Parquet table in day folders: no state and no
    shuffle, exactly once by the file sink's log."""
    writes = log_rows(_open_writes(spark, source_path, max_files_per_trigger, source_format))
    writer = writes.writeStream.format("parquet").outputMode("append").partitionBy("written_day").option("path", table_path)
    return triggered(writer.option("checkpointLocation", checkpoint_path), available_now, processing_time).start()


def _bucket(time: Column, ttl_seconds: int) -> Column:
    """Number of the lifetime-long stretch of time that holds ``time``."""
    seconds = F.timestamp_diff("SECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.date_trunc("SECOND", time).cast("timestamp_ntz"))
    return F.floor(seconds / F.lit(ttl_seconds)).cast("bigint")


def cache_intervals(log: DataFrame, ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """(cache_key, payload, valid_from, valid_to) of every entry: from its write to
    the key's next write or its expiry, whichever comes first, the end not
    included.  Of writes at one time the last by (seq, pos) counts.

    The next write matters only within the lifetime, so it is looked for in the
    entry's own stretch of one lifetime and at the start of the next stretch: no
    task orders all writes of a busy match."""
    rows = log.select("cache_key", "payload", "written_at", "seq", "pos").withColumn("bucket", _bucket(F.col("written_at"), ttl_seconds))
    along = Window.partitionBy("cache_key", "bucket").orderBy("written_at", "seq", "pos")
    rows = rows.withColumn("next", F.lead("written_at").over(along))
    begins = rows.groupBy("cache_key", (F.col("bucket") - 1).alias("bucket")).agg(F.min("written_at").alias("after"))
    rows = rows.join(begins, ["cache_key", "bucket"], "left")
    expires = F.col("written_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))
    ends = F.least(expires, F.coalesce("next", "after", expires))
    return rows.select("cache_key", "payload", F.col("written_at").alias("valid_from"), ends.alias("valid_to")).filter("valid_from < valid_to")


def cache_at(log: DataFrame, instants: list[_dt.datetime], ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """(as_of, cache_key, payload, written_at, expires_at): the cache as it stood at
    each of a list of instants, past ones included.  Only writes of the lifetime
    before an instant are read (the day folders prune)."""
    if not instants:
        raise ValueError("no instant")
    spark = log.sparkSession
    asked = spark.createDataFrame([(t,) for t in sorted(set(instants))], "as_of timestamp_ntz")
    days = {t.date() - _dt.timedelta(days=d) for t in instants for d in range(2 + ttl_seconds // 86_400)}
    recent = log.filter(F.col("written_day").isin(sorted(days)))
    # an entry alive at an instant was written in the same lifetime-long stretch of time or in the one before
    here = _bucket(F.col("as_of"), ttl_seconds)
    asked = asked.select("as_of", F.explode(F.array(here, here - 1)).alias("bucket"))
    alive = recent.withColumn("bucket", _bucket(F.col("written_at"), ttl_seconds)).join(asked, "bucket")
    age = F.col("as_of") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    alive = alive.filter((F.col("written_at") <= F.col("as_of")) & (F.col("written_at") > age))
    newest = alive.groupBy("as_of", "cache_key").agg(F.max_by(F.struct("payload", "written_at"), F.struct("written_at", "seq", "pos")).alias("c"))
    expires = F.col("c.written_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))
    return newest.select("as_of", "cache_key", F.col("c.payload").alias("payload"), F.col("c.written_at").alias("written_at"), expires.alias("expires_at"))


# --- closed entries --------------------------------------------------------------------------


def cache_sessions(writes: DataFrame, ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """The lives of cache entries: one row per key and unbroken stretch of writes,
    each written before the last one expired.  On a batch or a stream."""
    last = F.max_by("payload", F.struct("fetched_at", "seq", "pos"))
    lives = writes.groupBy("match_id", F.session_window("event_time", f"{ttl_seconds} seconds")).agg(
        F.min("fetched_at").alias("opened_at"), F.max("fetched_at").alias("last_written_at"), F.count(F.lit(1)).alias("n_writes"), last.alias("payload")
    )
    expired = F.col("last_written_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))
    return lives.select(
        F.concat(F.lit("live:"), F.col("match_id")).alias("cache_key"), "opened_at", "last_written_at", expired.alias("expired_at"), "n_writes", "payload"
    )


def start_cache_sessions(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    ttl_seconds: int = CACHE_TTL_SECONDS,
    late_seconds: int | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "60 seconds",
    state_partitions: int | None = None,
    rocksdb_state: bool = True,
    source_format: str = "json",
) -> StreamingQuery:
    """Append an entry's life once it has expired: when the watermark (latest event
    time less ``late_seconds``, by default the lifetime) has passed its end.  Writes of
    a busy match are merged before the shuffle."""
    session = stream_session(spark, state_partitions, rocksdb_state)
    session.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    writes = _open_writes(session, source_path, max_files_per_trigger, source_format)
    late = ttl_seconds if late_seconds is None else late_seconds
    lives = cache_sessions(writes.withWatermark("event_time", f"{late} seconds"), ttl_seconds)
    writer = lives.writeStream.format("parquet").outputMode("append").option("path", table_path).option("checkpointLocation", checkpoint_path)
    return triggered(writer, available_now, processing_time).start()

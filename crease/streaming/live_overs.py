"""Overs as they are bowled: a stream of deliveries joined with a stream of
matches, added up per match, innings and over.

Both sides have a watermark and a delivery belongs to a match of the same day, so
state holds only the matches and deliveries of the time that may still meet.  A
joined delivery is emitted once; each micro-batch writes its partial sums per over as
a part of the table (replays overwrite it), and readers add the parts up.

``replay_live_overs`` lands recorded events as they once came, slice of time after
slice, and has the stream take each before the next, so that what waits in state is
a slice's and not all there is.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crease.sources import tables
from crease.streaming.live_state import stream_session, triggered

# Landed as JSON Lines: when a ball was bowled, when a match began, as instants.
DELIVERY_EVENT = (
    "match_id bigint, bowled_at timestamp, first_innings boolean, over_number bigint, batter string, bowler string, "
    "runs_batter bigint, runs_total bigint, is_wicket int"
)
MATCH_EVENT = "match_id bigint, began_at timestamp, season string, venue string, team1 string, team2 string"
SAME_MATCH = "1 day"  # from a match's first to its last ball
LATE = "2 days"
WAITING_DAYS = 3  # both of them: what may still meet when a later slice comes

# landed text repeats its field names in every line
LANDED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"}
DAY_SECONDS = 86_400
ROW_ON_HEAP = 600  # bytes of a row in state and in the version of the state before it
HEAP_SHARE = 0.25  # of a JVM's heap, for state


def joined_deliveries(deliveries: DataFrame, matches: DataFrame, late: str = LATE) -> DataFrame:
    """Deliveries with season, venue and batting team of their match.  On streams
    or batches; a delivery without its match waits for it as long as the watermark
    allows."""
    d = deliveries.withWatermark("bowled_at", late)
    m = matches.withWatermark("began_at", late).withColumnRenamed("match_id", "of")
    within = (F.col("bowled_at") >= F.col("began_at")) & (F.col("bowled_at") < F.col("began_at") + F.expr(f"INTERVAL {SAME_MATCH}"))
    joined = d.join(m, (F.col("match_id") == F.col("of")) & within)
    return joined.withColumn("batting_team", F.when(F.col("first_innings"), F.col("team1")).otherwise(F.col("team2"))).drop("of", "team1", "team2")


def over_partials(balls: DataFrame) -> DataFrame:
    """Sums per match, innings and over, which add up over any parts."""
    return balls.groupBy("season", "match_id", "batting_team", "over_number").agg(
        F.count(F.lit(1)).alias("balls"),
        F.sum("runs_total").alias("runs"),
        F.sum(F.col("is_wicket").cast("bigint")).alias("wickets"),
        F.min("bowled_at").alias("first_ball_at"),
        F.max("bowled_at").alias("last_ball_at"),
    )


def start_live_overs(
    spark: SparkSession,
    deliveries_path: str,
    matches_path: str,
    table_path: str,
    checkpoint_path: str,
    *,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "60 seconds",
    state_partitions: int | None = None,
    rocksdb_state: bool = True,
    late: str = LATE,
    kept_batches: int | None = None,
) -> StreamingQuery:
    """Start the overs stream over two landing folders; table and checkpoint on
    shared storage.  Options as for the current-state stream; ``kept_batches``: how
    many micro-batches the checkpoint keeps the state of (default: the session's)."""
    session = stream_session(spark, state_partitions, rocksdb_state)
    if kept_batches:
        session.conf.set("spark.sql.streaming.minBatchesToRetain", str(kept_batches))

    def opened(path: str, schema: str) -> DataFrame:
        reader = session.readStream.schema(schema)
        return (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader).json(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        over_partials(batch).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    # state keeps what the sums need and no other column
    deliveries = opened(deliveries_path, DELIVERY_EVENT).select("match_id", "bowled_at", "first_innings", "over_number", "runs_total", "is_wicket")
    matches = opened(matches_path, MATCH_EVENT).select("match_id", "began_at", "season", "team1", "team2")
    balls = joined_deliveries(deliveries, matches, late)
    writer = balls.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path).foreachBatch(write)
    return triggered(writer, available_now, processing_time).start()


def read_overs(spark: SparkSession, table_path: str) -> DataFrame:
    """(season, match_id, batting_team, over_number, balls, runs, wickets,
    first_ball_at, last_ball_at) of every over so far."""
    parts = spark.read.parquet(table_path)
    parts = tables.by_key(parts, tables.tasks_for(parts), "match_id")
    return parts.groupBy("season", "match_id", "batting_team", "over_number").agg(
        F.sum("balls").alias("balls"), F.sum("runs").alias("runs"), F.sum("wickets").alias("wickets"),
        F.min("first_ball_at").alias("first_ball_at"), F.max("last_ball_at").alias("last_ball_at"),
    )


# --- recorded events ------------------------------------------------------------------


def _day(at: str) -> Column:
    return F.floor(F.unix_seconds(at) / DAY_SECONDS)


def events_by_day(events: DataFrame, at: str) -> Counter[int]:
    """Events per day since 1970 (UTC); those without a time meet no other."""
    days = events.select(_day(at).alias("day")).filter("day IS NOT NULL").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return Counter({r["day"]: r["n"] for r in days.collect()})


def day_cuts(events: Mapping[int, int], rows: int) -> list[int]:
    """First days of the second and later slices, each of so many events or a single
    day's."""
    cuts, taken = [], 0
    for day in sorted(events):
        if taken and taken + events[day] > rows:
            cuts.append(day)
            taken = 0
        taken += events[day]
    return cuts


def slice_rows(events: Mapping[int, int], cuts: Sequence[int], days_before: int = 0) -> int:
    """The most events that a slice has, together with so many days before it."""
    held: Counter[int] = Counter()
    for day, n in events.items():
        for k in range(bisect.bisect_right(cuts, day), bisect.bisect_right(cuts, day + days_before) + 1):
            held[k] += n
    return max(held.values(), default=0)


def _slice_of(day: Column, cuts: Sequence[int], first: int = 0) -> Column:
    """The number of cuts up to ``day``, by halves."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(day < cuts[mid], _slice_of(day, cuts[:mid], first)).otherwise(_slice_of(day, cuts[mid + 1 :], first + mid + 1))


def rows_on_heap(spark: SparkSession) -> int:
    """Events of a slice whose state the JVMs that run tasks can hold on their heaps."""
    sc, jvm = spark.sparkContext, spark._jvm
    if sc.master.split("[")[0] == "local":
        heap = jvm.java.lang.Runtime.getRuntime().maxMemory()
    else:
        executors = max(1, sc._jsc.sc().getExecutorMemoryStatus().size() - 1)
        heap = executors * jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(sc.getConf().get("spark.executor.memory", "1g"))
    return int(heap * HEAP_SHARE / ROW_ON_HEAP)


def land_slices(events: DataFrame, at: str, cuts: Sequence[int], rows: int, path: str) -> None:
    """Events as JSON Lines under ``path/slice=<k>``; with cuts, or where a slice has
    more ``rows`` than a task takes, dealt by match to as many files as those need."""
    sliced = events.withColumn("slice", _slice_of(_day(at), cuts))
    files = math.ceil(rows / tables.ROWS_PER_TASK)
    if cuts or files > 1:
        sliced = sliced.repartition((len(cuts) + 1) * max(1, files), "slice", F.pmod(F.xxhash64("match_id"), F.lit(max(1, files))))
    sliced.write.partitionBy("slice").options(**LANDED).json(path)


def replay_live_overs(spark: SparkSession, deliveries: DataFrame, matches: DataFrame, folder: str, rows: int | None = None) -> str:
    """Land recorded events under ``folder`` in the order of their time and run the
    stream over them; returns its table.

    A slice has ``rows`` events (default: as many as the heap can hold the state of)
    and whole days.  It appears in the landing folder as a whole, after what came
    before it was taken, so that no event is late.  Its state is on the heap; off it
    if single days are larger than that."""
    rows = rows or rows_on_heap(spark)
    sides = {"matches": (matches, "began_at"), "deliveries": (deliveries, "bowled_at")}
    by_day = {name: events_by_day(df, at) for name, (df, at) in sides.items()}
    events = sum(by_day.values(), Counter())
    cuts = day_cuts(events, rows)
    staging, landing, table = (f"{folder}/{name}" for name in ("staging", "landing", "table"))
    for name, (df, at) in sides.items():
        land_slices(df, at, cuts, slice_rows(by_day[name], cuts), f"{staging}/{name}")
    query = start_live_overs(
        spark, f"{landing}/*/deliveries", f"{landing}/*/matches", table, f"{folder}/checkpoint", processing_time="200 milliseconds",
        state_partitions=spark.sparkContext.defaultParallelism, rocksdb_state=slice_rows(events, cuts, WAITING_DAYS) > 2 * rows, kept_batches=2,
    )
    try:
        for k in range(len(cuts) + 1):
            for name in sides:
                _move(spark, f"{staging}/{name}/slice={k}", f"{staging}/{k}/{name}")
            _move(spark, f"{staging}/{k}", f"{landing}/{k}")
            query.processAllAvailable()
    finally:
        query.stop()
    return table


def _move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, if it is there."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(source):
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"cannot rename {path} to {to}")

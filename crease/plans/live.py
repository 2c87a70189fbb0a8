"""The live job: state, cache and quarantine streams over one landing folder,
and the publication of the current state, again and again while they run.

``python -m crease.plans.live LANDING OUTPUT [--available-now]``
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crease.operators.live import live_report
from crease.sources.commits import drop_old_runs, save_set
from crease.sources.tables import register_views
from crease.streaming.live_cache import read_live_cache, start_cache_log, start_cache_sessions, start_live_cache
from crease.streaming.live_quarantine import start_live_quarantine
from crease.streaming.live_state import read_live_state, start_live_state


COMPACT_EVERY = 100  # micro-batches between two folds of a changelog


def start_live(spark: SparkSession, landing: str, root: str, compact_every: int | None = COMPACT_EVERY, **options) -> dict[str, StreamingQuery]:
    """Start the streams; tables and checkpoints go under ``root`` (shared
    storage).  ``options`` are those that all of them take."""
    starts = {
        "live_state": start_live_state,
        "live_cache": start_live_cache,
        "live_quarantine": start_live_quarantine,
        "cache_log": start_cache_log,
        "cache_sessions": start_cache_sessions,
    }
    folded = {"live_state": {"compact_every": compact_every}, "live_cache": {"compact_every": compact_every}}
    return {
        name: start(spark, landing, f"{root}/{name}", f"{root}/checkpoints/{name}", **options, **folded.get(name, {}))
        for name, start in starts.items()
    }


def run_live(
    spark: SparkSession, queries: dict[str, StreamingQuery], root: str, output: str, publish_seconds: float = 60.0, rounds: int | None = None, **sink
) -> None:
    """Publish the current state every ``publish_seconds`` while the streams run,
    until one of them stops (its error is raised) or, if given, for so many
    ``rounds``.  Before the first micro-batch there is nothing to publish."""
    watched = queries["live_state"]
    published = 0
    while rounds is None or published < rounds:
        stopped = watched.awaitTermination(publish_seconds)
        failed = [q.exception() for q in queries.values() if not q.isActive and q.exception()]
        if failed:
            raise failed[0]
        if table_exists(spark, f"{root}/live_state"):
            publish_live(spark, root, output, **sink)
            published += 1
        if stopped or not all(q.isActive for q in queries.values()):
            return


def live_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The live tables as users read them: those that a stream has written to."""
    state = read_live_state(spark, f"{root}/live_state")
    tables = {"live_matches": state, "live_report": live_report(state)}
    if table_exists(spark, f"{root}/live_cache"):
        tables["live_cache"] = read_live_cache(spark, f"{root}/live_cache")
    for name, folder in (("live_quarantine", "live_quarantine"), ("live_cache_log", "cache_log"), ("live_cache_expired", "cache_sessions")):
        if table_exists(spark, f"{root}/{folder}"):
            tables[name] = spark.read.parquet(f"{root}/{folder}")
    return tables


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stream has written a first file there."""
    try:
        spark.read.parquet(path)
    except AnalysisException:  # no folder, or no file to read a schema from
        return False
    return True


def publish_live(spark: SparkSession, root: str, output: str, **sink) -> dict[str, str]:
    """Save the current state, to the database or as Parquet, and register
    the live tables as ``ipl_<name>`` views.  A Parquet state is a set of its own
    (:mod:`crease.sources.commits`): readers see one publication or the next,
    ``read_set(spark, output)``; the folders of the last three stay."""
    tables = live_tables(spark, root)
    register_views(tables)
    where = save_set({"live_matches": tables["live_matches"]}, output, **sink)
    drop_old_runs(spark, output, keep=3)
    return where


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="crease.plans.live", description="landed live responses -> current state, cache, quarantine")
    ap.add_argument("landing", help="folder of landed responses (JSON Lines)")
    ap.add_argument("output", help="root of tables and checkpoints, on shared storage")
    ap.add_argument("--available-now", action="store_true", help="take what has landed, publish the state and stop")
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--publish-seconds", type=float, default=60.0, help="time between two publications of the current state")
    ap.add_argument("--source-format", choices=("json", "text"), default="json", help="text: lines parsed as a Kafka topic's values are")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("crease-live").getOrCreate()
    queries = start_live(
        spark, args.landing, args.output, max_files_per_trigger=args.max_files_per_trigger, available_now=args.available_now,
        source_format=args.source_format,
    )
    if args.available_now:
        for query in queries.values():
            query.awaitTermination()
        publish_live(spark, args.output, f"{args.output}/published")
    else:
        run_live(spark, queries, args.output, f"{args.output}/published", args.publish_seconds)


if __name__ == "__main__":
    main()

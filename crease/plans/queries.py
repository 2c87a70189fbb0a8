"""Registered queries: one per operator of the inventory, each a function of
(spark, sf_dir) over the provided tables.

Statistics and reports run on the flat match / ball tables derived from
``orders`` and ``lineitem``; the nested path (documents -> flatten) and the
JSON / Parquet round trips are checked by their own queries against the same
flat SQL.  Wall-clock columns (processed_at) are left out of checked outputs.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.functions.core import short_id
from crease.operators import careers, flatten, live, reports, stats
from crease.plans import incremental, pipeline, quality
from crease.plans import sql as sqlpath
from crease.session import scratch_path
from crease.sources import documents, drift, testdata
from crease.sources.sinks import read_parquet_like, write_parquet
from crease.sources.tables import by_key
from crease.streaming import live_cache, live_overs, live_quarantine, live_state

Query = Callable[[SparkSession, str], DataFrame]


# --- nested path ---------------------------------------------------------------------


def q_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = testdata.match_documents(spark, sf_dir)
    return flatten.for_sink(flatten.matches_table(docs, with_load_time=False))


def q_balls_by_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = testdata.match_documents(spark, sf_dir)
    return flatten.balls_by_ball(docs, with_load_time=False).drop("ball_id")


def q_wicket_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = testdata.match_documents(spark, sf_dir)
    b = flatten.balls_by_ball(docs, with_load_time=False)
    return b.filter(F.col("is_wicket") == 1).select("match_id", "batting_team", "over_number", "batter", "bowler", "wicket_details")


# landed text repeats its field names in every line; a file is one task's, so that reading them stays parallel
PACKED = {"compression": "gzip"}


def land_documents(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> tuple[str, str]:
    """Land the documents as JSON Lines under the shared checkpoint folder;
    returns (folder, glob).  With ``corrupt``, documents of low-priority
    pending orders land truncated (unparsable), those of pending orders without a
    priority as JSON that is no document (a number, a text, a list or an empty
    object, by key), and those of urgent finished ones with a revision that is no
    number (still a match), as raw text."""
    docs = testdata.match_documents(spark, sf_dir)
    path = scratch_path(spark, "landed-docs")
    if not corrupt:
        docs.select("info", "innings", "meta").write.options(**PACKED).json(path)
        return path, "*.json.gz"
    text = F.to_json(F.struct("info", "innings", "meta"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    bad = (status == "P") & (priority == "5-LOW")
    none = (status == "P") & (priority == "4-NOT SPECIFIED")
    odd = (status == "F") & (priority == "1-URGENT")
    garbled = (
        F.when(bad, F.substr(text, F.lit(1), (F.length(text) / 2).cast("int")))
        .when(none, F.element_at(F.array(*[F.lit(x) for x in ("123", '"abc"', "[1,2]", "{}")]), (F.col("match_id") % 4 + 1).cast("int")))
        .when(odd, F.replace(text, F.lit('"revision":1'), F.lit('"revision":"draft"')))
        .otherwise(text)
    )
    docs.join(_order_kinds(spark, sf_dir), "match_id").select(garbled.alias("value")).write.options(**PACKED, **{"zlib.compress.level": "BEST_SPEED"}).text(path)
    return path, "*.txt.gz"


def _order_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"), "o_orderstatus", "o_orderpriority")


def land_drifted(spark: SparkSession, sf_dir: str) -> str:
    """Land documents whose fields changed type: a revision that is text (urgent
    finished orders), over numbers as text (high-priority open ones), an umpire that
    nobody declared (medium-priority pending ones) and a list in place of the outcome
    (low-priority finished ones)."""
    docs = testdata.match_documents(spark, sf_dir)
    path = scratch_path(spark, "drifted-docs")
    text = F.to_json(F.struct("info", "innings", "meta"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    changed = (
        F.when((status == "F") & (priority == "1-URGENT"), F.replace(text, F.lit('"revision":1'), F.lit('"revision":"draft"')))
        .when((status == "O") & (priority == "2-HIGH"), F.regexp_replace(text, r'"over":(\d+)', '"over":"$1"'))
        .when((status == "P") & (priority == "3-MEDIUM"), F.replace(text, F.lit('"info":{'), F.lit('"info":{"umpire":{"name":"U"},')))
        .when((status == "F") & (priority == "5-LOW"), F.regexp_replace(text, r'"outcome":\{"winner":"[^"]*","by":\{[^}]*\}\}', '"outcome":["T1"]'))
        .otherwise(text)
    )
    docs.join(_order_kinds(spark, sf_dir), "match_id").select(changed.alias("value")).write.options(**PACKED).text(path)
    return path


def _read_landed(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    path, glob = land_documents(spark, sf_dir, corrupt)
    return documents.read_match_documents(spark, path, multi_line=False, glob=glob)


def q_nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON round trip: documents landed, read back with the schema, flattened."""
    docs = _read_landed(spark, sf_dir)
    return flatten.balls_by_ball(docs, with_load_time=False).drop("match_id", "ball_id")


def q_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read_landed(spark, sf_dir)
    return flatten.for_sink(flatten.matches_table(docs, with_load_time=False)).drop("match_id")


def q_corrupt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse once into the bronze table (as the pipeline does), then split:
    a query over the JSON reader that touches only the corrupt-record column
    is refused by Spark, and re-parsing per branch would double the work."""
    docs = _read_landed(spark, sf_dir, corrupt=True)
    bronze = spark.read.parquet(pipeline.land_bronze(docs, scratch_path(spark, "bronze")))
    valid, quarantine = documents.split_corrupt(bronze)
    return valid.select(F.lit("valid").alias("record_state"), "info").unionByName(
        quarantine.select(F.lit("quarantined").alias("record_state"), F.lit(None).cast(docs.schema["info"].dataType).alias("info"))
    ).groupBy("record_state").agg(F.count(F.lit(1)).alias("n_documents"), F.count("info.season").alias("n_with_season"))


def _again(docs: DataFrame, twice: Column) -> DataFrame:
    """The documents, those ``twice`` says two times; they are built once."""
    return docs.withColumn("__copy", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("__copy")


def q_id_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, balls and their distinct ids, through the JSON reader.  Every
    50th document is landed twice, and all of them in two layouts: ``n_shared`` ids
    are found in both."""
    docs = testdata.match_documents(spark, sf_dir)
    docs = _again(docs, F.col("match_id") % 50 == 0).select("info", "innings", "meta")

    n = testdata.delivery_tasks(spark, sf_dir)

    def load(layout: str, glob: str) -> DataFrame:
        read = documents.read_match_documents(spark, paths[layout], multi_line=False, glob=glob)
        return documents.separate_repeats(spark.read.parquet(pipeline.land_bronze(read, scratch_path(spark, f"bronze-ids-{layout}"))))

    paths = {layout: scratch_path(spark, f"landed-ids-{layout}") for layout in ("as-is", "by-venue")}
    docs.write.options(**PACKED).json(paths["as-is"])
    # dealt as text, which takes less room on the way than nested rows
    text = docs.select(F.col("info.venue").alias("venue"), F.to_json(F.struct("info", "innings", "meta")).alias("value"))
    text.repartition(max(3, n or 0), "venue").select("value").write.options(**PACKED).text(paths["by-venue"])
    one, two = load("as-is", "*.json.gz"), load("by-venue", "*.txt.gz")

    def counts(level: str, key: str, a: DataFrame, b: DataFrame) -> DataFrame:
        ids = [df.select(short_id(key).alias("id"), F.lit(x).alias("a"), F.lit(1 - x).alias("b")) for df, x in ((a, 1), (b, 0))]
        per_id = by_key(ids[0].unionByName(ids[1]), n, "id").groupBy("id").agg(F.sum("a").alias("n"), F.max("b").alias("shared")).filter("n > 0")
        return per_id.agg(F.lit(level).alias("level"), F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), F.count(F.when(F.col("shared") > 0, 1)).alias("n_shared"))

    balls = lambda df: flatten.balls_by_ball(df, with_load_time=False)
    return counts("match", "match_id", one, two).unionByName(counts("ball", "ball_id", balls(one), balls(two)))


def _loaded_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """Root of an incremental load of two landings: documents of even keys, then
    the others and, again, every 50th of the first."""
    docs = testdata.match_documents(spark, sf_dir)
    landing, root = scratch_path(spark, "landing-parts"), scratch_path(spark, "incremental")
    first = docs.filter("match_id % 2 = 0")
    for name, part in (("first", first), ("second", docs.filter("match_id % 2 <> 0").unionByName(first.filter("match_id % 50 = 0")))):
        part.select("info", "innings", "meta").write.options(**PACKED).json(f"{landing}/{name}")
        incremental.load_new(spark, f"{landing}/*", root, glob="*.json.gz")
    return root


def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balls loaded in two landings: per season the balls, matches and runs of silver."""
    balls = incremental.read_table(spark, _loaded_in_parts(spark, sf_dir), "balls_by_ball")
    return balls.groupBy("season").agg(
        F.count(F.lit(1)).alias("n_balls"), F.countDistinct(short_id("ball_id")).alias("n_ids"), F.countDistinct(short_id("match_id")).alias("n_matches"), F.sum("runs_total").alias("runs")
    )


def q_incremental_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One figure per group of the five statistics, added up from the partial sums
    that two landings stored."""
    return _figures(incremental.read_statistics(spark, _loaded_in_parts(spark, sf_dir)))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the declared schema would null, per field, over landed documents."""
    return drift.drift_table(drift.read_variants(spark, land_drifted(spark, sf_dir), glob="*.txt.gz"))


def q_pipeline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over landed documents (bronze, silver, gold): one figure
    per group of each of the five saved statistics."""
    path, glob = land_documents(spark, sf_dir)
    job = pipeline.run_pipeline(spark, path, scratch_path(spark, "job"), multi_line=False, glob=glob)
    return _figures(job.stats)


def _figures(tables: dict[str, DataFrame]) -> DataFrame:
    figures = {
        "team_stats": ("season", "team", "matches_won"),
        "player_batting_stats": ("season", "batter", "total_runs"),
        "player_bowling_stats": ("season", "bowler", "runs_conceded"),
        "season_trends": ("season", None, "total_runs"),
        "venue_stats": (None, "venue", "total_balls"),
    }
    parts = [
        tables[name].select(
            F.lit(name).alias("statistic"),
            (F.col(season) if season else F.lit(None).cast("string")).alias("season"),
            (F.col(of) if of else F.lit(None).cast("string")).alias("of"),
            F.col(figure).cast("bigint").alias("figure"),
        )
        for name, (season, of, figure) in figures.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def q_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    balls = testdata.balls(spark, sf_dir)
    path = write_parquet(balls, scratch_path(spark, "balls-parquet"), ["season"])
    return read_parquet_like(spark, path, balls.schema)


# --- statistics ----------------------------------------------------------------------------


def _matches(spark, sf_dir):
    return testdata.matches(spark, sf_dir)


def _balls(spark, sf_dir):
    return testdata.balls(spark, sf_dir)


def q_team_stats(spark, sf_dir):
    return stats.team_stats(_matches(spark, sf_dir))


def q_batting(spark, sf_dir):
    return stats.player_batting_stats(_balls(spark, sf_dir))


def q_bowling(spark, sf_dir):
    return stats.player_bowling_stats(_balls(spark, sf_dir))


def q_season_trends(spark, sf_dir):
    return stats.season_trends(_balls(spark, sf_dir))


def q_venue_stats(spark, sf_dir):
    return stats.venue_stats(_balls(spark, sf_dir))


# --- reports -----------------------------------------------------------------------------


# T-1 ... T-5: each statistic in the order the reference gives it
def q_team_stats_sorted(spark, sf_dir):
    return reports.sorted_team_stats(q_team_stats(spark, sf_dir))


def q_batting_sorted(spark, sf_dir):
    return reports.sorted_batting(q_batting(spark, sf_dir))


def q_bowling_sorted(spark, sf_dir):
    return reports.sorted_bowling(q_bowling(spark, sf_dir))


def q_seasons_sorted(spark, sf_dir):
    return reports.sorted_seasons(q_season_trends(spark, sf_dir))


def q_venues_sorted(spark, sf_dir):
    return reports.sorted_venues(q_venue_stats(spark, sf_dir))


def q_top_run_scorers(spark, sf_dir):
    return reports.top_run_scorers(q_batting(spark, sf_dir))


def q_top_bowlers(spark, sf_dir):
    return reports.top_bowlers(q_bowling(spark, sf_dir))


def q_team_performance(spark, sf_dir):
    return reports.team_performance(q_team_stats(spark, sf_dir))


def q_season_listing(spark, sf_dir):
    return reports.season_listing(q_season_trends(spark, sf_dir))


def q_top_venues(spark, sf_dir):
    return reports.top_venues(q_venue_stats(spark, sf_dir))


def _stats_views(spark, sf_dir):
    return {
        "team_stats": q_team_stats(spark, sf_dir),
        "player_batting_stats": q_batting(spark, sf_dir),
        "season_trends": q_season_trends(spark, sf_dir),
    }


def q_sql_reports_team(spark, sf_dir):
    return reports.sql_report(spark, _stats_views(spark, sf_dir), "team")


def q_sql_reports_batting(spark, sf_dir):
    return reports.sql_report(spark, _stats_views(spark, sf_dir), "batting")


def q_sql_reports_seasons(spark, sf_dir):
    return reports.sql_report(spark, _stats_views(spark, sf_dir), "seasons")


# --- careers, comparison, quality ---------------------------------------------------------


def q_career_batting(spark, sf_dir):
    """Season, career and all-player batting totals in one pass."""
    return careers.career_batting(_balls(spark, sf_dir))


def q_player_comparison(spark, sf_dir):
    """Every qualified batter's standing in the season."""
    return careers.compare_batters(q_batting(spark, sf_dir))


def q_quality_checks(spark, sf_dir):
    """Rows that break each rule, counted while the silver tables are written."""
    return quality.report(
        {
            "matches": (_matches(spark, sf_dir), scratch_path(spark, "checked-matches"), quality.match_rules()),
            "balls_by_ball": (_balls(spark, sf_dir), scratch_path(spark, "checked-balls"), quality.ball_rules()),
        }
    )


# --- SQL path over the team-titles relation ------------------------------------------------


def _titles(spark, sf_dir):
    return sqlpath.team_titles(q_team_stats(spark, sf_dir))


def q_team_titles(spark, sf_dir):
    return _titles(spark, sf_dir)


def q_sql_filter(spark, sf_dir):
    return sqlpath.sql_filter(spark, _titles(spark, sf_dir))


def q_global_sum(spark, sf_dir):
    return stats.global_sum(_titles(spark, sf_dir), "titles", "sum_titles")


def q_sql_sum(spark, sf_dir):
    return sqlpath.sql_sum(spark, _titles(spark, sf_dir))


# --- live -------------------------------------------------------------------------------


def _live(spark, sf_dir):
    snaps = live.snapshot_rows(testdata.live_responses(spark, sf_dir))
    valid, quarantine = live.validate_snapshots(snaps)
    return live.live_rows(valid), quarantine


def q_live_flags(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return rows.select("seq", "match_id", "status", "is_ongoing", "is_completed", "state")


def q_live_scores(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return rows.select("seq", "match_id", "venue", "team1_score", "team2_score", "current_over")


def q_live_chase(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return rows.select("seq", "match_id", "target", "required_rate")


def q_live_result(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return rows.select("seq", "match_id", "team1", "team2", "winner", "result_margin")


def _decimals_as_doubles(df: DataFrame) -> DataFrame:
    """The table's decimals as doubles, which every checker compares alike."""
    return df.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else n for n, t in df.dtypes])


def q_live_matches(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return _decimals_as_doubles(live.current_state(rows))


def q_live_report(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return _decimals_as_doubles(live.live_report(live.current_state(rows)))


def q_live_cache(spark, sf_dir):
    rows, _ = _live(spark, sf_dir)
    return live.cache_entries(rows)


def q_live_cache_as_of(spark, sf_dir):
    """The cache as it stood at a past instant."""
    rows, _ = _live(spark, sf_dir)
    return live.cache_entries(rows, as_of=dt.datetime(2024, 1, 15, 12))


def q_live_quarantine(spark, sf_dir):
    return live.rejected_snapshots(testdata.live_responses(spark, sf_dir)).select("seq", "match_id", "reason")


def q_live_quarantine_stream(spark, sf_dir):
    """What the live streams leave out, kept by the quarantine stream over
    landed response files and read back from its table."""
    source = live_state.land_responses(testdata.live_responses(spark, sf_dir), scratch_path(spark, "reject-landing"))
    table = scratch_path(spark, "reject-table")
    query = live_quarantine.start_live_quarantine(spark, source, table, scratch_path(spark, "reject-ckpt"), available_now=True)
    query.awaitTermination()
    return spark.read.parquet(table).select("seq", "match_id", "reason")


def q_live_quarantine_replay(spark, sf_dir):
    """Every response landed twice, the second time while the stream has already
    taken the first: each reject is kept once."""
    landing = scratch_path(spark, "replay-landing")
    table, ckpt = scratch_path(spark, "replay-table"), scratch_path(spark, "replay-ckpt")
    for name in ("first", "again"):
        live_state.land_responses(testdata.live_responses(spark, sf_dir), f"{landing}/{name}")
        live_quarantine.start_live_quarantine(spark, f"{landing}/*", table, ckpt, available_now=True).awaitTermination()
    return spark.read.parquet(table).select("seq", "match_id", "reason")


def q_live_matches_stream(spark, sf_dir):
    """The same current state computed by a Structured Streaming job over
    landed response files, several micro-batches, read back from its table."""
    cores = spark.sparkContext.defaultParallelism
    source = live_state.land_responses(testdata.live_responses(spark, sf_dir), scratch_path(spark, "live-landing"), files=2 * cores)
    table = scratch_path(spark, "live-state")
    query = live_state.start_live_state(
        spark,
        source,
        table,
        scratch_path(spark, "live-ckpt"),
        max_files_per_trigger=cores,  # two micro-batches, every core busy in each
        available_now=True,
        state_partitions=cores,
    )
    query.awaitTermination()
    return _decimals_as_doubles(live_state.read_live_state(spark, table))


def q_live_overs_stream(spark, sf_dir):
    """Overs added up by a stream that joins landed deliveries with landed matches,
    which come in the order of their time."""
    deliveries, matches = testdata.live_events(spark, sf_dir)
    table = live_overs.replay_live_overs(spark, deliveries, matches, scratch_path(spark, "overs"))
    return live_overs.read_overs(spark, table).drop("first_ball_at", "last_ball_at")


def q_live_cache_stream(spark, sf_dir):
    """The recent-state cache kept by a stateful stream with TTL eviction,
    read back as of the latest snapshot."""
    cores = spark.sparkContext.defaultParallelism
    source = live_state.land_responses(testdata.live_responses(spark, sf_dir), scratch_path(spark, "cache-landing"), files=2 * cores)
    table = scratch_path(spark, "cache-table")
    query = live_cache.start_live_cache(
        spark,
        source,
        table,
        scratch_path(spark, "cache-ckpt"),
        max_files_per_trigger=cores,
        available_now=True,
        state_partitions=cores,
    )
    query.awaitTermination()
    return live_cache.read_live_cache(spark, table)


CACHE_INSTANTS = [dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 1, 25, 18, 30)]


def _cache_log(spark, sf_dir):
    """Every cache write, appended by a stream over landed response files."""
    source = live_state.land_responses(testdata.live_responses(spark, sf_dir), scratch_path(spark, "log-landing"))
    table = scratch_path(spark, "cache-log")
    live_cache.start_cache_log(spark, source, table, scratch_path(spark, "log-ckpt"), available_now=True).awaitTermination()
    return spark.read.parquet(table)


def q_live_cache_history(spark, sf_dir):
    """The cache as it stood at three past instants, from the stream's write log."""
    return live_cache.cache_at(_cache_log(spark, sf_dir), CACHE_INSTANTS)


def q_live_cache_intervals(spark, sf_dir):
    """From when to when each cache entry was valid."""
    return live_cache.cache_intervals(_cache_log(spark, sf_dir))


def q_live_cache_sessions(spark, sf_dir):
    """Lives of expired cache entries, emitted by the append-mode stream.  One
    micro-batch takes all files, the next one, without data, closes what has
    expired: no write is late, in whatever order the files were written."""
    source = live_state.land_responses(testdata.live_responses(spark, sf_dir), scratch_path(spark, "session-landing"))
    table = scratch_path(spark, "session-table")
    query = live_cache.start_cache_sessions(
        spark, source, table, scratch_path(spark, "session-ckpt"), available_now=True, state_partitions=spark.sparkContext.defaultParallelism
    )
    query.awaitTermination()
    return spark.read.parquet(table)


QUERIES: dict[str, Query] = {
    "matches": q_matches,
    "balls_by_ball": q_balls_by_ball,
    "wicket_details": q_wicket_details,
    "nested_flatten": q_nested_flatten,
    "json_scan": q_json_scan,
    "corrupt_quarantine": q_corrupt_quarantine,
    "id_uniqueness": q_id_uniqueness,
    "incremental_load": q_incremental_load,
    "incremental_stats": q_incremental_stats,
    "schema_drift": q_schema_drift,
    "pipeline_stats": q_pipeline_stats,
    "parquet_round_trip": q_parquet_round_trip,
    "team_stats": q_team_stats,
    "player_batting_stats": q_batting,
    "player_bowling_stats": q_bowling,
    "season_trends": q_season_trends,
    "venue_stats": q_venue_stats,
    "team_stats_sorted": q_team_stats_sorted,
    "player_batting_sorted": q_batting_sorted,
    "player_bowling_sorted": q_bowling_sorted,
    "season_trends_sorted": q_seasons_sorted,
    "venue_stats_sorted": q_venues_sorted,
    "top_run_scorers": q_top_run_scorers,
    "top_bowlers": q_top_bowlers,
    "team_performance": q_team_performance,
    "season_listing": q_season_listing,
    "top_venues": q_top_venues,
    "sql_reports_team": q_sql_reports_team,
    "sql_reports_batting": q_sql_reports_batting,
    "sql_reports_seasons": q_sql_reports_seasons,
    "career_batting": q_career_batting,
    "player_comparison": q_player_comparison,
    "quality_checks": q_quality_checks,
    "team_titles": q_team_titles,
    "sql_filter": q_sql_filter,
    "global_sum": q_global_sum,
    "sql_sum": q_sql_sum,
    "live_flags": q_live_flags,
    "live_scores": q_live_scores,
    "live_chase": q_live_chase,
    "live_result": q_live_result,
    "live_matches": q_live_matches,
    "live_report": q_live_report,
    "live_cache": q_live_cache,
    "live_cache_as_of": q_live_cache_as_of,
    "live_quarantine": q_live_quarantine,
    "live_quarantine_stream": q_live_quarantine_stream,
    "live_quarantine_replay": q_live_quarantine_replay,
    "live_matches_stream": q_live_matches_stream,
    "live_cache_stream": q_live_cache_stream,
    "live_overs_stream": q_live_overs_stream,
    "live_cache_history": q_live_cache_history,
    "live_cache_intervals": q_live_cache_intervals,
    "live_cache_sessions": q_live_cache_sessions,
}

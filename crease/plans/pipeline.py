"""The batch pipeline: documents -> silver (matches, balls) -> gold (stats).

The reference re-parses the JSON for every table it writes and every report it
prints (no caching), at least 13 passes.  Here the documents are parsed and
flattened once into Parquet "silver" tables (balls partitioned by season);
statistics and reports then read only the columns they need from Parquet.
Writing silver also cuts the lineage: a lost executor after that point
re-reads Parquet instead of re-parsing JSON.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators.flatten import balls_by_ball, for_sink, matches_table
from crease.operators import reports
from crease.operators.stats import production_stats
from crease.sources.commits import commit_set, drop_old_runs, new_run
from crease.sources.documents import read_match_documents, separate_repeats, split_corrupt
from crease.sources.sinks import output_tables, read_parquet_like, read_saved, save_tables, write_parquet
from crease.sources.tables import register_views


@dataclass
class PipelineResult:
    matches: DataFrame
    balls: DataFrame
    stats: dict[str, DataFrame]
    quarantine: DataFrame
    saved: dict[str, str] = field(default_factory=dict)


def land_bronze(docs: DataFrame, root: str) -> str:
    """Land parsed documents (corrupt ones included) as nested Parquet: the
    only pass that parses JSON.  Everything downstream reads this table."""
    return write_parquet(docs, f"{root}/bronze")


def build_silver(spark: SparkSession, bronze: DataFrame, root: str, season_folders: bool = True) -> tuple[DataFrame, DataFrame]:
    """Flatten valid documents once into Parquet matches and balls and return
    them read back from Parquet.

    ``season_folders`` partitions balls by season so season filters prune
    folders.  Rows are rebalanced on the season first: adaptive execution
    splits a large season over tasks of the advisory size and joins small
    ones, so the file count follows the data, not tasks x seasons.
    """
    matches = for_sink(matches_table(bronze))
    balls = balls_by_ball(bronze)
    if season_folders:
        balls = balls.hint("rebalance", F.col("season"))
    layout = {"balls_by_ball": ["season"]} if season_folders else None
    where = save_tables({"matches": matches, "balls_by_ball": balls}, root, partition_by=layout)
    return (
        read_parquet_like(spark, where["matches"], matches.schema),
        read_parquet_like(spark, where["balls_by_ball"], balls.schema),
    )


def run_pipeline(
    spark: SparkSession,
    input_path: str,
    output_root: str,
    *,
    multi_line: bool = True,
    glob: str = "*.json",
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    season_folders: bool = True,
    keep_runs: int | None = None,
) -> PipelineResult:
    """Load -> bronze -> quarantine / silver -> statistics -> sinks.

    Everything goes to a folder of this run; its commit, written last, makes the
    tables the current set (:mod:`crease.sources.commits`).  ``keep_runs``: delete
    the folders of all but the newest so many runs afterwards."""
    run_id, run = new_run(output_root)
    docs = read_match_documents(spark, input_path, multi_line=multi_line, glob=glob)
    bronze = spark.read.parquet(land_bronze(docs, run))
    valid, quarantine = split_corrupt(separate_repeats(bronze))
    write_parquet(quarantine, f"{run}/quarantine")
    matches, balls = build_silver(spark, valid, f"{run}/silver", season_folders)
    stats = production_stats(matches, balls)
    silver = {"matches": f"{run}/silver/matches", "balls_by_ball": f"{run}/silver/balls_by_ball"}
    saved = save_tables(
        output_tables(stats, matches, balls),
        f"{run}/gold",
        jdbc_url=jdbc_url,
        jdbc_properties=jdbc_properties,
        landed=silver,
    )
    commit_set(spark, output_root, run_id, {**saved, "quarantine": f"{run}/quarantine"})
    if keep_runs:
        drop_old_runs(spark, output_root, keep_runs)
    # views and reports read what was saved instead of aggregating again
    stats = {name: read_saved(spark, saved[name], df.schema, jdbc_url, jdbc_properties) for name, df in stats.items()}
    # the SQL path: every output table as an ipl_<name> view
    register_views(output_tables(stats, matches, balls))
    return PipelineResult(matches, balls, stats, spark.read.parquet(f"{run}/quarantine"), saved)


def display_insights(stats: dict[str, DataFrame], k: int = reports.TOP_K) -> None:
    """The console summary: top run scorers, top bowlers, team performance,
    season listing and top venues.  Each is a top-k (k rows to the driver)."""
    sections = [
        ("Most runs in a season", reports.top_run_scorers(stats["player_batting_stats"], k)),
        ("Lowest economy rates", reports.top_bowlers(stats["player_bowling_stats"], k)),
        ("Best win percentages", reports.team_performance(stats["team_stats"], k)),
        ("Seasons", reports.season_listing(stats["season_trends"])),
        ("Highest-scoring venues", reports.top_venues(stats["venue_stats"], k)),
    ]
    for title, df in sections:
        print(f"\n{title}")
        df.show(reports.LISTING_ROWS, truncate=False)


def main(argv: list[str] | None = None) -> PipelineResult:
    """Command line: ``python -m crease INPUT OUTPUT [--json-lines] [--glob G]
    [--jdbc-url URL --jdbc-user U --jdbc-password-file F] [--quiet]``."""
    ap = argparse.ArgumentParser(prog="crease", description="match documents -> statistics")
    ap.add_argument("input", help="folder of match documents")
    ap.add_argument("output", help="output root (bronze / silver / gold / quarantine)")
    ap.add_argument("--json-lines", action="store_true", help="documents are JSON Lines, not one per file")
    ap.add_argument("--glob", default="*.json")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-file", help="file holding the database password")
    ap.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    ap.add_argument("--quiet", action="store_true", help="skip the console summary")
    ap.add_argument("--keep-runs", type=int, help="delete the folders of all but the newest so many runs")
    ap.add_argument("--no-season-folders", action="store_true", help="do not partition balls by season")
    args = ap.parse_args(argv)
    props = None
    if args.jdbc_url:
        props = {"driver": args.jdbc_driver}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_file:
            with open(args.jdbc_password_file) as fh:
                props["password"] = fh.read().strip()
    spark = SparkSession.builder.appName("crease").getOrCreate()
    result = run_pipeline(
        spark,
        args.input,
        args.output,
        multi_line=not args.json_lines,
        glob=args.glob,
        jdbc_url=args.jdbc_url,
        jdbc_properties=props,
        season_folders=not args.no_season_folders,
        keep_runs=args.keep_runs,
    )
    if not args.quiet:
        display_insights(result.stats)
    return result

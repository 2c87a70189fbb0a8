"""The five statistics tables (A-1 ... A-5) and their HAVING cuts (F-3 ... F-5).

Each is one ``groupBy().agg()``.  Spark plans the distinct match count as a
two-level aggregation: partial aggregates keyed by (group, match_id) are built
map-side and shuffled on that composite key, then merged and shuffled on the
group key alone.  A hot group (one season or venue holding a third of all
balls) is therefore pre-reduced to one row per match per task before it is
shuffled, and never lands in a single task as raw rows.

The statistics are returned unsorted: a sort before a table write is lost
anyway; ordered presentations live in :mod:`crease.operators.reports`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions.core import count_if, percentage, ratio, short_id

# The qualification thresholds of the reference's tables.
MIN_BALLS_FACED = 50
MIN_BALLS_BOWLED = 60
MIN_VENUE_MATCHES = 10
BALLS_PER_OVER = 6


# Each statistic is a group table of sums and counts, which add up over sets of
# matches that share none, and the figures made of them.


def match_count(df: DataFrame) -> Column:
    """Exact number of different ``match_id``."""
    return F.countDistinct(short_id("match_id") if df.schema["match_id"].dataType.typeName() == "string" else F.col("match_id"))


def team_partials(matches: DataFrame) -> DataFrame:
    per_team = matches.select("season", "match_id", "winner", "toss_winner", F.explode("teams").alias("team"))
    return per_team.groupBy("season", "team").agg(
        match_count(matches).alias("matches_played"),
        count_if(F.col("winner") == F.col("team")).alias("matches_won"),
        count_if(F.col("toss_winner") == F.col("team")).alias("tosses_won"),
    )


def team_figures(agg: DataFrame) -> DataFrame:
    return agg.select(
        "*",
        percentage("matches_won", "matches_played").alias("win_percentage"),
        percentage("tosses_won", "matches_played").alias("toss_win_percentage"),
    )


def team_stats(matches: DataFrame) -> DataFrame:
    """A-1: per (season, team) matches played / won, tosses won, percentages.

    Matches without a winner count as played, not won.
    """
    return team_figures(team_partials(matches))


def batting_partials(balls: DataFrame) -> DataFrame:
    return balls.groupBy("season", "batter").agg(
        F.sum("runs_batter").alias("total_runs"),
        F.count(F.lit(1)).alias("balls_faced"),
        match_count(balls).alias("matches_played"),
        F.max("runs_batter").alias("highest_score"),
        count_if(F.col("runs_batter") == 4).alias("fours"),
        count_if(F.col("runs_batter") == 6).alias("sixes"),
        count_if(F.col("is_wicket") == 1).alias("times_out"),
    )


def batting_figures(agg: DataFrame, min_balls: int = MIN_BALLS_FACED) -> DataFrame:
    return agg.filter(F.col("balls_faced") >= min_balls).select(
        "*",
        percentage("total_runs", "balls_faced").alias("strike_rate"),
        F.when(F.col("times_out") > 0, F.round(ratio("total_runs", "times_out"), 2)).alias("average"),
        percentage(F.col("fours") + F.col("sixes"), "balls_faced").alias("boundary_percentage"),
    )


def player_batting_stats(balls: DataFrame, min_balls: int = MIN_BALLS_FACED) -> DataFrame:
    """A-2 + F-3: per (season, batter); ``average`` is null for a batter never out."""
    return batting_figures(batting_partials(balls), min_balls)


def bowling_partials(balls: DataFrame) -> DataFrame:
    return balls.groupBy("season", "bowler").agg(
        F.count(F.lit(1)).alias("balls_bowled"),
        F.sum("runs_total").alias("runs_conceded"),
        match_count(balls).alias("matches_played"),
        F.sum("is_wicket").cast("bigint").alias("wickets_taken"),
        count_if(F.col("runs_total") == 0).alias("dot_balls"),
    )


def bowling_figures(agg: DataFrame, min_balls: int = MIN_BALLS_BOWLED) -> DataFrame:
    overs = F.round(ratio("balls_bowled", F.lit(BALLS_PER_OVER)), 1)
    return (
        agg.filter(F.col("balls_bowled") >= min_balls)
        .withColumn("overs_bowled", overs)
        .select(
            "*",
            F.round(ratio("runs_conceded", "overs_bowled"), 2).alias("economy_rate"),
            F.when(F.col("wickets_taken") > 0, F.round(ratio("runs_conceded", "wickets_taken"), 2)).alias("bowling_average"),
            percentage("dot_balls", "balls_bowled").alias("dot_ball_percentage"),
        )
    )


def player_bowling_stats(balls: DataFrame, min_balls: int = MIN_BALLS_BOWLED) -> DataFrame:
    """A-3 + F-4: per (season, bowler).  Economy divides by overs already
    rounded to one decimal, as the reference does."""
    return bowling_figures(bowling_partials(balls), min_balls)


def season_partials(balls: DataFrame) -> DataFrame:
    return balls.groupBy("season").agg(
        F.sum("runs_total").alias("total_runs"),
        F.count(F.lit(1)).alias("total_balls"),
        match_count(balls).alias("total_matches"),
        F.sum("is_wicket").cast("bigint").alias("wickets"),
        F.count("runs_total").alias("balls_with_runs"),
    )


def season_figures(agg: DataFrame) -> DataFrame:
    per_ball = ratio("total_runs", "balls_with_runs")
    return agg.select(
        "season",
        per_ball.alias("avg_runs_per_ball"),
        "total_runs",
        "total_balls",
        "total_matches",
        ratio("wickets", "total_balls").alias("wicket_rate"),
        F.round(ratio("total_runs", "total_matches"), 2).alias("avg_runs_per_match"),
        F.round(per_ball * BALLS_PER_OVER, 2).alias("avg_runs_per_over"),
    )


def season_trends(balls: DataFrame) -> DataFrame:
    """A-4: per season run and wicket rates."""
    return season_figures(season_partials(balls))


def venue_partials(balls: DataFrame) -> DataFrame:
    return balls.groupBy("venue").agg(
        match_count(balls).alias("matches_played"),
        F.sum("runs_total").alias("total_runs"),
        F.count("runs_total").alias("balls_with_runs"),
        F.count(F.lit(1)).alias("total_balls"),
    )


def venue_figures(agg: DataFrame, min_matches: int = MIN_VENUE_MATCHES) -> DataFrame:
    per_ball = ratio("total_runs", "balls_with_runs")
    return agg.filter(F.col("matches_played") >= min_matches).select(
        "venue",
        "matches_played",
        per_ball.alias("avg_runs_per_ball"),
        "total_balls",
        F.round(per_ball * BALLS_PER_OVER, 2).alias("avg_runs_per_over"),
    )


def venue_stats(balls: DataFrame, min_matches: int = MIN_VENUE_MATCHES) -> DataFrame:
    """A-5 + F-5: per venue (a null venue forms its own group)."""
    return venue_figures(venue_partials(balls), min_matches)


@dataclass(frozen=True)
class Statistic:
    """A statistics table in two steps: ``partials`` of some matches, by ``keys``;
    ``figures`` of partials that were added up."""

    of: str  # table that it is made of
    keys: tuple[str, ...]
    partials: Callable[[DataFrame], DataFrame]
    figures: Callable[[DataFrame], DataFrame]


STATISTICS = {
    "team_stats": Statistic("matches", ("season", "team"), team_partials, team_figures),
    "player_batting_stats": Statistic("balls_by_ball", ("season", "batter"), batting_partials, batting_figures),
    "player_bowling_stats": Statistic("balls_by_ball", ("season", "bowler"), bowling_partials, bowling_figures),
    "season_trends": Statistic("balls_by_ball", ("season",), season_partials, season_figures),
    "venue_stats": Statistic("balls_by_ball", ("venue",), venue_partials, venue_figures),
}


def merge_partials(partials: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Add up partials of sets of matches that share none: sums and counts (of
    matches too) add, the highest score is the highest."""
    rest = [c for c in partials.columns if c not in keys]
    return partials.groupBy(*keys).agg(*[(F.max if c == "highest_score" else F.sum)(c).alias(c) for c in rest])


def production_stats(matches: DataFrame, balls: DataFrame) -> dict[str, DataFrame]:
    """All five statistics, keyed by table name."""
    return {
        "team_stats": team_stats(matches),
        "player_batting_stats": player_batting_stats(balls),
        "player_bowling_stats": player_bowling_stats(balls),
        "season_trends": season_trends(balls),
        "venue_stats": venue_stats(balls),
    }


def global_sum(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """A-6: a one-row total of a column (DataFrame API)."""
    return df.agg(F.sum(column).alias(alias or f"sum({column})"))

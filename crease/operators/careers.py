"""Career totals and the comparison of players, from the ball and batting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.functions.core import count_if, percentage, ratio

SEASON, CAREER, ALL = "season", "career", "all players"


def career_batting(balls: DataFrame) -> DataFrame:
    """(level, season, batter, total_runs, balls_faced, matches_played,
    highest_score, times_out, strike_rate, average): a row per season and batter,
    per batter over all seasons, and one over all players.

    One pass: balls are first added up per season, batter and match, and each such row
    says whether it is the first of its match, and the first of its batter in the match.
    The three levels are grouping sets over those rows that add up the rows or the
    firsts, map-side, which gives exact numbers of different matches at each level
    without a row per level and match.  ``level`` tells a total from a null season or
    batter."""
    per_match = balls.groupBy("season", "batter", "match_id").agg(
        F.sum("runs_batter").alias("runs"),
        F.count(F.lit(1)).alias("balls"),
        F.max("runs_batter").alias("highest"),
        count_if(F.col("is_wicket") == 1).alias("outs"),
    )
    of_match = Window.partitionBy("match_id").orderBy("batter", "season")
    of_batter = Window.partitionBy("match_id", "batter").orderBy("season")
    matched = F.col("match_id").isNotNull()  # balls of no match are none more
    firsts = per_match.withColumn("first_of_match", matched & (F.row_number().over(of_match) == 1))
    firsts = firsts.withColumn("first_of_batter", matched & (F.row_number().over(of_batter) == 1))
    sets = [[F.col("season"), F.col("batter")], [F.col("batter")], []]
    totals = firsts.groupingSets(sets, F.col("season"), F.col("batter")).agg(
        F.grouping_id().alias("set"),
        F.sum("runs").alias("total_runs"),
        F.sum("balls").alias("balls_faced"),
        F.count("match_id").alias("of_season"),
        count_if(F.col("first_of_batter")).alias("of_career"),
        count_if(F.col("first_of_match")).alias("of_all"),
        F.max("highest").alias("highest_score"),
        F.sum("outs").alias("times_out"),
    )
    n_matches = F.when(F.col("set") == 0, F.col("of_season")).when(F.col("set") == 2, F.col("of_career")).otherwise(F.col("of_all"))
    totals = totals.withColumn("matches_played", n_matches)
    level = F.when(F.col("set") == 0, F.lit(SEASON)).when(F.col("set") == 2, F.lit(CAREER)).otherwise(F.lit(ALL))
    return totals.filter(F.col("total_runs").isNotNull()).select(
        level.alias("level"), "season", "batter", "total_runs", "balls_faced", "matches_played", "highest_score", "times_out",
        percentage("total_runs", "balls_faced").alias("strike_rate"),
        F.when(F.col("times_out") > 0, F.round(ratio("total_runs", "times_out"), 2)).alias("average"),
    )


def compare_batters(batting: DataFrame, groups: int = 4) -> DataFrame:
    """The batting table with each batter's standing in the season: runs_rank
    (batters with as many runs share one), runs_percent_rank (0 best, 1 worst),
    runs_group (1 to ``groups``, as equal as can be; equal runs are ordered by fewer
    balls, then by name), strike_rank and runs_behind (to the season's best).

    Windows go over the batting table, a row per season and batter: a season's
    batters are few, however many balls it has."""
    season = Window.partitionBy("season")
    by_runs = season.orderBy(F.desc("total_runs"))
    return batting.select(
        "season", "batter", "total_runs", "strike_rate", "average",
        F.rank().over(by_runs).alias("runs_rank"),
        F.percent_rank().over(by_runs).alias("runs_percent_rank"),
        F.ntile(groups).over(season.orderBy(F.desc("total_runs"), "balls_faced", "batter")).alias("runs_group"),
        F.rank().over(season.orderBy(F.desc_nulls_last("strike_rate"))).alias("strike_rank"),
        (F.max("total_runs").over(season) - F.col("total_runs")).alias("runs_behind"),
    )

"""The SQL string path (S-8, S-9, F-6, A-6, A-7) over a team-titles relation.

The reference's smoke program builds a three-row literal (team, titles,
last_won), registers it as ``ipl_teams`` and runs a filter and a sum through
``spark.sql``.  Here the same relation is derived from the data: a team's
titles are the seasons in which it won a third of its matches or more (of the
given matches a third has no winner), ``last_won`` the latest of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# View name and statements.
TEAMS_VIEW = "ipl_teams"
SQL_FILTER = "SELECT team, titles FROM ipl_teams WHERE titles > 2"
SQL_SUM = "SELECT SUM(titles) AS total FROM ipl_teams"


def team_titles(team_stats: DataFrame) -> DataFrame:
    """(team, titles int, last_won int) from the team_stats table; a team
    without a title has 0 and no last_won."""
    won = F.col("matches_won") * 3 >= F.col("matches_played")
    return team_stats.groupBy("team").agg(
        F.sum(won.cast("int")).cast("int").alias("titles"),
        F.max(F.when(won, F.col("season").try_cast("int"))).alias("last_won"),
    )


def register_teams(titles: DataFrame) -> str:
    titles.createOrReplaceTempView(TEAMS_VIEW)
    return TEAMS_VIEW


def sql_filter(spark: SparkSession, titles: DataFrame) -> DataFrame:
    """F-6: projection and filter through ``spark.sql``."""
    register_teams(titles)
    return spark.sql(SQL_FILTER)


def sql_sum(spark: SparkSession, titles: DataFrame) -> DataFrame:
    """A-7: global sum through ``spark.sql``."""
    register_teams(titles)
    return spark.sql(SQL_SUM)

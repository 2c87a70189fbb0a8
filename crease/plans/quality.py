"""Data-quality checks gathered while a table is written.

Every rule is a count of the rows that break it.  The counts are metrics observed on
the rows as they pass into the file (``DataFrame.observe``), so nothing is scanned a
second time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crease.sources.sinks import write_parquet

ROWS = "rows"


def ball_rules() -> dict[str, Column]:
    """What a ball must not be, by name."""
    return {
        "venue missing": F.col("venue").isNull(),
        "date missing": F.col("match_date").isNull(),
        "runs do not add up": F.col("runs_total") != F.col("runs_batter") + F.col("runs_extras"),
        "runs out of range": ~F.col("runs_batter").between(0, 6),
        "batter bowls to himself": F.col("batter") == F.col("bowler"),
        "batter on both ends": F.col("batter") == F.col("non_striker"),
        "over out of range": ~F.col("over_number").between(0, 19),
        "wicket without details": (F.col("is_wicket") == 1) & (F.coalesce(F.col("wicket_details"), F.lit("")) == ""),
        "team does not play": ~F.array_contains("teams", F.col("batting_team")),
    }


def match_rules() -> dict[str, Column]:
    """What a match must not be, by name."""
    return {
        "venue unknown": F.col("venue") == "Unknown",
        "season unknown": F.col("season") == "Unknown",
        "not two teams": F.size("teams") != 2,
        "team against itself": F.element_at("teams", 1) == F.element_at("teams", -1),
        "winner does not play": F.col("winner").isNotNull() & ~F.array_contains("teams", F.col("winner")),
        "no result": F.col("winner").isNull(),
        "won by runs and wickets": F.col("win_by_runs").isNotNull() & F.col("win_by_wickets").isNotNull(),
    }


def write_checked(df: DataFrame, path: str, rules: Mapping[str, Column], partition_by: list[str] | None = None) -> dict[str, int]:
    """Write ``df`` to Parquet and return how many rows break each rule (a rule
    that is null for a row is not broken), and all rows as ``rows``."""
    observed = Observation()
    counts = [F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{k}") for k, broken in enumerate(rules.values())]
    write_parquet(df.observe(observed, F.count(F.lit(1)).alias(ROWS), *counts), path, partition_by)
    found = observed.get
    return {ROWS: found[ROWS], **{name: found[f"r{k}"] for k, name in enumerate(rules)}}


def report(df_of: Mapping[str, tuple[DataFrame, str, Mapping[str, Column]]]) -> DataFrame:
    """Write tables (name -> rows, path, rules) and report (table, rule, n_rows,
    n_broken), a row per rule."""
    rows, spark = [], None
    for table, (df, path, rules) in df_of.items():
        spark = df.sparkSession
        found = write_checked(df, path, rules)
        rows += [(table, rule, found[ROWS], found[rule]) for rule in rules]
    return spark.createDataFrame(rows, "table_name string, rule string, n_rows bigint, n_broken bigint")

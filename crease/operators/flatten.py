"""Flattening nested match documents (P-1 ... P-7, F-1, F-2).

Input: a documents DataFrame with ``match_id``, ``info`` and ``innings`` (as
produced by :func:`crease.sources.documents.read_match_documents` or any
DataFrame of the same shape).  Output: the matches table (one row per match)
and the ball-by-ball table (one row per delivery).

Every step is a projection or a generator, so flattening is narrow: balls stay
in the task that parsed their document and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.functions.core import first_element, or_default
from crease.functions.cricket import wicket_details, wicket_flag

# The defaults the reference gives missing fields.
UNKNOWN = "Unknown"
DEFAULT_DATE = "1900-01-01"
DEFAULT_MATCH_TYPE = "T20"

NESTED_MATCH_COLUMNS = ("players_registry", "innings_data")


def _match_id(docs: DataFrame):
    if "match_id" in docs.columns:
        return F.col("match_id")
    # documents that did not come through the reader: 128 bits of their content,
    # still assigned before any explode and stable under recomputation
    return F.md5(F.to_json(F.struct("info", "innings")))


def matches_table(docs: DataFrame, *, keep_nested: bool = True, with_load_time: bool = True) -> DataFrame:
    """P-1: one row per match with defaults for missing fields.

    season / venue default to "Unknown", match_type to "T20", the date to
    1900-01-01; an unparsable date becomes null instead of failing the job.
    """
    info = F.col("info")
    cols = [
        or_default(first_element(info["dates"]), DEFAULT_DATE).try_cast("date").alias("match_date"),
        or_default(info["venue"], UNKNOWN).alias("venue"),
        info["teams"].alias("teams"),
        or_default(info["season"], UNKNOWN).alias("season"),
        or_default(info["match_type"], DEFAULT_MATCH_TYPE).alias("match_type"),
        info["outcome"]["winner"].alias("winner"),
        info["outcome"]["by"]["runs"].alias("win_by_runs"),
        info["outcome"]["by"]["wickets"].alias("win_by_wickets"),
        info["toss"]["winner"].alias("toss_winner"),
        info["toss"]["decision"].alias("toss_decision"),
        info["player_of_match"].alias("player_of_match"),
    ]
    if keep_nested:
        cols += [info["registry"]["people"].alias("players_registry"), F.col("innings").alias("innings_data")]
    if with_load_time:
        cols.append(F.current_timestamp().alias("processed_at"))
    cols.append(_match_id(docs).alias("match_id"))
    return docs.select(*cols)


def for_sink(matches: DataFrame) -> DataFrame:
    """S-11: drop the nested carry-over columns before a flat sink."""
    return matches.drop(*NESTED_MATCH_COLUMNS)


def flatten_match_documents(docs: DataFrame) -> DataFrame:
    """P-2: innings -> overs -> deliveries, one row per delivery.

    Empty or null levels drop out (the generators skip them, F-1).  The
    positions from ``posexplode`` (innings, over, ball) locate a ball inside
    its match.
    """
    info = F.col("info")
    keep = ["match_id", "season", "teams", "venue", "match_date"]
    level0 = docs.select(
        _match_id(docs).alias("match_id"),
        or_default(info["season"], UNKNOWN).alias("season"),
        info["teams"].alias("teams"),
        info["venue"].alias("venue"),
        first_element(info["dates"]).try_cast("date").alias("match_date"),
        F.posexplode("innings").alias("innings_pos", "inn"),
    )
    level1 = level0.select(
        *keep,
        "innings_pos",
        F.col("inn.team").alias("batting_team"),
        F.posexplode("inn.overs").alias("over_pos", "ov"),
    )
    return level1.select(
        *keep,
        "innings_pos",
        "batting_team",
        "over_pos",
        F.col("ov.over").alias("over_number"),
        F.posexplode("ov.deliveries").alias("ball_pos", "delivery"),
    )


def balls_by_ball(docs: DataFrame, *, with_load_time: bool = True) -> DataFrame:
    """P-2 ... P-6, F-2: the ball-by-ball fact table.

    batter / bowler / non-striker default to "Unknown" and runs to 0; rows with
    an unknown season, batter or bowler are dropped.

    ``ball_id`` is the match id and the ball's place in it (innings, over, ball):
    the same on every load, retry and split layout, and as distinct as match ids.
    """
    flat = flatten_match_documents(docs)
    d = F.col("delivery")
    cols = [
        "match_id",
        "season",
        "teams",
        "venue",
        "match_date",
        "batting_team",
        "over_number",
        or_default(d["batter"], UNKNOWN).alias("batter"),
        or_default(d["bowler"], UNKNOWN).alias("bowler"),
        or_default(d["non_striker"], UNKNOWN).alias("non_striker"),
        or_default(d["runs"]["batter"], 0).alias("runs_batter"),
        or_default(d["runs"]["extras"], 0).alias("runs_extras"),
        or_default(d["runs"]["total"], 0).alias("runs_total"),
        wicket_flag(d["wickets"]).alias("is_wicket"),
        wicket_details(d["wickets"]).alias("wicket_details"),
    ]
    if with_load_time:
        cols.append(F.current_timestamp().alias("processed_at"))
    place = F.concat(F.col("match_id").cast("string"), F.lit(":"), F.concat_ws(".", *[F.col(c).cast("string") for c in ("innings_pos", "over_pos", "ball_pos")]))
    out = flat.select(*cols, place.alias("ball_id"))
    return out.filter((F.col("season") != UNKNOWN) & (F.col("batter") != UNKNOWN) & (F.col("bowler") != UNKNOWN))

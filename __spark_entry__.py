"""

``entry(spark)`` runs the flagship query (team_stats) on sf0.001;
``queries()`` maps every implemented operator to a (spark, sf_dir) callable;
``oracle_sql()`` gives, for each key, DuckDB SQL over the same parquet tables
that must return the same rows (order-insensitive, same column names).

Rounding: Spark's ``round(double, n)`` rounds half-up on the decimal text of
the value; DuckDB rounds the binary value.  The oracle therefore rounds
through text and DECIMAL (``_r`` below) so ties such as 33.425 agree.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# the package lives next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    from crease.plans.queries import q_team_stats

    return q_team_stats(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from crease.plans.queries import QUERIES

    return {**QUERIES, **_training_data("QUERIES")}


def _training_data(name: str) -> dict:
    """QUERIES or ORACLE_SQL of the training-data subpackage, none if it is not there."""
    try:
        module = importlib.import_module("crease.llm.queries")
    except ModuleNotFoundError as e:
        if not (e.name or "").startswith("crease.llm"):
            raise
        return {}
    return dict(getattr(module, name))


# --- oracle SQL --------------------------------------------------------------------


def _r(x: str, n: int) -> str:
    """Spark-compatible round(double, n): half-up on the decimal text."""
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def _dec(x: str, p: int, s: int) -> str:
    """Spark-compatible try_cast(double AS DECIMAL(p,s))."""
    return f"TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL({p},{s}))"


_M = """
m AS (
  SELECT o_orderkey AS match_id,
         CAST(year(o_orderdate) AS VARCHAR) AS season,
         CAST(o_orderdate AS DATE) AS match_date,
         'V' || CAST(o_custkey AS VARCHAR) AS venue,
         'T' || CAST(o_custkey % 10 AS VARCHAR) AS team1,
         'T' || CAST((o_custkey + 1 + o_orderkey % 9) % 10 AS VARCHAR) AS team2,
         o_orderstatus, o_orderkey, o_custkey, o_totalprice, o_orderpriority
  FROM orders
),
mt AS (
  SELECT match_date, venue, [team1, team2] AS teams, season, 'T20' AS match_type,
         CASE o_orderstatus WHEN 'F' THEN team1 WHEN 'O' THEN team2 END AS winner,
         CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) % 100 + 1 END AS win_by_runs,
         CASE WHEN o_orderstatus = 'O' THEN o_custkey % 10 + 1 END AS win_by_wickets,
         CASE WHEN o_orderkey % 2 = 0 THEN team1 ELSE team2 END AS toss_winner,
         CASE WHEN o_orderkey % 3 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN ['B' || CAST(o_orderkey % 200 AS VARCHAR)] ELSE CAST([] AS VARCHAR[]) END AS player_of_match,
         match_id
  FROM m
)"""

_B = _M + """,
d AS (
  SELECT l_orderkey AS match_id,
         l_linestatus = 'O' AS t1bat,
         CAST(l_linenumber - 1 AS BIGINT) AS over_number,
         'B' || CAST(l_partkey % 200 AS VARCHAR) AS batter,
         'W' || CAST(l_suppkey % 120 AS VARCHAR) AS bowler,
         'B' || CAST((l_partkey + 100) % 200 AS VARCHAR) AS non_striker,
         CAST(l_quantity AS BIGINT) % 7 AS runs_batter,
         CAST(CASE WHEN l_returnflag = 'N' AND l_tax >= 0.06 THEN 1 ELSE 0 END AS BIGINT) AS runs_extras,
         l_returnflag = 'R' AND l_discount >= 0.08 AS wk,
         l_discount >= 0.1 AS wk2,
         CASE WHEN l_tax >= 0.04 THEN 'caught' WHEN l_tax > 0 THEN 'bowled' END AS kind
  FROM lineitem
),
b AS (
  SELECT d.match_id, m.season, [m.team1, m.team2] AS teams, m.venue, m.match_date,
         CASE WHEN t1bat THEN m.team1 ELSE m.team2 END AS batting_team,
         over_number, batter, bowler, non_striker, runs_batter, runs_extras,
         runs_batter + runs_extras AS runs_total,
         CASE WHEN wk THEN 1 ELSE 0 END AS is_wicket,
         CASE WHEN wk THEN concat_ws(', ', batter || ' - ' || kind,
                                      CASE WHEN wk2 THEN non_striker || ' - run out' END) END AS wicket_details
  FROM d JOIN m ON d.match_id = m.match_id
)"""

_BALL_COLS = (
    "season, teams, venue, match_date, batting_team, over_number, batter, bowler, non_striker, "
    "runs_batter, runs_extras, runs_total, is_wicket, wicket_details"
)
_MATCH_COLS = (
    "match_date, venue, teams, season, match_type, winner, win_by_runs, win_by_wickets, "
    "toss_winner, toss_decision, player_of_match"
)

_TEAM = f"""WITH {_M},
tm AS (SELECT season, match_id, winner, toss_winner, unnest(teams) AS team FROM mt),
ag AS (
  SELECT season, team, COUNT(DISTINCT match_id) AS matches_played,
         CAST(SUM(CASE WHEN winner = team THEN 1 ELSE 0 END) AS BIGINT) AS matches_won,
         CAST(SUM(CASE WHEN toss_winner = team THEN 1 ELSE 0 END) AS BIGINT) AS tosses_won
  FROM tm GROUP BY season, team
),
ts AS (
  SELECT *, {_r("(CAST(matches_won AS DOUBLE) / matches_played) * 100", 2)} AS win_percentage,
            {_r("(CAST(tosses_won AS DOUBLE) / matches_played) * 100", 2)} AS toss_win_percentage
  FROM ag
)"""

_BAT = f"""WITH {_B},
ag AS (
  SELECT season, batter, CAST(SUM(runs_batter) AS BIGINT) AS total_runs, COUNT(*) AS balls_faced,
         COUNT(DISTINCT match_id) AS matches_played, MAX(runs_batter) AS highest_score,
         CAST(SUM(CASE WHEN runs_batter = 4 THEN 1 ELSE 0 END) AS BIGINT) AS fours,
         CAST(SUM(CASE WHEN runs_batter = 6 THEN 1 ELSE 0 END) AS BIGINT) AS sixes,
         CAST(SUM(CASE WHEN is_wicket = 1 THEN 1 ELSE 0 END) AS BIGINT) AS times_out
  FROM b GROUP BY season, batter HAVING COUNT(*) >= 50
),
bat AS (
  SELECT *, {_r("(CAST(total_runs AS DOUBLE) / balls_faced) * 100", 2)} AS strike_rate,
         CASE WHEN times_out > 0 THEN {_r("CAST(total_runs AS DOUBLE) / times_out", 2)} END AS average,
         {_r("(CAST(fours + sixes AS DOUBLE) / balls_faced) * 100", 2)} AS boundary_percentage
  FROM ag
)"""

_BOWL = f"""WITH {_B},
ag AS (
  SELECT season, bowler, COUNT(*) AS balls_bowled, CAST(SUM(runs_total) AS BIGINT) AS runs_conceded,
         COUNT(DISTINCT match_id) AS matches_played, CAST(SUM(is_wicket) AS BIGINT) AS wickets_taken,
         CAST(SUM(CASE WHEN runs_total = 0 THEN 1 ELSE 0 END) AS BIGINT) AS dot_balls
  FROM b GROUP BY season, bowler HAVING COUNT(*) >= 60
),
ov AS (SELECT *, {_r("CAST(balls_bowled AS DOUBLE) / 6", 1)} AS overs_bowled FROM ag),
bowl AS (
  SELECT *, {_r("CAST(runs_conceded AS DOUBLE) / overs_bowled", 2)} AS economy_rate,
         CASE WHEN wickets_taken > 0 THEN {_r("CAST(runs_conceded AS DOUBLE) / wickets_taken", 2)} END AS bowling_average,
         {_r("(CAST(dot_balls AS DOUBLE) / balls_bowled) * 100", 2)} AS dot_ball_percentage
  FROM ov
)"""

_SEASON = f"""WITH {_B},
ag AS (
  SELECT season, AVG(runs_total) AS avg_runs_per_ball, CAST(SUM(runs_total) AS BIGINT) AS total_runs,
         COUNT(*) AS total_balls, COUNT(DISTINCT match_id) AS total_matches, AVG(is_wicket) AS wicket_rate
  FROM b GROUP BY season
),
st AS (
  SELECT *, {_r("CAST(total_runs AS DOUBLE) / total_matches", 2)} AS avg_runs_per_match,
         {_r("avg_runs_per_ball * 6", 2)} AS avg_runs_per_over
  FROM ag
)"""

_VENUE = f"""WITH {_B},
ag AS (
  SELECT venue, COUNT(DISTINCT match_id) AS matches_played, AVG(runs_total) AS avg_runs_per_ball, COUNT(*) AS total_balls
  FROM b GROUP BY venue HAVING COUNT(DISTINCT match_id) >= 10
),
vs AS (SELECT *, {_r("avg_runs_per_ball * 6", 2)} AS avg_runs_per_over FROM ag)"""

_TITLES = f"""{_TEAM},
titles AS (
  SELECT team, CAST(COUNT(*) FILTER (matches_won * 3 >= matches_played) AS INTEGER) AS titles,
         MAX(TRY_CAST(season AS INTEGER)) FILTER (matches_won * 3 >= matches_played) AS last_won
  FROM ts GROUP BY team
)"""

_LIVE = """WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
snap AS (
  SELECT ts AS fetched_at, event_id AS seq, 0 AS pos,
         'm' || CAST(user_id AS VARCHAR) AS match_id,
         CASE WHEN event_id % 211 = 0 THEN NULL
              WHEN event_type = 'purchase' THEN
                (CASE WHEN k % 2 = 0 THEN 'Reds' ELSE 'Blues' END) || ' won by ' || CAST(k AS VARCHAR) || ' ' ||
                (CASE WHEN k % 3 = 0 THEN 'Wickets' ELSE 'runs' END)
              WHEN event_type = 'view' THEN 'Match in Progress'
              WHEN event_type = 'click' THEN 'Innings Break'
              WHEN event_type = 'signup' THEN 'Match starts at 7:30 PM'
              WHEN event_type = 'error' THEN 'No result' END AS status,
         COALESCE(CASE WHEN user_id % 4 <> 0 THEN 'Ground ' || CAST(user_id % 9 AS VARCHAR) END, 'Unknown') AS venue,
         'City' || CAST(user_id % 7 AS VARCHAR) || ' Reds' AS team1,
         CASE WHEN event_id % 101 <> 0 THEN 'Port' || CAST(event_id % 5 AS VARCHAR) || ' Blues' END AS team2,
         CASE WHEN event_type IN ('view', 'purchase') THEN 2 WHEN event_type = 'click' THEN 1
              WHEN event_type = 'error' THEN 0 END AS n_score,
         CASE WHEN event_type = 'click' OR k % 9 <> 0 THEN
                (CASE WHEN event_id % 103 = 0 THEN 2147483647 ELSE CAST(floor(value) AS INTEGER) END) END AS r1,
         event_id % 97 = 0 AS r1_unreadable,
         event_id % 199 = 0 AS w1_unreadable,
         event_id % 197 = 0 OR event_id % 193 = 0 AS o2_unreadable,
         k % 10 AS w1,
         CAST(20.0 AS DOUBLE) AS o1,
         CASE WHEN event_id % 113 = 0 THEN -2147483648 ELSE CAST(floor(value / 2) AS INTEGER) END AS r2,
         CASE WHEN k % 4 <> 0 THEN k % 7 END AS w2,
         CAST(k % 25 AS DOUBLE) + 0.5 AS o2
  FROM ev
),
checked AS (
  SELECT *, CASE WHEN match_id IS NULL THEN 'missing id' WHEN status IS NULL THEN 'missing status'
                 WHEN team1 IS NULL THEN 'missing team 1' WHEN team2 IS NULL THEN 'missing team 2'
                 WHEN n_score >= 1 AND (r1_unreadable AND r1 IS NOT NULL OR w1_unreadable) THEN 'unreadable score'
                 WHEN n_score >= 2 AND o2_unreadable THEN 'unreadable score' END AS problem
  FROM snap
),
flags AS (
  SELECT *, lower(status) AS ls,
         (contains(lower(status), 'live') OR contains(lower(status), 'in progress') OR contains(lower(status), 'innings break')
          OR contains(lower(status), 'batting') OR contains(lower(status), 'bowling')) AS is_ongoing,
         (contains(lower(status), 'won') OR contains(lower(status), 'complete') OR contains(lower(status), 'finished')
          OR contains(lower(status), 'result')) AS is_completed,
         string_split(rtrim(lower(team1), ' '), ' ')[-1] AS last1,
         string_split(rtrim(lower(team2), ' '), ' ')[-1] AS last2
  FROM checked WHERE problem IS NULL
),
rows AS (
  SELECT fetched_at, seq, pos, match_id, team1, team2,
         CASE WHEN n_score IS NULL OR n_score = 0 THEN 'Not started'
              WHEN r1 IS NOT NULL AND w1 IS NOT NULL AND o1 IS NOT NULL
                THEN CAST(r1 AS VARCHAR) || '/' || CAST(w1 AS VARCHAR) || ' (' || CAST(o1 AS VARCHAR) || ' ov)'
              ELSE '0/0 (0.0)' END AS team1_score,
         CASE WHEN n_score >= 2 THEN
                (CASE WHEN r2 IS NOT NULL AND w2 IS NOT NULL AND o2 IS NOT NULL
                      THEN CAST(r2 AS VARCHAR) || '/' || CAST(w2 AS VARCHAR) || ' (' || CAST(o2 AS VARCHAR) || ' ov)'
                      ELSE '0/0 (0.0)' END)
              WHEN n_score = 1 THEN 'Yet to bat' ELSE 'Not started' END AS team2_score,
         status, is_ongoing, is_completed, venue,
         CASE WHEN n_score >= 2 THEN o2 WHEN n_score = 1 THEN o1 ELSE CAST(0.0 AS DOUBLE) END AS current_over,
         CASE WHEN n_score >= 2 AND r1 IS NOT NULL THEN CAST(r1 AS BIGINT) + 1 ELSE 0 END AS target,
         CASE WHEN n_score >= 2 AND r1 IS NOT NULL THEN
                (CASE WHEN 20.0 - o2 > 0 THEN CAST((CAST(r1 AS BIGINT) + 1) - COALESCE(r2, 0) AS DOUBLE) / (20.0 - o2) ELSE CAST(0.0 AS DOUBLE) END)
              ELSE CAST(0.0 AS DOUBLE) END AS required_rate,
         CASE WHEN NOT is_completed THEN ''
              WHEN contains(ls, 'won') AND contains(ls, last1) THEN team1
              WHEN contains(ls, 'won') AND contains(ls, last2) THEN team2
              ELSE '' END AS winner,
         CASE WHEN NOT is_completed THEN ''
              WHEN contains(ls, 'won') AND (contains(ls, last1) OR contains(ls, last2)) THEN
                COALESCE(NULLIF(regexp_extract(ls, '(\\d+)\\s+runs?', 0), ''),
                         NULLIF(regexp_extract(ls, '(\\d+)\\s+wickets?', 0), ''),
                         NULLIF(regexp_extract(ls, '(\\d+)\\s+balls?', 0), ''),
                         status)
              ELSE status END AS result_margin,
         CASE WHEN is_ongoing THEN 'LIVE' WHEN is_completed THEN 'COMPLETED' ELSE 'UPCOMING' END AS state
  FROM flags
),
storable AS (
  SELECT *,
         CASE WHEN length(match_id) > 100 THEN 'match_id longer than 100'
              WHEN length(team1) > 100 THEN 'team1 longer than 100'
              WHEN length(team2) > 100 THEN 'team2 longer than 100'
              WHEN length(team1_score) > 200 THEN 'team1_score longer than 200'
              WHEN length(team2_score) > 200 THEN 'team2_score longer than 200'
              WHEN length(status) > 200 THEN 'status longer than 200'
              WHEN length(venue) > 200 THEN 'venue longer than 200'
              WHEN length(winner) > 100 THEN 'winner longer than 100'
              WHEN length(result_margin) > 100 THEN 'result_margin longer than 100'
              WHEN """ + _dec("current_over", 4, 1) + """ IS NULL THEN 'current_over overflow'
              WHEN target > 2147483647 THEN 'target overflow'
              WHEN """ + _dec("required_rate", 4, 2) + """ IS NULL THEN 'required_rate overflow' END AS store_problem
  FROM rows
),
state AS (
  SELECT *,
         row_number() OVER (PARTITION BY match_id ORDER BY fetched_at, seq, pos) AS rn_first,
         row_number() OVER (PARTITION BY match_id ORDER BY fetched_at DESC, seq DESC, pos DESC) AS rn_last
  FROM storable WHERE store_problem IS NULL
),
current AS (
  SELECT l.match_id, f.team1, f.team2, l.team1_score, l.team2_score, l.status, l.is_ongoing, l.is_completed,
         f.venue, CAST(""" + _dec("l.current_over", 4, 1) + """ AS DOUBLE) AS current_over, CAST(l.target AS INTEGER) AS target,
         CAST(""" + _dec("l.required_rate", 4, 2) + """ AS DOUBLE) AS required_rate, l.winner, l.result_margin,
         l.fetched_at AS updated_at, CAST(NULL AS VARCHAR) AS date_time, CAST(NULL AS VARCHAR) AS toss_winner,
         CAST(NULL AS INTEGER) AS balls_remaining
  FROM state l JOIN state f ON l.match_id = f.match_id AND l.rn_last = 1 AND f.rn_first = 1
)"""

_LIVE_REPORT = f"""{_LIVE}
SELECT match_id, team1 || ' vs ' || team2 AS fixture,
       venue, team1_score, team2_score, status,
       CASE WHEN is_ongoing THEN 'LIVE' WHEN is_completed THEN 'COMPLETED' ELSE 'UPCOMING' END AS state,
       CASE WHEN is_ongoing AND current_over > 0 THEN current_over END AS live_over,
       CASE WHEN is_ongoing AND current_over > 0 AND target > 0 THEN target END AS live_target,
       CASE WHEN is_ongoing AND current_over > 0 AND required_rate > 0 THEN required_rate END AS live_rate,
       CASE WHEN is_completed AND winner <> '' THEN winner END AS winner,
       CASE WHEN is_completed AND winner <> '' THEN result_margin END AS result_margin
FROM current"""



def _live_cache(as_of: str) -> str:
    return f"""{_LIVE},
seen AS (SELECT * FROM rows WHERE fetched_at <= {as_of}),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY fetched_at DESC, seq DESC, pos DESC) AS rn FROM seen
)
SELECT 'live:' || match_id AS cache_key,
       CAST(to_json(struct_pack(teams := team1 || ' vs ' || team2, score1 := team1_score,
                                score2 := team2_score, status := status)) AS VARCHAR) AS payload,
       fetched_at AS written_at, fetched_at + INTERVAL 600 SECOND AS expires_at
FROM latest
WHERE rn = 1 AND fetched_at > {as_of} - INTERVAL 600 SECOND"""


_LIVE_CACHE = _live_cache("(SELECT MAX(fetched_at) FROM rows)")

_PAYLOAD = """CAST(to_json(struct_pack(teams := team1 || ' vs ' || team2, score1 := team1_score,
                                score2 := team2_score, status := status)) AS VARCHAR)"""

_CACHE_HISTORY = f"""{_LIVE},
asked(as_of) AS (VALUES (TIMESTAMP '2024-01-05 06:00:00'), (TIMESTAMP '2024-01-15 12:00:00'), (TIMESTAMP '2024-01-25 18:30:00')),
alive AS (
  SELECT *, row_number() OVER (PARTITION BY as_of, match_id ORDER BY fetched_at DESC, seq DESC, pos DESC) AS rn
  FROM rows JOIN asked ON fetched_at <= as_of AND fetched_at > as_of - INTERVAL 600 SECOND
)
SELECT as_of, 'live:' || match_id AS cache_key, {_PAYLOAD} AS payload,
       fetched_at AS written_at, fetched_at + INTERVAL 600 SECOND AS expires_at
FROM alive WHERE rn = 1"""

_CACHE_INTERVALS = f"""{_LIVE},
following AS (
  SELECT *, lead(fetched_at) OVER (PARTITION BY match_id ORDER BY fetched_at, seq, pos) AS next_at FROM rows
),
valid AS (
  SELECT 'live:' || match_id AS cache_key, {_PAYLOAD} AS payload, fetched_at AS valid_from,
         least(fetched_at + INTERVAL 600 SECOND, COALESCE(next_at, fetched_at + INTERVAL 600 SECOND)) AS valid_to
  FROM following
)
SELECT * FROM valid WHERE valid_from < valid_to"""

_CACHE_SESSIONS = f"""{_LIVE},
gaps AS (
  SELECT *, CASE WHEN fetched_at < lag(fetched_at) OVER w + INTERVAL 600 SECOND THEN 0 ELSE 1 END AS begins
  FROM rows WINDOW w AS (PARTITION BY match_id ORDER BY fetched_at, seq, pos)
),
lives AS (SELECT *, SUM(begins) OVER (PARTITION BY match_id ORDER BY fetched_at, seq, pos) AS life FROM gaps),
closed AS (
  SELECT match_id, life, MIN(fetched_at) AS opened_at, MAX(fetched_at) AS last_written_at, COUNT(*) AS n_writes,
         arg_max({_PAYLOAD}, (fetched_at, seq, pos)) AS payload
  FROM lives GROUP BY match_id, life
)
SELECT 'live:' || match_id AS cache_key, opened_at, last_written_at, last_written_at + INTERVAL 600 SECOND AS expired_at, n_writes, payload
FROM closed WHERE last_written_at + INTERVAL 600 SECOND <= (SELECT MAX(fetched_at) FROM rows) - INTERVAL 600 SECOND"""
_LIVE_QUARANTINE = f"""{_LIVE}
SELECT seq, match_id, problem AS reason FROM checked WHERE problem IS NOT NULL
UNION ALL
SELECT seq, match_id, store_problem AS reason FROM storable WHERE store_problem IS NOT NULL"""


def _pipeline_stats(twice: int | None = None) -> str:
    """One figure per group of the five statistics; ``twice``: documents whose key
    it divides were loaded twice, as two matches."""

    def repeated(ctes: str) -> str:
        if twice is None:
            return ctes
        ctes = ctes.replace("m AS (\n  SELECT o_orderkey AS match_id,", "m AS (\n  SELECT o_orderkey * 2 + copy AS match_id,", 1)
        ctes = ctes.replace("o_totalprice, o_orderpriority\n  FROM orders", f"o_totalprice, o_orderpriority\n  FROM orders, range(2) c(copy) WHERE copy = 0 OR o_orderkey % {twice} = 0", 1)
        ctes = ctes.replace("SELECT l_orderkey AS match_id,", "SELECT l_orderkey * 2 + copy AS match_id,", 1)
        return ctes.replace("FROM lineitem\n", "FROM lineitem, range(2) c(copy)\n", 1)

    figures = [
        ("team_stats", _TEAM, "ts", "season", "team", "matches_won"),
        ("player_batting_stats", _BAT, "bat", "season", "batter", "total_runs"),
        ("player_bowling_stats", _BOWL, "bowl", "season", "bowler", "runs_conceded"),
        ("season_trends", _SEASON, "st", "season", "NULL", "total_runs"),
        ("venue_stats", _VENUE, "vs", "NULL", "venue", "total_balls"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS statistic, CAST({season} AS VARCHAR) AS season, CAST({of} AS VARCHAR) AS \"of\", "
        f"CAST({figure} AS BIGINT) AS figure FROM ({repeated(ctes)} SELECT * FROM {table})"
        for name, ctes, table, season, of, figure in figures
    )


_CAREER = f"""WITH {_B},
ag AS (
  SELECT CASE WHEN GROUPING(season) = 0 THEN 'season' WHEN GROUPING(batter) = 0 THEN 'career' ELSE 'all players' END AS level,
         season, batter, CAST(SUM(runs_batter) AS BIGINT) AS total_runs, COUNT(*) AS balls_faced,
         COUNT(DISTINCT match_id) AS matches_played, MAX(runs_batter) AS highest_score, CAST(SUM(is_wicket) AS BIGINT) AS times_out
  FROM b GROUP BY GROUPING SETS ((season, batter), (batter), ())
)
SELECT *, {_r("(CAST(total_runs AS DOUBLE) / balls_faced) * 100", 2)} AS strike_rate,
       CASE WHEN times_out > 0 THEN {_r("CAST(total_runs AS DOUBLE) / times_out", 2)} END AS average
FROM ag"""

_COMPARISON = f"""{_BAT}
SELECT season, batter, total_runs, strike_rate, average,
       CAST(rank() OVER runs AS INTEGER) AS runs_rank, percent_rank() OVER runs AS runs_percent_rank,
       CAST(ntile(4) OVER (PARTITION BY season ORDER BY total_runs DESC, balls_faced, batter) AS INTEGER) AS runs_group,
       CAST(rank() OVER (PARTITION BY season ORDER BY strike_rate DESC NULLS LAST) AS INTEGER) AS strike_rank,
       MAX(total_runs) OVER (PARTITION BY season) - total_runs AS runs_behind
FROM bat WINDOW runs AS (PARTITION BY season ORDER BY total_runs DESC)"""


def _quality() -> str:
    balls = {
        "venue missing": "venue IS NULL",
        "date missing": "match_date IS NULL",
        "runs do not add up": "runs_total <> runs_batter + runs_extras",
        "runs out of range": "NOT runs_batter BETWEEN 0 AND 6",
        "batter bowls to himself": "batter = bowler",
        "batter on both ends": "batter = non_striker",
        "over out of range": "NOT over_number BETWEEN 0 AND 19",
        "wicket without details": "is_wicket = 1 AND COALESCE(wicket_details, '') = ''",
        "team does not play": "NOT list_contains(teams, batting_team)",
    }
    matches = {
        "venue unknown": "venue = 'Unknown'",
        "season unknown": "season = 'Unknown'",
        "not two teams": "len(teams) <> 2",
        "team against itself": "teams[1] = teams[-1]",
        "winner does not play": "winner IS NOT NULL AND NOT list_contains(teams, winner)",
        "no result": "winner IS NULL",
        "won by runs and wickets": "win_by_runs IS NOT NULL AND win_by_wickets IS NOT NULL",
    }
    parts = [
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, COUNT(*) AS n_rows, COUNT(*) FILTER ({broken}) AS n_broken FROM {rows}"
        for table, rows, rules in (("matches", "mt", matches), ("balls_by_ball", "b", balls))
        for rule, broken in rules.items()
    ]
    return f"WITH {_B} " + " UNION ALL ".join(parts)


_OVERS = f"""WITH {_B}
SELECT season, match_id, batting_team, over_number, COUNT(*) AS balls, CAST(SUM(runs_total) AS BIGINT) AS runs,
       CAST(SUM(is_wicket) AS BIGINT) AS wickets
FROM b GROUP BY season, match_id, batting_team, over_number"""


_DRIFT = """WITH found AS (
  SELECT 'meta' AS level, 'revision' AS field, 'long' AS declared, 'string' AS found, COUNT(*) AS n_values
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT 'innings.overs', 'over', 'long', 'string', COUNT(*)
  FROM (SELECT DISTINCT l_orderkey, l_linestatus = 'O', l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')
  UNION ALL
  SELECT 'info', 'umpire', NULL, 'object', COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM'
  UNION ALL
  SELECT 'info', 'outcome', 'struct', 'array', COUNT(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
)
SELECT * FROM found WHERE n_values > 0"""


def oracle_sql() -> dict[str, str]:
    matches = f"WITH {_M} SELECT {_MATCH_COLS}, match_id FROM mt"
    balls = f"WITH {_B} SELECT match_id, {_BALL_COLS} FROM b"
    return {
        "matches": matches,
        "balls_by_ball": balls,
        "wicket_details": f"WITH {_B} SELECT match_id, batting_team, over_number, batter, bowler, wicket_details FROM b WHERE is_wicket = 1",
        "nested_flatten": f"WITH {_B} SELECT {_BALL_COLS} FROM b",
        "json_scan": f"WITH {_M} SELECT {_MATCH_COLS} FROM mt",
        "corrupt_quarantine": (
            "SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN 'quarantined' ELSE 'valid' END "
            "AS record_state, COUNT(*) AS n_documents, "
            "COUNT(CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')) THEN 1 END) AS n_with_season "
            "FROM orders GROUP BY 1"
        ),
        "id_uniqueness": (
            "WITH o AS (SELECT o_orderkey AS k, 1 + CAST(o_orderkey % 50 = 0 AS BIGINT) AS times FROM orders), "
            "n AS (SELECT 'match' AS level, SUM(times) AS n FROM o "
            "UNION ALL SELECT 'ball', SUM(times) FROM lineitem JOIN o ON l_orderkey = k) "
            "SELECT level, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS n_ids, CAST(n AS BIGINT) AS n_shared FROM n"
        ),
        "incremental_load": f"""WITH {_B},
times AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE match_id % 50 = 0)
SELECT season, COUNT(*) AS n_balls, COUNT(*) AS n_ids,
       COUNT(DISTINCT match_id) + COUNT(DISTINCT CASE WHEN match_id % 50 = 0 THEN match_id END) AS n_matches,
       CAST(SUM(runs_total) AS BIGINT) AS runs
FROM times GROUP BY season""",
        "incremental_stats": _pipeline_stats(50),
        "schema_drift": _DRIFT,
        "pipeline_stats": _pipeline_stats(),
        "parquet_round_trip": balls,
        "team_stats": f"{_TEAM} SELECT * FROM ts",
        "player_batting_stats": f"{_BAT} SELECT * FROM bat",
        "player_bowling_stats": f"{_BOWL} SELECT * FROM bowl",
        "season_trends": f"{_SEASON} SELECT * FROM st",
        "venue_stats": f"{_VENUE} SELECT * FROM vs",
        "team_stats_sorted": f"{_TEAM} SELECT * FROM ts ORDER BY season, win_percentage DESC, team",
        "player_batting_sorted": f"{_BAT} SELECT * FROM bat ORDER BY season, total_runs DESC, batter",
        "player_bowling_sorted": f"{_BOWL} SELECT * FROM bowl ORDER BY season, economy_rate, bowler",
        "season_trends_sorted": f"{_SEASON} SELECT * FROM st ORDER BY season",
        "venue_stats_sorted": f"{_VENUE} SELECT * FROM vs ORDER BY avg_runs_per_over DESC, venue NULLS FIRST",
        "top_run_scorers": f"{_BAT} SELECT batter, total_runs, strike_rate, average FROM bat "
        "ORDER BY total_runs DESC, season, batter LIMIT 10",
        "top_bowlers": f"{_BOWL} SELECT bowler, wickets_taken, economy_rate, bowling_average FROM bowl "
        "ORDER BY economy_rate, season, bowler LIMIT 10",
        "team_performance": f"{_TEAM} SELECT * FROM ts ORDER BY win_percentage DESC, season, team LIMIT 10",
        "season_listing": f"{_SEASON} SELECT * FROM st ORDER BY season",
        "top_venues": f"{_VENUE} SELECT * FROM vs ORDER BY avg_runs_per_over DESC, venue NULLS FIRST LIMIT 10",
        "sql_reports_team": f"{_TEAM} SELECT * FROM ts ORDER BY win_percentage DESC, season, team LIMIT 10",
        "sql_reports_batting": f"{_BAT} SELECT * FROM bat ORDER BY total_runs DESC, season, batter LIMIT 10",
        "sql_reports_seasons": f"{_SEASON} SELECT * FROM st",
        "career_batting": _CAREER,
        "player_comparison": _COMPARISON,
        "quality_checks": _quality(),
        "team_titles": f"{_TITLES} SELECT * FROM titles",
        "sql_filter": f"{_TITLES} SELECT team, titles FROM titles WHERE titles > 2",
        "global_sum": f"{_TITLES} SELECT CAST(SUM(titles) AS BIGINT) AS sum_titles FROM titles",
        "sql_sum": f"{_TITLES} SELECT CAST(SUM(titles) AS BIGINT) AS total FROM titles",
        "live_flags": f"{_LIVE} SELECT seq, match_id, status, is_ongoing, is_completed, state FROM rows",
        "live_scores": f"{_LIVE} SELECT seq, match_id, venue, team1_score, team2_score, current_over FROM rows",
        "live_chase": f"{_LIVE} SELECT seq, match_id, target, required_rate FROM rows",
        "live_result": f"{_LIVE} SELECT seq, match_id, team1, team2, winner, result_margin FROM rows",
        "live_matches": f"{_LIVE} SELECT * FROM current",
        "live_report": _LIVE_REPORT,
        "live_cache": _LIVE_CACHE,
        "live_cache_as_of": _live_cache("TIMESTAMP '2024-01-15 12:00:00'"),
        "live_quarantine": _LIVE_QUARANTINE,
        "live_quarantine_stream": _LIVE_QUARANTINE,
        "live_quarantine_replay": _LIVE_QUARANTINE,
        "live_matches_stream": f"{_LIVE} SELECT * FROM current",
        "live_cache_stream": _LIVE_CACHE,
        "live_overs_stream": _OVERS,
        "live_cache_history": _CACHE_HISTORY,
        "live_cache_intervals": _CACHE_INTERVALS,
        "live_cache_sessions": _CACHE_SESSIONS,
        **_training_data("ORACLE_SQL"),
    }

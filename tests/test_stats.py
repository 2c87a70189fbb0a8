"""Statistics formulas, HAVING cuts at their exact thresholds, null averages,
rounding, and deterministic top-k tie-breaks -- on hand-built ball tables."""

from __future__ import annotations

import pytest

from crease.operators import reports, stats

BALL_COLS = "match_id long, season string, venue string, batter string, bowler string, runs_batter long, runs_total long, is_wicket int"


def _balls(spark, rows):
    return spark.createDataFrame(rows, BALL_COLS)


def _many(match_id, season, venue, batter, bowler, n, runs=1, wickets=0):
    out = []
    for i in range(n):
        out.append((match_id, season, venue, batter, bowler, runs, runs, 1 if i < wickets else 0))
    return out


def test_batting_threshold_and_null_average(spark):
    rows = _many(1, "2020", "V", "AT50", "W", 50, runs=4) + _many(1, "2020", "V", "AT49", "W", 49, runs=6)
    rows += _many(2, "2020", "V", "OUT", "W", 60, runs=1, wickets=3)
    got = {r.batter: r for r in stats.player_batting_stats(_balls(spark, rows)).collect()}
    assert set(got) == {"AT50", "OUT"}
    a = got["AT50"]
    assert (a.total_runs, a.balls_faced, a.fours, a.sixes, a.times_out, a.highest_score) == (200, 50, 50, 0, 0, 4)
    assert a.strike_rate == 400.0 and a.average is None and a.boundary_percentage == 100.0
    o = got["OUT"]
    assert o.times_out == 3 and o.average == 20.0 and o.strike_rate == 100.0


def test_bowling_threshold_overs_and_economy(spark):
    rows = _many(1, "2020", "V", "B", "AT60", 60, runs=0) + _many(1, "2020", "V", "B", "AT59", 59, runs=1)
    rows += _many(2, "2020", "V", "B", "SEVEN", 61, runs=1, wickets=2)
    got = {r.bowler: r for r in stats.player_bowling_stats(_balls(spark, rows)).collect()}
    assert set(got) == {"AT60", "SEVEN"}
    z = got["AT60"]
    assert z.overs_bowled == 10.0 and z.economy_rate == 0.0 and z.bowling_average is None
    assert z.dot_balls == 60 and z.dot_ball_percentage == 100.0
    s = got["SEVEN"]
    # 61 balls -> 10.2 overs (rounded first), economy = 61 / 10.2
    assert s.overs_bowled == 10.2 and s.economy_rate == round(61 / 10.2, 2) and s.bowling_average == 30.5


def test_venue_threshold_counts_matches(spark):
    rows = []
    for m in range(10):
        rows += _many(m, "2020", "TEN", "B", "W", 2, runs=3)
    for m in range(100, 109):
        rows += _many(m, "2020", "NINE", "B", "W", 2, runs=3)
    got = stats.venue_stats(_balls(spark, rows)).collect()
    assert [(r.venue, r.matches_played, r.total_balls, r.avg_runs_per_over) for r in got] == [("TEN", 10, 20, 18.0)]


def test_null_venue_is_its_own_group(spark):
    rows = []
    for m in range(10):
        rows += _many(m, "2020", None, "B", "W", 1)
    got = stats.venue_stats(_balls(spark, rows)).collect()
    assert len(got) == 1 and got[0].venue is None


def test_season_trends(spark):
    rows = _many(1, "2020", "V", "B", "W", 3, runs=2, wickets=1) + _many(2, "2020", "V", "B", "W", 1, runs=0)
    r = stats.season_trends(_balls(spark, rows)).collect()[0]
    assert (r.total_runs, r.total_balls, r.total_matches) == (6, 4, 2)
    assert r.avg_runs_per_ball == 1.5 and r.wicket_rate == 0.25
    assert r.avg_runs_per_match == 3.0 and r.avg_runs_per_over == 9.0


def test_round_half_up_on_decimal_text(spark):
    # 1337 / 40 = 33.425: the double sits just below the tie, but Spark rounds
    # the decimal text half-up (33.43), as the reference does
    rows = _many(1, "2020", "V", "B", "W", 40, runs=0, wickets=40)
    rows[0] = (1, "2020", "V", "B", "W", 1337, 1337, 1)
    got = stats.player_batting_stats(_balls(spark, rows), min_balls=1).collect()[0]
    assert got.times_out == 40 and got.average == 33.43


def test_top_k_ties_are_deterministic(spark):
    rows = []
    for i, name in enumerate(["Z", "A", "M"] + [f"X{j}" for j in range(12)]):
        rows += _many(i, "2020" if name != "M" else "2019", "V", name, "W", 50, runs=1)
    batting = stats.player_batting_stats(_balls(spark, rows))
    top = [r.batter for r in reports.top_run_scorers(batting).collect()]
    # all tied on total_runs: season first (2019), then name
    assert top == ["M", "A", "X0", "X1", "X10", "X11", "X2", "X3", "X4", "X5"]
    assert top == [r.batter for r in reports.top_run_scorers(batting).collect()]


def test_team_stats_winner_null_counts_as_played(spark):
    m = spark.createDataFrame(
        [("2020", 1, ["A", "B"], None, "A"), ("2020", 2, ["A", "B"], "A", "B")],
        "season string, match_id long, teams array<string>, winner string, toss_winner string",
    )
    got = {r.team: r for r in stats.team_stats(m).collect()}
    assert (got["A"].matches_played, got["A"].matches_won, got["A"].win_percentage) == (2, 1, 50.0)
    assert (got["B"].matches_won, got["B"].tosses_won, got["B"].toss_win_percentage) == (0, 1, 50.0)


@pytest.mark.parametrize("fn", [stats.player_batting_stats, stats.player_bowling_stats, stats.season_trends, stats.venue_stats])
def test_stats_are_single_aggregates(spark, fn, capsys):
    """Each statistic is one groupBy plan with partial (map-side) aggregation."""
    df = fn(_balls(spark, _many(1, "2020", "V", "B", "W", 70)))
    df.explain()
    plan = capsys.readouterr().out
    assert "partial_" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan

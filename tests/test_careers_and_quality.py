"""Career totals, comparison of players, quality counts on write, and the overs
stream, on hand-made rows."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from crease.operators.careers import career_batting, compare_batters
from crease.plans import quality
from crease.streaming import live_overs

BALLS = "season string, batter string, match_id string, runs_batter long, is_wicket int"


def test_career_levels_and_distinct_matches(spark):
    rows = [("2008", "a", "m1", 4, 0), ("2008", "a", "m1", 6, 1), ("2008", "b", "m1", 0, 0), ("2009", "a", "m2", 1, 0), ("2009", "a", "m3", 1, 1), (None, "b", "m4", 2, 0), ("2009", None, "m3", 3, 0)]
    got = {(r.level, r.season, r.batter): r for r in career_batting(spark.createDataFrame(rows, BALLS)).collect()}
    assert len(got) == 5 + 3 + 1
    a = got["career", None, "a"]
    assert (a.total_runs, a.balls_faced, a.matches_played, a.highest_score, a.times_out) == (12, 4, 3, 6, 2)
    assert (a.strike_rate, a.average) == (300.0, 6.0)
    assert got["season", "2008", "a"].matches_played == 1 and got["season", None, "b"].total_runs == 2
    assert got["career", None, "b"].matches_played == 2 and got["career", None, "b"].average is None
    assert got["career", None, None].total_runs == 3  # a ball without a batter
    every = got["all players", None, None]
    assert (every.total_runs, every.matches_played, every.balls_faced) == (17, 4, 7)


def test_no_balls_no_careers(spark):
    assert career_batting(spark.createDataFrame([], BALLS)).collect() == []


def test_comparison_with_ties(spark):
    rows = [("s", "a", 100, 120.0, None, 50), ("s", "b", 100, 110.0, 20.0, 60), ("s", "c", 50, 130.0, 10.0, 55), ("s", "d", 100, None, 1.0, 50), ("t", "a", 7, 1.0, 1.0, 50)]
    df = spark.createDataFrame(rows, "season string, batter string, total_runs long, strike_rate double, average double, balls_faced long")
    got = {(r.season, r.batter): r for r in compare_batters(df, groups=2).collect()}
    assert [got["s", x].runs_rank for x in "abdc"] == [1, 1, 1, 4]
    assert got["s", "c"].runs_percent_rank == 1.0 and got["s", "a"].runs_percent_rank == 0.0
    assert [got["s", x].runs_group for x in "adbc"] == [1, 1, 2, 2]  # ties by fewer balls, then name
    assert [got["s", x].strike_rank for x in "cabd"] == [1, 2, 3, 4]
    assert got["s", "c"].runs_behind == 50 and got["t", "a"].runs_rank == 1 and got["t", "a"].runs_percent_rank == 0.0


def test_rules_are_counted_while_writing(spark, tmp_path):
    rows = [
        ("V", dt.date(2020, 1, 1), ["A", "B"], "A", 0, "x", "y", "z", 4, 1, 5, 0, None),
        (None, None, ["A", "B"], "C", 20, "x", "x", "x", 7, 1, 5, 1, ""),
        ("V", None, None, None, None, None, None, None, None, None, None, 1, "x - bowled"),
    ]
    schema = "venue string, match_date date, teams array<string>, batting_team string, over_number long, batter string, bowler string, non_striker string, runs_batter long, runs_extras long, runs_total long, is_wicket int, wicket_details string"
    df = spark.createDataFrame(rows, schema)
    got = quality.write_checked(df, str(tmp_path / "t"), quality.ball_rules())
    assert got.pop("rows") == 3
    assert got == {
        "venue missing": 1, "date missing": 2, "runs do not add up": 1, "runs out of range": 1, "batter bowls to himself": 1,
        "batter on both ends": 1, "over out of range": 1, "wicket without details": 1, "team does not play": 1,
    }
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    nothing = quality.write_checked(df.limit(0), str(tmp_path / "none"), quality.ball_rules())
    assert set(nothing.values()) == {0}


T0 = dt.datetime(2024, 5, 1, 12, 0)


def _land(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def _ball(mid, minutes, over, runs, first=True, wicket=0, day=0):
    at = (T0 + dt.timedelta(days=day, minutes=minutes)).isoformat() + "Z"
    return {"match_id": mid, "bowled_at": at, "first_innings": first, "over_number": over, "batter": "b", "bowler": "w", "runs_batter": runs, "runs_total": runs, "is_wicket": wicket}


def _match(mid, day=0):
    return {"match_id": mid, "began_at": (T0 + dt.timedelta(days=day)).isoformat() + "Z", "season": "2024", "venue": "V", "team1": f"A{mid}", "team2": f"B{mid}"}


@pytest.mark.parametrize("rocksdb", [True, False])
def test_overs_grow_over_micro_batches(spark, tmp_path, rocksdb):
    """A match that is landed after its first balls, an over that spans batches, a
    ball outside its match's day, state that is let go."""
    balls, matches = tmp_path / "balls", tmp_path / "matches"
    table, ckpt = str(tmp_path / "overs"), str(tmp_path / "ckpt")

    def run():
        q = live_overs.start_live_overs(spark, str(balls), str(matches), table, ckpt, available_now=True, state_partitions=3, rocksdb_state=rocksdb)
        q.awaitTermination()
        rows = live_overs.read_overs(spark, table).collect()
        return q, {(r.match_id, r.batting_team, r.over_number): (r.balls, r.runs, r.wickets) for r in rows}

    _land(balls, "1.json", [_ball(1, 0, 0, 4), _ball(1, 1, 0, 6), _ball(2, 0, 0, 1)])
    _land(matches, "1.json", [_match(1)])
    assert run()[1] == {(1, "A1", 0): (2, 10, 0)}  # match 2 is not known yet
    _land(balls, "2.json", [_ball(1, 2, 0, 0, wicket=1), _ball(1, 100, 0, 2, first=False), _ball(1, 24 * 60, 1, 6)])
    _land(matches, "2.json", [_match(2)])
    second = run()[1]
    assert second == {(1, "A1", 0): (3, 10, 1), (1, "B1", 0): (1, 2, 0), (2, "A2", 0): (1, 1, 0)}
    assert run()[1] == second  # nothing new, nothing twice
    _land(balls, "3.json", [_ball(3, 0, 5, 6, day=30)])
    _land(matches, "3.json", [_match(3, day=30)])
    q, rows = run()
    assert rows == second | {(3, "A3", 5): (1, 6, 0)}
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert state[-1] <= 2  # the matches and balls of May are gone

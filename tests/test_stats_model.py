"""Brute force: the five statistics against plain-Python group-bys over a
seeded random ball table (skewed: one season and one venue hold a third of the
balls), with half-up rounding on the decimal text of each double."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from crease.operators import stats


def r(x, n):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


def _balls(rng, n=6000):
    rows = []
    for _ in range(n):
        hot = rng.random() < 1 / 3
        season = "2008" if hot else rng.choice(["2009", "2010", "2011"])
        venue = "Hot Ground" if hot else rng.choice([f"G{i}" for i in range(12)])
        match = rng.randint(1, 40) if hot else rng.randint(41, 400)
        rb = rng.choice([0, 0, 1, 1, 2, 3, 4, 6])
        extra = 1 if rng.random() < 0.07 else 0
        rows.append((match, season, venue, f"B{rng.randint(1, 15)}", f"W{rng.randint(1, 10)}", rb, rb + extra,
                     1 if rng.random() < 0.05 else 0))
    return rows


def test_statistics_match_model(spark):
    rows = _balls(random.Random(77))
    df = spark.createDataFrame(
        rows, "match_id long, season string, venue string, batter string, bowler string, runs_batter long, runs_total long, is_wicket int"
    )
    bat, bowl, sea, ven = defaultdict(list), defaultdict(list), defaultdict(list), defaultdict(list)
    for row in rows:
        m, s, v, b, w = row[:5]
        bat[(s, b)].append(row)
        bowl[(s, w)].append(row)
        sea[s].append(row)
        ven[v].append(row)

    want = {}
    for key, g in bat.items():
        n, runs, outs = len(g), sum(x[5] for x in g), sum(x[7] for x in g)
        fours, sixes = sum(x[5] == 4 for x in g), sum(x[5] == 6 for x in g)
        if n >= 50:
            want[key] = (runs, n, len({x[0] for x in g}), max(x[5] for x in g), fours, sixes, outs,
                         r(runs / n * 100, 2), r(runs / outs, 2) if outs else None, r((fours + sixes) / n * 100, 2))
    got = {(x.season, x.batter): (x.total_runs, x.balls_faced, x.matches_played, x.highest_score, x.fours, x.sixes,
                                  x.times_out, x.strike_rate, x.average, x.boundary_percentage)
           for x in stats.player_batting_stats(df).collect()}
    assert got == want and got

    want = {}
    for key, g in bowl.items():
        n, conceded, wk = len(g), sum(x[6] for x in g), sum(x[7] for x in g)
        dots = sum(x[6] == 0 for x in g)
        if n >= 60:
            overs = r(n / 6, 1)
            want[key] = (n, conceded, len({x[0] for x in g}), wk, dots, overs, r(conceded / overs, 2),
                         r(conceded / wk, 2) if wk else None, r(dots / n * 100, 2))
    got = {(x.season, x.bowler): (x.balls_bowled, x.runs_conceded, x.matches_played, x.wickets_taken, x.dot_balls,
                                  x.overs_bowled, x.economy_rate, x.bowling_average, x.dot_ball_percentage)
           for x in stats.player_bowling_stats(df).collect()}
    assert got == want and got

    got = {x.season: x for x in stats.season_trends(df).collect()}
    for s, g in sea.items():
        n, runs, mt = len(g), sum(x[6] for x in g), len({x[0] for x in g})
        x = got[s]
        assert (x.total_runs, x.total_balls, x.total_matches) == (runs, n, mt)
        assert abs(x.avg_runs_per_ball - runs / n) < 1e-12 and abs(x.wicket_rate - sum(y[7] for y in g) / n) < 1e-12
        assert x.avg_runs_per_match == r(runs / mt, 2) and x.avg_runs_per_over == r(x.avg_runs_per_ball * 6, 2)

    got = {x.venue: x for x in stats.venue_stats(df).collect()}
    want = {v for v, g in ven.items() if len({x[0] for x in g}) >= 10}
    assert set(got) == want and "Hot Ground" in got
    for v in want:
        g = ven[v]
        assert (got[v].matches_played, got[v].total_balls) == (len({x[0] for x in g}), len(g))

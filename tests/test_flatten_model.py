"""Brute force: the flatten (balls_by_ball) against a plain-Python walk of the
same documents, on 400 seeded random documents with missing / empty / null
levels, null fields and every wicket shape, landed as JSON Lines."""

from __future__ import annotations

import json
import random

from crease.operators.flatten import balls_by_ball
from crease.sources.documents import read_match_documents


def _maybe(rng, value, p_missing=0.1):
    return None if rng.random() < p_missing else value


def _delivery(rng):
    d = {"batter": _maybe(rng, rng.choice(["A", "B", "C"])), "bowler": _maybe(rng, rng.choice(["X", "Y"])),
         "non_striker": _maybe(rng, "N")}
    if rng.random() < 0.9:
        d["runs"] = {k: _maybe(rng, rng.randint(0, 6)) for k in ("batter", "extras", "total")}
    roll = rng.random()
    if roll < 0.2:
        d["wickets"] = []
    elif roll < 0.5:
        d["wickets"] = [{"player_out": _maybe(rng, rng.choice(["A", "B"])), "kind": _maybe(rng, rng.choice(["bowled", "lbw"]))}
                        for _ in range(rng.randint(1, 2))]
    return d


def _doc(rng):
    info = {"season": _maybe(rng, rng.choice(["2008", "2009/10"])), "teams": ["T1", "T2"],
            "venue": _maybe(rng, rng.choice(["V1", "V2"])),
            "dates": rng.choice([None, [], ["2009-05-01"], ["bad"], ["2010-01-02", "2010-01-03"]])}
    innings = None if rng.random() < 0.1 else []
    if innings is not None:
        for _ in range(rng.randint(0, 2)):
            overs = None if rng.random() < 0.1 else []
            if overs is not None:
                for o in range(rng.randint(0, 3)):
                    dels = None if rng.random() < 0.1 else [_delivery(rng) for _ in range(rng.randint(0, 4))]
                    overs.append({"over": o, "deliveries": dels})
            innings.append({"team": rng.choice(["T1", "T2"]), "overs": overs})
    return {"info": info, "innings": innings}


def _expected(doc):
    info = doc["info"]
    season = info["season"] or "Unknown"
    dates = info["dates"] or []
    date = dates[0] if dates and dates[0] != "bad" else None
    out = []
    for inn in doc["innings"] or []:
        for ov in inn["overs"] or []:
            for d in ov["deliveries"] or []:
                batter, bowler = d["batter"] or "Unknown", d["bowler"] or "Unknown"
                if season == "Unknown" or batter == "Unknown" or bowler == "Unknown":
                    continue
                runs = d.get("runs") or {}
                wk = d.get("wickets")
                has = bool(wk)
                details = None
                if has:
                    parts = [f"{w['player_out']} - {w['kind']}" for w in wk if w["player_out"] is not None and w["kind"] is not None]
                    details = ", ".join(parts)
                out.append((season, info["venue"], date, inn["team"], ov["over"], batter, bowler, d["non_striker"] or "Unknown",
                            runs.get("batter") or 0, runs.get("extras") or 0, runs.get("total") or 0, 1 if has else 0, details))
    return out


def test_flatten_matches_model(spark, tmp_path):
    rng = random.Random(1905)
    docs = [_doc(rng) for _ in range(400)]
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "docs.json").write_text("\n".join(json.dumps(d) for d in docs) + "\n")
    balls = balls_by_ball(read_match_documents(spark, str(folder), multi_line=False), with_load_time=False)
    cols = ["season", "venue", "match_date", "batting_team", "over_number", "batter", "bowler", "non_striker",
            "runs_batter", "runs_extras", "runs_total", "is_wicket", "wicket_details"]
    got = sorted(
        (tuple(str(v) if k == "match_date" and v is not None else v for k, v in zip(cols, r))
         for r in balls.select(*cols).collect()),
        key=repr,
    )
    want = sorted((row for d in docs for row in _expected(d)), key=repr)
    assert len(got) == len(want) > 100
    assert got == want
    assert balls.select("ball_id").distinct().count() == len(want)

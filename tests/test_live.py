"""Live snapshots: flags, score texts, chase, winner and margin, quarantine,
first-seen / last-seen upsert, late arrivals and the recent-state cache."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from crease.operators import live
from crease.schemas import CORRUPT_COLUMN, LIVE_RESPONSE, LIVE_RESPONSE_READ

T0 = dt.datetime(2024, 5, 1, 19, 0, 0)


def _m(mid, status, t1="Harbour Hawks", t2="River Wolves", score=None, venue="Dockside", teams=None):
    info = teams if teams is not None else [{"name": t1}, {"name": t2}]
    return {"id": mid, "status": status, "venue": venue, "teamInfo": info, "score": score}


def _resp(minute, seq, *matches):
    return (T0 + dt.timedelta(minutes=minute), seq, list(matches))


RESPONSES = [
    _resp(0, 1, _m("m1", "Match in Progress", score=[{"r": 137, "w": 3, "o": 14.3}]),
      _m("m2", "Granite Owls won by 37 runs", "Granite Owls", "Meadow Kings",
         [{"r": 176, "w": 6, "o": 20.0}, {"r": 139, "w": 7, "o": 20.0}], venue="Quarry Field")),
    _resp(5, 2, _m("m1", "Wolves need 47 runs", t1="HH", score=[{"r": 137, "w": 3, "o": 20.0}, {"r": 91, "w": 2, "o": 11.5}],
                   venue="Elsewhere")),
    _resp(3, 3, _m("m1", "Innings Break", score=[{"r": 137, "w": 3, "o": 20.0}])),  # late file, older snapshot
    _resp(1, 4, _m("m3", "Meadow Kings won by 5 wickets", "Granite Owls", "Meadow Kings", []),
      _m("m4", "No result", "Rajasthan Royals", "Delhi Capitals"),
      _m("m5", "Rajasthan won the toss, batting first", "Rajasthan Royals", "Sunrisers Hyderabad"),
      _m("m6", "Match starts at 7:30 PM", "Gujarat Titans", "Lucknow Giants", venue=None),
      _m("m7", "Innings Break", score=[{"w": 1, "o": 3.0}]),
      _m("m8", "Live", score=[{"w": 5, "o": 20.0}, {"r": 10, "w": 0, "o": 2.0}]),
      _m("m9", "Live", score=[{"r": 100, "w": 5, "o": 20.0}, {"r": 120, "w": 3, "o": 15.0}]),
      _m(None, "Live"),
      _m("q2", None),
      _m("q3", "Live", teams=[{"name": "Only One"}]),
      _m("m10", "Live", score=[{"r": 200, "w": 1, "o": 20.0}, {"r": 0, "w": 0, "o": 19.5}]),
      _m("m11", "Live", t1="X" * 101),
      _m("m12", "A Kings won by 1 run", "A Kings", "B Kings"),
      _m("m13", 'He said "hi" XI won by 2 wickets with 3 balls left', 'He said "hi" XI', "Other XI")),
]


@pytest.fixture(scope="module")
def responses(spark):
    return spark.createDataFrame(RESPONSES, LIVE_RESPONSE)


@pytest.fixture(scope="module")
def parts(responses):
    valid, quarantine = live.validate_snapshots(live.snapshot_rows(responses))
    return live.live_rows(valid).cache(), quarantine


@pytest.fixture(scope="module")
def rows(parts):
    return {(r.match_id, r.seq): r for r in parts[0].collect()}


def test_quarantine_reasons(parts):
    got = sorted(((r.match_id, r.reason) for r in parts[1].collect()), key=lambda x: (x[0] or "", x[1]))
    assert got == [(None, "missing id"), ("q2", "missing status"), ("q3", "missing team 2")]


def test_flags_and_labels(rows):
    assert (rows["m1", 1].is_ongoing, rows["m1", 1].is_completed, rows["m1", 1].state) == (True, False, "LIVE")
    assert rows["m1", 2].state == "UPCOMING"
    assert (rows["m4", 4].is_completed, rows["m4", 4].state) == (True, "COMPLETED")
    m5 = rows["m5", 4]  # "won the toss, batting first": both flags
    assert (m5.is_ongoing, m5.is_completed, m5.state) == (True, True, "LIVE")


def test_score_texts_and_over(rows):
    r = rows["m1", 1]
    assert (r.team1_score, r.team2_score, r.current_over) == ("137/3 (14.3 ov)", "Yet to bat", 14.3)
    r = rows["m1", 2]
    assert (r.team1_score, r.team2_score, r.current_over) == ("137/3 (20.0 ov)", "91/2 (11.5 ov)", 11.5)
    assert (rows["m6", 4].team1_score, rows["m6", 4].team2_score, rows["m6", 4].current_over) == ("Not started", "Not started", 0.0)
    assert rows["m3", 4].team1_score == "Not started"  # empty score array
    assert (rows["m7", 4].team1_score, rows["m7", 4].current_over) == ("0/0 (0.0)", 3.0)  # r missing
    assert rows["m6", 4].venue == "Unknown"


def test_chase(rows):
    r = rows["m1", 2]
    assert r.target == 138 and r.required_rate == pytest.approx(47 / 8.5)
    assert (rows["m2", 1].target, rows["m2", 1].required_rate) == (177, 0.0)  # 20 overs gone
    assert (rows["m8", 4].target, rows["m8", 4].required_rate) == (0, 0.0)  # first innings lacks r
    assert rows["m9", 4].required_rate == pytest.approx(-3.8)  # target passed: no clamp
    assert rows["m10", 4].required_rate == pytest.approx(402.0)


def test_winner_and_margin(rows):
    assert (rows["m2", 1].winner, rows["m2", 1].result_margin) == ("Granite Owls", "37 runs")
    assert (rows["m3", 4].winner, rows["m3", 4].result_margin) == ("Meadow Kings", "5 wickets")
    assert (rows["m4", 4].winner, rows["m4", 4].result_margin) == ("", "No result")
    m5 = rows["m5", 4]
    assert (m5.winner, m5.result_margin) == ("", "Rajasthan won the toss, batting first")
    assert (rows["m12", 4].winner, rows["m12", 4].result_margin) == ("A Kings", "1 run")  # team1 wins the tie
    assert (rows["m13", 4].winner, rows["m13", 4].result_margin) == ('He said "hi" XI', "2 wickets")
    assert (rows["m1", 1].winner, rows["m1", 1].result_margin) == ("", "")


def test_storable(parts):
    st = {r.match_id: r.store_problem for r in live.storable(parts[0]).collect()}
    assert st["m10"] == "required_rate overflow"
    assert st["m11"] == "team1 longer than 100"
    assert st["m1"] is None


def test_current_state_first_and_last_seen(parts):
    state = {r.match_id: r for r in live.current_state(parts[0]).collect()}
    assert "m10" not in state and "m11" not in state  # not storable
    m1 = state["m1"]
    assert (m1.team1, m1.venue) == ("Harbour Hawks", "Dockside")  # first seen
    assert m1.status == "Wolves need 47 runs"  # the latest, not the late-arriving older file
    assert m1.updated_at == T0 + dt.timedelta(minutes=5)
    assert m1.current_over == Decimal("11.5") and m1.required_rate == Decimal("5.53") and m1.target == 138
    assert m1.date_time is None and m1.balls_remaining is None


def test_state_independent_of_arrival_order(spark, responses):
    def state(df):
        valid, _ = live.validate_snapshots(live.snapshot_rows(df))
        return sorted(tuple(r) for r in live.current_state(live.live_rows(valid)).collect())

    shuffled = spark.createDataFrame(list(reversed(RESPONSES)), LIVE_RESPONSE).repartition(3)
    assert state(responses) == state(shuffled)


def test_cache_ttl_and_json(parts):
    as_of = T0 + dt.timedelta(minutes=1, seconds=599)
    entries = {r.cache_key: r for r in live.cache_entries(parts[0], as_of=as_of).collect()}
    # written at minute 1 (599 s before as_of): alive; minute 0 (659 s): expired; minute 5: alive
    assert "live:m13" in entries and "live:m2" not in entries and "live:m1" in entries
    later = {r.cache_key for r in live.cache_entries(parts[0], as_of=as_of + dt.timedelta(seconds=2)).collect()}
    assert "live:m13" not in later  # 601 s
    payload = json.loads(entries["live:m13"].payload)
    assert payload["teams"] == 'He said "hi" XI vs Other XI'
    assert entries["live:m10"]  # not storable, still cached


def test_report(parts):
    rep = {r.match_id: r for r in live.live_report(live.current_state(parts[0])).collect()}
    m9 = rep["m9"]
    assert (m9.live_over, m9.live_target, m9.live_rate) == (Decimal("15.0"), 101, None)
    assert (m9.team1_score, m9.team2_score, m9.venue) == ("100/5 (20.0 ov)", "120/3 (15.0 ov)", "Dockside")
    m2 = rep["m2"]
    assert (m2.winner, m2.result_margin, m2.live_over) == ("Granite Owls", "37 runs", None)
    assert (rep["m6"].state, rep["m6"].status) == ("UPCOMING", "Match starts at 7:30 PM")


def _json(spark, tmp_path, lines):
    (tmp_path / "r.json").write_text("\n".join(lines))
    return spark.read.schema(LIVE_RESPONSE_READ).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(str(tmp_path / "r.json"))


def _line(score, mid="x", seq=1):
    match = {"id": mid, "status": "Live", "teamInfo": [{"name": "A"}, {"name": "B"}], "score": score}
    return json.dumps({"fetched_at": "2024-05-01T19:00:00.000000", "seq": seq, "data": [match]})


def test_score_numbers_in_any_notation(spark, tmp_path):
    """Integers, decimals and numeric texts are the same number."""
    lines = [_line([{"r": r, "w": w, "o": o}], str(i)) for i, (r, w, o) in enumerate([(142, 3, 20), (142.0, 3.0, 20.0), ("142", "3", "20"), (142.9, "3.0", "20.0")])]
    valid, quarantine = live.validate_snapshots(live.snapshot_rows(_json(spark, tmp_path, lines)))
    assert {r.team1_score for r in live.live_rows(valid).collect()} == {"142/3 (20.0 ov)"}
    assert live.live_rows(valid).count() == 4 and not quarantine.select("reason").collect()


def test_nothing_is_lost(spark, tmp_path):
    """Every entry is stored or set aside with its text and a reason."""
    lines = [
        _line([{"r": 1, "w": 1, "o": 1}], "ok"),
        _line([{"r": "x", "w": 1, "o": 1}], "bad r"),
        _line([{"r": 1, "w": 1, "o": 1}, {"r": 1, "w": 99999999999, "o": 1}], "w too large"),
        _line([{"w": 1}], "missing r"),
        _line([{"r": 1, "w": 1, "o": 20}, {"r": 0, "w": 0, "o": 19.99}], "rate"),
        '{"fetched_at": "2024-05-01T19:00:00.000000", "seq": 2, "data": [{"id": ',
        '{"fetched_at": "2024-05-01T19:00:00.000000", "seq": 3}',
        '{"fetched_at": "2024-05-01T19:00:00.000000", "seq": 4, "data": []}',
        '{"fetched_at": "2024-05-01T19:00:00.000000", "seq": 5, "data": [null]}',
        _line(None, "no time").replace("2024-05-01T", "someday"),
    ]
    responses = _json(spark, tmp_path, lines)
    valid, _ = live.validate_snapshots(live.snapshot_rows(responses))
    stored = {r.match_id for r in live.current_state(live.live_rows(valid)).collect()}
    assert stored == {"ok", "missing r"}
    rejected = live.rejected_snapshots(responses).collect()
    assert sorted((r.match_id or "", r.reason) for r in rejected) == [
        ("", "missing id"),
        ("", "unparsable response"),
        ("", "unparsable response"),
        ("bad r", "unreadable score"),
        ("no time", "missing time"),
        ("rate", "required_rate overflow"),
        ("w too large", "unreadable score"),
    ]
    texts = {r.reason: r.raw for r in rejected}
    assert lines[5] in {r.raw for r in rejected}
    assert '"99999999999"' in next(r.raw for r in rejected if r.match_id == "w too large")
    assert all(texts.values())
    assert live.snapshot_rows(responses).count() == len(stored) + len(rejected)


def test_cache_of_nothing_and_of_the_past(spark, parts):
    nothing = parts[0].limit(0)
    assert live.cache_entries(nothing).collect() == []
    past = live.cache_entries(parts[0], as_of=T0 + dt.timedelta(seconds=30)).collect()
    assert sorted(r.cache_key for r in past) == ["live:m1", "live:m2"]
    assert max(r.written_at for r in past) <= T0 + dt.timedelta(seconds=30)


def test_extreme_scores_stop_nothing(spark, tmp_path):
    """The largest and smallest numbers, infinite ones and none: stored, or set
    aside with a reason, in the rows, the state, the cache and the rejects."""
    top, low = 2147483647, -2147483648
    cases = {
        "top": [{"r": top, "w": 1, "o": 20}, {"r": 3, "w": 1, "o": 5}],
        "low": [{"r": 5, "w": low, "o": 20}, {"r": low, "w": 1, "o": 5}],
        "both": [{"r": top, "w": top, "o": 20}, {"r": low, "w": low, "o": -1e300}],
        "alone": [{"r": top, "w": 1, "o": 20}],
        "fraction": [{"r": 2147483647.75, "w": 1, "o": 20}],
        "over": [{"r": 2147483648, "w": 1, "o": 20}],
        "inf": [{"r": 1, "w": 1, "o": 20}, {"r": 1, "w": 1, "o": "Infinity"}],
        "-inf": [{"r": 1, "w": 1, "o": "-Infinity"}],
        "nan": [{"r": 1, "w": 1, "o": "NaN"}],
        "inf r": [{"r": "Infinity", "w": 1, "o": 2}],
        "huge o": [{"r": 1, "w": 1, "o": 1e308}],
        "third": [{"r": 1, "w": 1, "o": 20}, {"r": 1, "w": 1, "o": 2}, {"r": "x", "w": "NaN", "o": "Infinity"}],
    }
    responses = _json(spark, tmp_path, [_line(score, mid) for mid, score in cases.items()])
    valid, _ = live.validate_snapshots(live.snapshot_rows(responses))
    rows = {r.match_id: r for r in live.live_rows(valid).collect()}
    assert rows["top"].target == 2147483648 and rows["both"].target == 2147483648
    reasons = {r.match_id: r.reason for r in live.rejected_snapshots(responses).collect()}
    assert reasons == {
        "top": "target overflow", "low": "required_rate overflow", "both": "current_over overflow", "over": "unreadable score",
        "inf": "unreadable score", "-inf": "unreadable score", "nan": "unreadable score", "inf r": "unreadable score", "huge o": "current_over overflow",
    }
    stored = {r.match_id for r in live.current_state(live.live_rows(valid)).collect()}
    assert stored == {"alone", "fraction", "third"} and stored | set(reasons) == set(cases)
    assert {r.cache_key for r in live.cache_entries(live.live_rows(valid)).collect()} == {f"live:{m}" for m in rows}

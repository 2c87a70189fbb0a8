"""Shares of a task, ids and landed text at size: what each step leaves behind and how
its plan deals the rows."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os

import pytest
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F

from crease.functions.core import short_id
from crease.operators import careers, stats
from crease.plans import queries
from crease.sources import documents, drift, tables, testdata
from crease.streaming import live_overs


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((str(r) for r in df.collect()))


def test_partitions_follow_the_rows(spark, small_tasks):
    assert tables.tasks_for(spark.range(100)) is None  # the session's 8 do
    assert tables.tasks_for(spark.range(5001)) == 101
    n = testdata.delivery_tasks(spark, SF_SMALL)
    assert n == -(-testdata.load(spark, SF_SMALL, "lineitem").count() // 50)
    for df in (testdata.balls(spark, SF_SMALL), testdata.match_documents(spark, SF_SMALL)):
        assert f", {n})" in _plan(df)


@pytest.mark.parametrize("name", ["player_batting_stats", "player_bowling_stats", "career_batting", "balls_by_ball", "live_overs_stream"])
def test_results_do_not_depend_on_the_partitions(spark, monkeypatch, name):
    want = _rows(queries.QUERIES[name](spark, SF_CHECK))
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 2500)
    assert want and _rows(queries.QUERIES[name](spark, SF_CHECK)) == want


def test_career_counts_without_a_row_per_level_and_match(spark):
    """Matches that come in two seasons, null ids, seasons and batters; no exchange of
    the levels' rows by match."""
    rows = [(s, b, m, r) for m, s, b, r in [
        (1, "2008", "A", 4), (1, "2009", "A", 1), (1, "2008", "B", 0), (2, "2008", "A", 6), (None, "2008", "A", 1),
        (None, "2009", None, 2), (3, None, "A", 3), (3, "2009", None, 5), (2, "2008", "A", 1),
    ]]
    balls = spark.createDataFrame(rows, "season string, batter string, match_id long, runs_batter long").withColumn("is_wicket", F.lit(0))
    got = careers.career_batting(balls)
    assert not any("grouping_id" in line and "match_id" in line for line in _plan(got).splitlines() if "Exchange" in line)
    for r in got.collect():
        of = [x for x in rows if (r["level"] != "season" or x[0] == r["season"]) and (r["level"] == "all players" or x[1] == r["batter"])]
        assert r["matches_played"] == len({x[2] for x in of} - {None}), r
        assert r["total_runs"] == sum(x[3] for x in of) and r["balls_faced"] == len(of)


def test_short_ids_differ_where_ids_do(spark):
    md5 = [hashlib.md5(bytes([k])).hexdigest() for k in range(20)]
    ids = [*md5, *[f"{i}-1" for i in md5], *[f"{i}:0.1.2" for i in md5], md5[0].upper(), md5[0][:-1], "", "abc", "0abc", "\x00abc", "V1", None, f"{md5[1]}\n"]
    df = spark.createDataFrame([(i,) for i in ids + ids], "match_id string")
    short = df.select(short_id("match_id").alias("s"), "match_id").distinct().collect()
    assert len({bytes(r["s"]) for r in short if r["s"] is not None}) == len(ids) - 1
    assert all(r["s"] is None for r in short if r["match_id"] is None)
    assert max(len(r["s"]) for r in short if r["match_id"] in md5) == 17
    assert df.agg(stats.match_count(df)).first()[0] == len(ids) - 1


def test_landed_text_is_packed(spark):
    for corrupt in (False, True):
        path, glob = queries.land_documents(spark, SF_SMALL, corrupt)
        parts = [f for f in os.listdir(path) if f.startswith("part-")]
        assert parts and all(f.endswith(".gz") for f in parts) and glob.endswith(".gz")
        read = documents.read_match_documents(spark, path, multi_line=False, glob=glob)
        assert spark.read.text(path).count() == testdata.load(spark, SF_SMALL, "orders").count() == read.cache().count()


def test_documents_twice_are_built_once(spark):
    docs = spark.createDataFrame([(k,) for k in (0, 1, 50, None)], "match_id long")
    again = queries._again(docs, F.col("match_id") % 50 == 0)
    assert sorted(str(r[0]) for r in again.collect()) == ["0", "0", "1", "50", "50", "None"]
    assert "Union" not in _plan(again)


def test_documents_stay_in_place_when_few_repeat(spark, tmp_path):
    doc = {"info": {"season": "2009"}, "innings": [], "meta": {"revision": 1}}
    lines = [json.dumps({**doc, "meta": {"revision": k % 90}}) for k in range(100)]
    (tmp_path / "d.json").write_text("\n".join(lines))
    read = documents.read_match_documents(spark, str(tmp_path), multi_line=False)
    bronze = str(tmp_path / "bronze")
    read.write.parquet(bronze)
    told = documents.separate_repeats(spark.read.parquet(bronze))
    assert "SortMergeJoin" not in _plan(told) and "Exchange hashpartitioning" not in _plan(told)
    ids = [r["match_id"] for r in told.collect()]
    assert len(set(ids)) == 100 and sum(i.endswith("-1") for i in ids) == 10


def test_drift_told_by_the_schema_alone(spark, tmp_path):
    """What fits as a whole gives nothing whatever its names are; odd names hide nothing;
    the schema of a value is made few times."""
    info = {"season": "2009", "registry": {"people": {"a>, zz: BIGINT": "x", "b`<c": "y", "": "z"}}, "overs": 20, "by": None}
    del info["by"]
    whole = {"info": info, "innings": [{"team": "A", "overs": [{"over": 12345678901234567890, "deliveries": [{"runs": {"total": 1}}, None]}]}], "meta": None}
    lines = [whole, {"info": {**info, "registry": {"people": {"x": 1}, "a>, b": 1}}}, {"info": {**info, "overs": "20"}}, {"innings": []}, {}, None]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(d) for d in lines))
    read = drift.read_variants(spark, str(tmp_path))
    fits = read.select(drift._fits(F.schema_of_variant("document"), drift.MATCH_DOCUMENT).alias("f")).collect()
    assert [r["f"] for r in fits] == [True, False, False, True, True, True]
    values = drift.drift_values(read)
    assert {(r["level"], r["field"], r["declared"], r["found"]) for r in values.collect()} == {
        ("info.registry", "a>, b", None, "integer"), ("info", "overs", "long", "string"),
    }
    assert values._jdf.queryExecution().analyzed().toString().count("schema_of_variant") < 200


@pytest.fixture
def overs_started(monkeypatch):
    """(query, options) of every overs stream that a test starts."""
    seen = []

    def started(*args, _start=live_overs.start_live_overs, **options):
        seen.append((_start(*args, **options), options))
        return seen[-1][0]

    monkeypatch.setattr(live_overs, "start_live_overs", started)
    return seen


def _season(spark, folder, days, per_day):
    """orders and lineitem: matches on ``days`` days, four balls each, in no order of
    time; keys that come twice, nulls."""
    first = dt.datetime(2024, 1, 1)
    at = [(k, first + dt.timedelta(days=k * 37 % days)) for k in range(days * per_day)]
    at += [at[1], (2, first + dt.timedelta(days=days - 1)), (None, first), (days * per_day, None)]
    orders = [(k, 100 + i, "FOP"[i % 3], 10.0 + i, d, "5-LOW") for i, (k, d) in enumerate(at)]
    lines = [(k, i, i, n, float(i + n), 1.0, 0.09, 0.05, "RAN"[(i + n) % 3], "OF"[n % 2], first) for i, (k, _) in enumerate(at) for n in (1, 1, 2, 300)]
    lines.append((5, 1, 1, None, None, None, None, None, None, None, None))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    return len(orders) + len(lines)


@pytest.mark.parametrize("rows, days, per_day", [(300, 60, 12), (300, 4, 90), (10**6, 10, 3)])
def test_overs_wait_in_state_for_a_slice_of_time_only(spark, tmp_path, monkeypatch, overs_started, rows, days, per_day):
    """The stream takes what was recorded in the order of its time: the state does not
    grow with the table, nothing comes late, no column waits that no sum needs."""
    n = _season(spark, tmp_path, days, per_day)
    monkeypatch.setattr(live_overs, "rows_on_heap", lambda _: rows, raising=False)
    got = _rows(queries.QUERIES["live_overs_stream"](spark, str(tmp_path)))
    want = live_overs.over_partials(live_overs.joined_deliveries(*testdata.live_events(spark, str(tmp_path)))).drop("first_ball_at", "last_ball_at")
    assert got == _rows(want) and len(got) > 2 * days * per_day
    [(query, options)] = overs_started
    state = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert sum(op["numRowsDroppedByWatermark"] for op in state) == 0
    assert "batter" not in query._jsq.explainInternal(False)
    heaviest = 6 * per_day  # a day's matches and balls, a few more
    if rows < n:
        assert max(op["numRowsTotal"] for op in state) <= max(rows, heaviest) + 4 * heaviest < n or days == 4
    assert options["rocksdb_state"] == (days == 4)  # days too large for the heap


def test_slices_of_whole_days():
    events = {3: 5, 1: 4, 2: 4, 9: 30, 10: 1}
    assert live_overs.day_cuts(events, 9) == [3, 9, 10]  # 8, 5, 30, 1
    assert live_overs.day_cuts(events, 100) == live_overs.day_cuts({}, 1) == []
    assert live_overs.slice_rows(events, [3, 9, 10]) == 30
    assert live_overs.slice_rows(events, [3, 9], 3) == 31 and live_overs.slice_rows({1: 4, 2: 4, 3: 5}, [3], 1) == 9
    assert live_overs.slice_rows({}, []) == 0


def test_slice_of_a_day(spark):
    days = spark.createDataFrame([(d,) for d in (-5, 1, 2, 3, 8, 9, 10, 99, None)], "day long")
    cuts = [2, 3, 9, 10]
    assert [r[0] for r in days.select(live_overs._slice_of(F.col("day"), cuts)).collect()] == [0, 0, 1, 2, 2, 3, 4, 4, 4]
    assert [r[0] for r in days.select(live_overs._slice_of(F.col("day"), [])).collect()] == [0] * 9

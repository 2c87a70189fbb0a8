"""What the live job keeps of the past: cache as of any instant, validity
intervals, expired entries, folded changelogs, publication while it runs."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from crease.operators import live
from crease.plans import live as job
from crease.schemas import LIVE_RESPONSE
from crease.sources.commits import read_set
from crease.streaming import changelog, live_cache, live_state

BASE = dt.datetime(2024, 5, 1, 19, 0)


def _response(seconds, seq, mid, status="Live", score=None):
    m = {"id": mid, "status": status, "venue": "V", "teamInfo": [{"name": "A Reds"}, {"name": "B Blues"}], "score": score}
    return (BASE + dt.timedelta(seconds=seconds), seq, [m])


@pytest.fixture(scope="module")
def responses():
    """Four matches over two hours with gaps around the lifetime, ties in time, and one very busy match."""
    rng = random.Random(7)
    out = []
    for mid in "abcd":
        t = 0.0
        while t < 7200:
            t += rng.choice([1, 30, 599, 599.999999, 600, 600.5, 601, 1300])
            out.append(_response(t, len(out), mid, f"Live {len(out)}"))
    out += [_response(100, 900, "tie"), _response(100, 901, "tie", "Live later"), _response(60, 902, "minute"), _response(540, 903, "minute", "Live 2")]
    out += [_response(k * 2, 1000 + k, "busy", f"Live {k}") for k in range(1500)]
    return out


def _valid(spark, rows):
    df = spark.createDataFrame(rows, LIVE_RESPONSE)
    return live.live_rows(live.validate_snapshots(live.snapshot_rows(df))[0])


@pytest.fixture(scope="module")
def log(spark, responses, tmp_path_factory):
    root = tmp_path_factory.mktemp("history")
    src = live_state.land_responses(spark.createDataFrame(responses, LIVE_RESPONSE), str(root / "landing"), files=6)
    q = live_cache.start_cache_log(spark, src, str(root / "log"), str(root / "ckpt"), max_files_per_trigger=2, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(str(root / "log"))


def test_past_instants_equal_the_batch(spark, responses, log):
    valid = _valid(spark, responses).cache()
    instants = [BASE + dt.timedelta(seconds=s) for s in (-1, 0, 300, 639.9, 1201, 3600, 7300, 9000)]
    got = live_cache.cache_at(log, instants).collect()
    for t in instants:
        want = sorted(tuple(r) for r in live.cache_entries(valid, as_of=t).collect())
        assert sorted(tuple(r)[1:] for r in got if r.as_of == t) == want
    assert len({r.as_of for r in got}) >= 5


def test_two_writes_in_one_micro_batch(spark, log):
    """As of 19:05 the write of 19:01 counts, though 19:09 came in the same batch."""
    (row,) = [r for r in live_cache.cache_at(log, [BASE + dt.timedelta(minutes=5)]).collect() if r.cache_key == "live:minute"]
    assert row.written_at == BASE + dt.timedelta(minutes=1)


def test_intervals_tell_every_instant(spark, responses, log):
    got = live_cache.cache_intervals(log).collect()
    by_key = {}
    for r in got:
        assert r.valid_from < r.valid_to <= r.valid_from + dt.timedelta(seconds=600)
        by_key.setdefault(r.cache_key, []).append(r)
    for rows in by_key.values():
        rows.sort(key=lambda r: r.valid_from)
        assert all(a.valid_to <= b.valid_from for a, b in zip(rows, rows[1:]))
    for seconds in (0, 99.5, 100, 640, 1202, 3601, 7199, 8000):
        t = BASE + dt.timedelta(seconds=seconds)
        alive = {(r.cache_key, r.payload, r.valid_from) for r in got if r.valid_from <= t < r.valid_to}
        assert alive == {(r.cache_key, r.payload, r.written_at) for r in live_cache.cache_at(log, [t]).collect()}
    (tie,) = by_key["live:tie"]
    assert "Live later" in tie.payload


def test_sessions_are_emitted_when_expired(spark, responses, tmp_path):
    """Files in time order, one a micro-batch: expired lives as in the batch, once each."""
    src = live_state.land_responses(spark.createDataFrame(responses, LIVE_RESPONSE), str(tmp_path / "landing"), files=5)
    for k, name in enumerate(sorted(f for f in os.listdir(src) if f.endswith(".json"))):
        os.utime(f"{src}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
    q = live_cache.start_cache_sessions(spark, src, str(tmp_path / "t"), str(tmp_path / "c"), max_files_per_trigger=1, available_now=True, state_partitions=4)
    q.awaitTermination()
    every = live_cache.cache_sessions(live_cache.cache_writes(_valid(spark, responses))).collect()
    last = max(r[0] for r in responses)
    want = sorted(tuple(r) for r in every if r.expired_at <= last - dt.timedelta(seconds=600))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect())
    assert got == want and 0 < len(got) < len(every)
    busy = next(r for r in every if r.cache_key == "live:busy")
    assert busy.n_writes == 1500 and busy.expired_at == BASE + dt.timedelta(seconds=2998 + 600)


def test_changelog_refuses_the_past(spark, responses, tmp_path):
    src = live_state.land_responses(spark.createDataFrame(responses, LIVE_RESPONSE), str(tmp_path / "landing"), files=2)
    q = live_cache.start_live_cache(spark, src, str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    q.awaitTermination()
    with pytest.raises(ValueError, match="cache_at"):
        live_cache.read_live_cache(spark, str(tmp_path / "t"), as_of=BASE)
    later = max(r[0] for r in responses) + dt.timedelta(seconds=100)
    got = sorted(tuple(r) for r in live_cache.read_live_cache(spark, str(tmp_path / "t"), as_of=later).collect())
    assert got == sorted(tuple(r) for r in live.cache_entries(_valid(spark, responses), as_of=later).collect()) and got


def test_stream_leaves_the_callers_settings(spark, tmp_path):
    watched = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"]
    before = [spark.conf.get(k, None) for k in watched]
    session = live_state.stream_session(spark, state_partitions=3)
    assert session.conf.get(watched[0]) == "3" and session.conf.get(watched[1]) == live_state.ROCKSDB_PROVIDER
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert [spark.conf.get(k, None) for k in watched] == before


def test_folding_keeps_what_readers_see(spark, responses, tmp_path):
    """Both changelogs folded after every second micro-batch: the same tables, fewer parts."""
    src = live_state.land_responses(spark.createDataFrame(responses, LIVE_RESPONSE), str(tmp_path / "landing"), files=8)
    state, cache = str(tmp_path / "state"), str(tmp_path / "cache")
    options = {"max_files_per_trigger": 1, "available_now": True, "compact_every": 2}
    live_state.start_live_state(spark, src, state, str(tmp_path / "c1"), **options).awaitTermination()
    live_cache.start_live_cache(spark, src, cache, str(tmp_path / "c2"), source_format="text", **options).awaitTermination()
    valid = _valid(spark, responses).cache()
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    want_state, want_cache = rows(live.current_state(valid)), rows(live.cache_entries(valid))
    for _ in range(3):
        assert rows(live_state.read_live_state(spark, state)) == want_state
        assert rows(live_cache.read_live_cache(spark, cache)) == want_cache
        live_state.compact_live_state(spark, state)
        live_cache.compact_live_cache(spark, cache)
    for table in (state, cache):
        assert len([f for f in os.listdir(table) if f.startswith("batch_id=")]) <= 4
        assert len([f for f in os.listdir(f"{table}.snapshots") if f.startswith("upto=")]) <= 2
    log = changelog.read_changelog(spark, cache)
    assert log.groupBy("cache_key").count().filter("count > 1").count() == 0


def test_publication_while_the_streams_run(spark, responses, tmp_path):
    """The state is published while responses still arrive, again and again."""
    half = len(responses) // 2
    src = tmp_path / "landing"
    live_state.land_responses(spark.createDataFrame(responses[:half], LIVE_RESPONSE), str(src / "a"), files=2)
    root, out = str(tmp_path / "root"), str(tmp_path / "out")
    state = live_state.start_live_state(spark, str(src / "*"), f"{root}/live_state", f"{root}/c", processing_time="1 second")
    queries = {"live_state": state}
    try:
        state.processAllAvailable()
        job.run_live(spark, queries, root, out, publish_seconds=1.0, rounds=1)
        rows = lambda df: sorted(tuple(r) for r in df.collect())
        assert rows(read_set(spark, out)["live_matches"]) == rows(live.current_state(_valid(spark, responses[:half])))
        live_state.land_responses(spark.createDataFrame(responses[half:], LIVE_RESPONSE), str(src / "b"), files=2)
        state.processAllAvailable()
        job.run_live(spark, queries, root, out, publish_seconds=1.0, rounds=1)
        assert rows(read_set(spark, out)["live_matches"]) == rows(live.current_state(_valid(spark, responses)))
        assert state.isActive
    finally:
        state.stop()


def test_command_line_job(spark, responses, tmp_path):
    """All five streams over what has landed, and the published state."""
    src = live_state.land_responses(spark.createDataFrame(responses[:200], LIVE_RESPONSE), str(tmp_path / "landing"), files=2)
    root = str(tmp_path / "root")
    job.main([src, root, "--available-now", "--source-format", "text"])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    valid = _valid(spark, responses[:200]).cache()
    assert rows(read_set(spark, f"{root}/published")["live_matches"]) == rows(live.current_state(valid))
    tables = job.live_tables(spark, root)
    assert rows(tables["live_cache"]) == rows(live.cache_entries(valid))
    assert tables["live_cache_log"].count() == valid.count()

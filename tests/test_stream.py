"""The streaming current-state job equals the batch fold, over several
micro-batches, and a replayed run over the same checkpoint changes nothing."""

from __future__ import annotations

import datetime as dt

from test_live import RESPONSES

from crease.operators import live
from crease.schemas import LIVE_RESPONSE
from crease.streaming import live_state


def _batch_state(df):
    valid, _ = live.validate_snapshots(live.snapshot_rows(df))
    return live.current_state(live.live_rows(valid))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch(spark, tmp_path):
    responses = spark.createDataFrame(RESPONSES, LIVE_RESPONSE)
    source = live_state.land_responses(responses, str(tmp_path / "landing"), files=4)
    table, ckpt = str(tmp_path / "state"), str(tmp_path / "ckpt")
    q = live_state.start_live_state(spark, source, table, ckpt, max_files_per_trigger=1, available_now=True)
    q.awaitTermination()
    assert q.lastProgress is not None
    streamed = live_state.read_live_state(spark, table)
    batches = spark.read.parquet(table).select("batch_id").distinct().count()
    assert batches >= 2  # state carried across micro-batches
    assert _rows(streamed) == _rows(_batch_state(responses))

    # compaction rewrites the changelog as one batch with the same current state
    compacted = live_state.compact(spark, table, str(tmp_path / "compacted"))
    assert _rows(live_state.read_live_state(spark, compacted)) == _rows(streamed)

    # a restart on the same checkpoint finds nothing new and leaves the table as it was
    q2 = live_state.start_live_state(spark, source, table, ckpt, max_files_per_trigger=1, available_now=True)
    q2.awaitTermination()
    assert _rows(live_state.read_live_state(spark, table)) == _rows(streamed)


def test_late_file_does_not_overwrite(spark, tmp_path):
    """A file holding an older snapshot arrives after a newer one was folded in."""
    newer = [(dt.datetime(2024, 5, 1, 20, 0), 10, [{"id": "z", "status": "Live", "venue": "V", "teamInfo": [{"name": "A"}, {"name": "B"}], "score": None}])]
    older = [(dt.datetime(2024, 5, 1, 19, 0), 5, [{"id": "z", "status": "Innings Break", "venue": "W", "teamInfo": [{"name": "A0"}, {"name": "B0"}], "score": None}])]
    src = tmp_path / "src"
    table, ckpt = str(tmp_path / "state"), str(tmp_path / "ckpt")
    live_state.land_responses(spark.createDataFrame(newer, LIVE_RESPONSE), str(src / "a"), files=1)
    q = live_state.start_live_state(spark, str(src / "*"), table, ckpt, available_now=True)
    q.awaitTermination()
    live_state.land_responses(spark.createDataFrame(older, LIVE_RESPONSE), str(src / "b"), files=1)
    q = live_state.start_live_state(spark, str(src / "*"), table, ckpt, available_now=True)
    q.awaitTermination()
    row = live_state.read_live_state(spark, table).collect()[0]
    assert row.status == "Live"  # the newer snapshot stays
    assert (row.team1, row.venue) == ("A0", "W")  # first seen by event time


def test_cache_stream_evicts_by_ttl(spark, tmp_path):
    """Snapshots over two hours in four files: the cache keeps only matches
    written in the last 600 s, and the stream's state is evicted to match."""
    from crease.streaming import live_cache

    base = dt.datetime(2024, 5, 1, 18, 0)
    rows = []
    for i in range(40):  # one snapshot every 3 minutes, matches c0..c9 in turn
        t = base + dt.timedelta(minutes=3 * i)
        m = {"id": f"c{i % 10}", "status": "Live", "venue": "V", "teamInfo": [{"name": "A Reds"}, {"name": "B Blues"}],
             "score": [{"r": i, "w": 1, "o": 5.0}]}
        rows.append((t, i, [m]))
    responses = spark.createDataFrame(rows, LIVE_RESPONSE)
    src = live_state.land_responses(responses, str(tmp_path / "landing"), files=4)
    table, ckpt = str(tmp_path / "cache"), str(tmp_path / "ckpt")
    q = live_cache.start_live_cache(spark, src, table, ckpt, max_files_per_trigger=1, available_now=True)
    q.awaitTermination()
    got = sorted((r.cache_key, r.payload) for r in live_cache.read_live_cache(spark, table).collect())
    valid, _ = live.validate_snapshots(live.snapshot_rows(responses))
    want = sorted((r.cache_key, r.payload) for r in live.cache_entries(live.live_rows(valid)).collect())
    # last write at 19:57; alive: written after 19:47 -> 19:48, 19:51, 19:54, 19:57
    assert got == want and len(got) == 4
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    # each 30-minute file touches all 10 matches; once the watermark moves on,
    # state keeps only the last two 10-minute windows (writes 19:42 ... 19:57)
    assert states and states[-1] == 6 and min(states) < max(states)


def test_text_source_parse_equals_json_source(spark, tmp_path):
    """The from_json path (a Kafka value column, here the text source) gives
    the same state as the JSON file source; a garbled line drops out."""
    responses = spark.createDataFrame(RESPONSES, LIVE_RESPONSE)
    src = live_state.land_responses(responses, str(tmp_path / "landing"), files=2)
    with open(f"{src}/garbled.txt", "w") as fh:
        fh.write('{"fetched_at": "2024-05-01T19:00:00.000000", "seq": 99, "data": [{"id": \n')
    table = str(tmp_path / "state")
    q = live_state.start_live_state(spark, src, table, str(tmp_path / "ckpt"), available_now=True, source_format="text")
    q.awaitTermination()
    assert _rows(live_state.read_live_state(spark, table)) == _rows(_batch_state(responses))


def test_live_job_keeps_every_reject(spark, tmp_path):
    """The three streams over one landing folder: stored state as in batch,
    rejects with text and reason, nothing twice after a restart."""
    from crease.plans import live as job

    responses = spark.createDataFrame(RESPONSES, LIVE_RESPONSE)
    src = live_state.land_responses(responses, str(tmp_path / "landing"), files=3)
    garbled = '{"fetched_at": "2024-05-01T19:00:00.000000", "seq": 99, "data": [{"id": '
    with open(f"{src}/garbled.json", "w") as fh:
        fh.write(garbled + "\n")
    root = str(tmp_path / "root")
    for _ in range(2):
        for query in job.start_live(spark, src, root, max_files_per_trigger=1, available_now=True).values():
            query.awaitTermination()
    where = job.publish_live(spark, root, str(tmp_path / "published"))
    assert _rows(spark.read.parquet(where["live_matches"])) == _rows(_batch_state(responses))
    got = spark.table("ipl_live_quarantine").collect()
    want = [((r.match_id or ""), r.reason) for r in live.rejected_snapshots(responses).collect()] + [("", "unparsable response")]
    assert sorted(((r.match_id or ""), r.reason) for r in got) == sorted(want)
    assert [r.raw for r in got if r.reason == "unparsable response"] == [garbled]
    assert spark.table("ipl_live_report").count() == spark.table("ipl_live_matches").count()

"""End to end: the batch job over documents landed from the sf0.01 tables
(JSON -> bronze -> silver -> gold) gives the same five statistics as the
registered queries, which are checked against DuckDB."""

from __future__ import annotations

from conftest import SF_CHECK

from crease.plans import pipeline
from crease.plans.queries import QUERIES, land_documents


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pipeline_statistics_equal_registered_queries(spark, tmp_path):
    path, glob = land_documents(spark, SF_CHECK)
    res = pipeline.run_pipeline(spark, path, str(tmp_path / "out"), multi_line=False, glob=glob)
    assert res.quarantine.count() == 0
    for name in ("team_stats", "player_batting_stats", "player_bowling_stats", "season_trends", "venue_stats"):
        got = spark.read.parquet(res.saved[name])
        want = QUERIES[name](spark, SF_CHECK)
        assert _rows(got.select(*want.columns)) == _rows(want), name

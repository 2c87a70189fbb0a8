"""Plan properties of every registered batch query: no cross joins, no Python
evaluation, column pruning at the scans."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

# queries that land files or run a stream first; their read side is covered elsewhere
SIDE_EFFECTS = {"incremental_load", "incremental_stats", "quality_checks", "schema_drift", "live_cache_history", "live_cache_intervals", "live_cache_sessions", "live_quarantine_replay", "live_overs_stream", "nested_flatten", "json_scan", "corrupt_quarantine", "id_uniqueness", "pipeline_stats", "parquet_round_trip", "live_matches_stream", "live_cache_stream", "live_quarantine_stream"}
BATCH = sorted(k for k in set(E.queries()) - SIDE_EFFECTS if not re.match(r"op\d+_|pipeline$", k))
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_cross_join_or_python(spark, name, capsys):
    E.queries()[name](spark, SF_SMALL).explain("formatted")
    plan = capsys.readouterr().out
    for op in FORBIDDEN:
        assert op not in plan, (name, op)
    # scans are pruned: columns no batch query uses never reach a reader
    for schema in re.findall(r"ReadSchema: struct<(.*)>", plan):
        for unused in ("l_extendedprice", "l_shipdate", "o_orderpriority"):
            assert unused not in schema, (name, schema)

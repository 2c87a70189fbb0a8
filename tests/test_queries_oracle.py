"""Every registered query against its DuckDB oracle on the provided sf0.01
tables: same row count, same column names, same values (order-insensitive)."""

from __future__ import annotations

import re

import pytest
from conftest import SF_CHECK
from oracle import compare, duck

import __spark_entry__ as E

# those of the training-data subpackage, if it is there, have tests of their own
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in E.queries().items() if not OWN.match(k)}
ORACLE = {k: v for k, v in E.oracle_sql().items() if not OWN.match(k)}


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_CHECK)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


ORDERED = ["team_stats_sorted", "player_batting_sorted", "player_bowling_sorted", "season_trends_sorted", "venue_stats_sorted",
           "top_run_scorers", "top_bowlers", "team_performance", "season_listing", "top_venues"]


@pytest.mark.parametrize("name", ORDERED)
def test_order_matches_oracle(spark, con, name):
    """The rows come in the order of the oracle's ORDER BY."""
    got = QUERIES[name](spark, SF_CHECK)
    rel = con.sql(ORACLE[name])
    rows = rel.fetchall()
    at = [rel.columns.index(c) for c in got.columns]
    assert rows and [tuple(r) for r in got.collect()] == [tuple(r[i] for i in at) for r in rows]


def test_sql_filter_decides(spark):
    """Some teams pass the filter and some do not."""
    assert 0 < QUERIES["sql_filter"](spark, SF_CHECK).count() < QUERIES["team_titles"](spark, SF_CHECK).count()

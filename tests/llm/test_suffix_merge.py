"""The merge across shards decides by bytes, on given tables too, and the query
equals its SQL."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from crease.llm import suffix_dedup
from crease.llm.queries import ORACLE_SQL, QUERIES
from oracle import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_query_equals_its_sql(spark, con):
    r = compare(spark, con, "op9", QUERIES["op9_suffix_dedup"], ORACLE_SQL["op9_suffix_dedup"], SF)
    assert r["spark_rows"] == 1000 and r["values_match"], r


def test_merge_runs_on_the_given_table(spark, con, monkeypatch):
    """With small shards anchors are spread, candidates met and confirmed; the result is that of the SQL."""
    seen = {}
    staged = suffix_dedup.staged

    def counting(df, name):
        out = staged(df, name)
        if name in ("spread", "candidates"):
            seen[name] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "staged", counting)

    def query(spark, folder):
        found = suffix_dedup.remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"), shard_windows=4).drop("spans")
        return found.withColumn("has_repeats", F.col("n_removed") > 0)

    r = compare(spark, con, "op9", query, ORACLE_SQL["op9_suffix_dedup"], SF)
    assert r["values_match"], r
    assert seen["spread"] > 0 and seen["candidates"] > 0


@pytest.mark.parametrize("shard_windows", [2048, 3])
def test_colliding_hashes_remove_nothing_more(spark, monkeypatch, shard_windows):
    """With string hashes of four bits nearly everything is a candidate; bytes decide."""
    strings = suffix_dedup._strings

    def colliding(x, length):
        return strings(x, length) & np.uint64(15)

    monkeypatch.setattr(suffix_dedup, "_strings", colliding)
    passage = "".join(chr(97 + (k * k + 3 * k) % 23) for k in range(90))
    texts = [f"{k}{'xyz'[k % 3] * (k % 7)}{passage[k % 5:]}{chr(65 + k % 26) * (k % 11)}{k * 7919}" for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs, length=60, shard_windows=shard_windows).collect()}
    where = {}
    for k, t in enumerate(texts):
        for p in range(len(t) - 59):
            where.setdefault(t[p : p + 60], []).append((k, p))
    gone = {k: set() for k in range(len(texts))}
    for places in where.values():
        if len(places) > 1:
            for k, p in places:
                gone[k].update(range(p, p + 60))
    assert got == {k: len(g) for k, g in gone.items()} and any(got.values())

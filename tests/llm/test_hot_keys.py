"""Keys that hold a large share of the rows: joins in place, components around
hubs, WARC shards beyond the number of shuffle partitions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from crease.llm import common, components, warc
from crease.session import scratch_path


def test_hot_join_equals_a_join(spark):
    rows = spark.createDataFrame([(7 if k % 3 else k % 500, k) for k in range(9000)], "key long, v long")
    by_key = spark.createDataFrame([(k, f"n{k}") for k in range(0, 500, 2)] + [(7, "seven")], "key long, name string")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = common.hot_values(sizes, "key", "n")
    assert hot == [7]
    got = sorted(tuple(r) for r in common.hot_join(rows, by_key, ["key"], "key", hot).collect())
    assert got == sorted(tuple(r) for r in rows.join(by_key, "key").collect()) and len(got) > 6000
    assert common.hot_values(sizes.limit(0), "key", "n") == []


@pytest.mark.parametrize("check", [0, 10**9])
def test_components_around_hubs(spark, monkeypatch, check):
    monkeypatch.setattr(components, "HUB_CHECK", check)
    rng = random.Random(8)
    links = [(0, k) for k in range(1, 2500)] + [(9_000 + k, 9_001 + k) for k in range(60)] + [(rng.randrange(20_000, 20_400), rng.randrange(20_000, 20_400)) for _ in range(300)]
    links += [(2400, 9_030), (5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent) if x != find(x)}


def test_a_task_for_each_shard(spark):
    """Many more shards than shuffle partitions: every shard is a file of its own, in key order."""
    rows = [(k, f"http://h/{k}", f"{k} " * 400) for k in range(300)] + [(k, None, "same " * 300) for k in range(300, 400)] + [(None, None, None)] * 3
    folder = scratch_path(spark, "test-warc-shards")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_warc(pages, folder, shard_bytes=20_000)
    files = manifest.count()
    assert files >= 3 * common.shuffle_partitions(spark)
    got = warc.read_warc(spark, folder).collect()
    assert len(got) == len(rows) and all(r["intact"] for r in got)
    assert sum(r["record_type"] == "revisit" for r in got) == 99 and {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {399}

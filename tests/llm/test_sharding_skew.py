"""Byte balance with heavy groups beyond the number of bundles."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from crease.llm import sharding


@pytest.mark.parametrize("share", [0.10, 0.33])
@pytest.mark.parametrize("copies", [1, 2000])
def test_heavy_groups_beyond_the_bundles_are_evened_out(spark, share, copies):
    n = 22_000  # distinct texts; more than bucket_groups
    text = F.concat_ws(" ", F.col("id").cast("string"), F.repeat(F.lit("x"), (F.pmod(F.xxhash64("id"), F.lit(400))).cast("int")))
    small = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    rest = small.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    heavy = int(rest * share / (1 - share)) // copies
    big = spark.range(copies).select((F.col("id") + n).alias("doc_id"), F.repeat(F.lit("y"), F.lit(heavy - 1)).alias("text"))
    got = sharding.shard_by_bytes(small.unionByName(big)).groupBy("shard").agg(F.sum("size").alias("bytes"), F.max(F.col("doc_id") >= n).alias("heavy")).collect()
    sums = {r["shard"]: r["bytes"] for r in got}
    assert len(sums) == 8 and Counter(r["heavy"] for r in got)[True] == 1
    if share > 1 / 8:  # nothing joins a group beyond a shard's fair part; the others share the rest
        alone = next(r["shard"] for r in got if r["heavy"])
        assert sums.pop(alone) == heavy * copies
    assert max(sums.values()) - min(sums.values()) < 0.001 * max(sums.values())

"""The corpus pipeline: its stages against plain versions, and its edge cases."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp

from crease.llm import decontamination
from crease.session import scratch_path

from .test_operators import DOCS, SF, components, none, odd, plain_fingerprint, plain_hits  # noqa: F401


def reread(spark, df, name):
    path = scratch_path(spark, f"test-{name}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    one = reread(spark, cp.identify_language(spark, docs, SF), "one")
    assert one.columns == docs.columns
    kept = {r["doc_id"] for r in one.collect()}
    assert all(not any(c.isalpha() for c in rows[k]["text"] or "") for k in set(rows) - kept)
    two = reread(spark, cp.drop_near_copies(spark, one, SF), "two")
    ids = sorted(kept)
    group = components([plain_fingerprint(rows[k]["text"]) for k in ids], lambda a, b: (a ^ b).bit_count() <= 4)
    assert two.columns == docs.columns and sorted(r["doc_id"] for r in two.collect()) == sorted({ids[g] for g in group})
    three = reread(spark, cp.remove_benchmark(spark, two, SF), "three")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    known = {w for _, t in items for w in decontamination.words_of(t)}
    clean = set()
    for r in two.collect():
        few = [w if w in known else "-" for w in decontamination.words_of(r["text"])]  # faster to compare
        if not plain_hits(" ".join(few).replace("-", "zzzz"), items):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in three.collect()} == clean
    four = reread(spark, cp.mix(spark, three, SF), "four")
    copies = Counter(r["doc_id"] for r in four.collect())
    assert four.columns == docs.columns and set(copies) == clean and max(copies.values()) == 2
    five = cp.shard(spark, four, SF).collect()
    assert Counter(r["doc_id"] for r in five) == copies


def test_odd_rows_and_empty_tables(spark, odd, none):  # noqa: F811
    for name, stage in cp.STAGES:
        out = reread(spark, stage(spark, odd, SF), f"odd-{name}")
        assert name == "sharding" or out.columns == odd.columns
        assert reread(spark, stage(spark, none, SF), f"none-{name}").count() == 0
    left = cp.drop_near_copies(spark, odd, SF).collect()
    assert len({plain_fingerprint(r["text"]) for r in left}) == len(left)
    assert Counter(r["doc_id"] for r in left)[4] == 1

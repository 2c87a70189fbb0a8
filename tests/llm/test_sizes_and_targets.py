"""Results that must not change with size: the mixing target on any shares, more
than 64 languages, a rare class of urls, a table without labels."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from crease.llm import language_id, mixing, url_filter
from crease.llm.queries import QUERIES, URL_RULES

from .test_operators import DOCS


def entropy_share(weights):
    return -sum(w * math.log(w) for w in weights if w > 0) / math.log(len(weights))


@pytest.mark.parametrize("sizes", [[1000, 990, 1010, 1005, 995], [5000, 10, 10, 10], [300] * 3 + [299], [7, 900, 901]])
@pytest.mark.parametrize("max_classes", [1 << 20, 1])
def test_target_entropy_on_flat_and_sharp_shares(spark, monkeypatch, sizes, max_classes):
    """The exponent falls below 1 or rises above it until the target is met, from
    sums on the driver or on the executors."""
    monkeypatch.setattr(mixing.Shares.__init__, "__defaults__", (max_classes,))
    rows = [(100 * s + k, "w " * (n // 5), f"s{s}") for s, n in enumerate(sizes) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs, budget_share=1.0, target_entropy=0.9).collect()
    weights = {r["source"]: r["weight"] for r in got}
    assert abs(sum(weights.values()) - 1) < 1e-9
    share = entropy_share(weights.values())
    if sizes == [300] * 3 + [299]:  # three alike hold log 3 / log 4 = 0.79 of the entropy at least
        assert abs(share - 0.9) < 1e-6
    assert all(r["target_met"] for r in got) and abs(share - 0.9) < 1e-6
    tokens = {f"s{s}": 5 * (n // 5) for s, n in enumerate(sizes)}
    a = got[0]["exponent"]
    top = max(tokens.values())
    z = sum((t / top) ** a for t in tokens.values())
    for s, t in tokens.items():
        assert weights[s] == pytest.approx((t / top) ** a / z, rel=1e-9)


def test_target_out_of_reach_is_told(spark):
    """Equal sources keep their shares, and a column says that the target is missed."""
    rows = [(k, "a b c", f"s{k % 4}") for k in range(40)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), budget_share=1.0, target_entropy=0.9).collect()
    assert {r["exponent"] for r in got} == {1.0} and not any(r["target_met"] for r in got) and {r["n_copies"] for r in got} == {1}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_mixes_the_given_table(spark, folder):
    rows = QUERIES["op1_mixing"](spark, folder).select("source", "weight", "exponent", "target_met", "n_copies").collect()
    weights = {r["source"]: r["weight"] for r in rows}
    assert abs(entropy_share(weights.values()) - 0.95) < 1e-6 and all(r["target_met"] for r in rows)
    assert rows[0]["exponent"] > 1 and len({r["n_copies"] for r in rows}) > 1


def test_seventy_languages(spark):
    """Every language has words of its own; all are told apart, and the filter's
    masks hold every profile n-gram's languages."""
    rng = random.Random(70)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, k = [], 0
    for lang in range(70):
        own = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(12)]
        for _ in range(6):
            rows.append((k, " ".join(rng.choices(own, k=40)), f"l{lang:02d}" if k % 6 else None, str(lang), 0, 0, "", 0))
            k += 1
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.train(docs, profile_grams=60)
    assert len(model.languages) == 70 and model.slots.shape[1] == 2
    got = language_id.predict(docs, model).collect()
    assert sum(r["lang_pred"] == f"l{int(r['source']):02d}" for r in got) >= 0.99 * len(got)
    profiles = {}
    for r in docs.filter("lang is not null").collect():
        profiles.setdefault(r["lang"], set()).update(language_id.ngrams(r["text"], 3).tolist())
    built = language_id.LanguageFilter.build({n: np.sort(np.array(sorted(g), dtype=np.uint64)) for n, g in profiles.items()}, 3)
    for bit, name in enumerate(built.languages):
        masks = built.members(np.array(sorted(profiles[name]), dtype=np.uint64))
        assert all(m >> bit & 1 for m in masks), name
    other = np.array([g for n, p in profiles.items() for g in p if g not in profiles["l05"]], dtype=np.uint64)
    bit = built.languages.index("l05")
    wrong = np.mean([m >> bit & 1 for m in built.members(other)])
    assert wrong <= 3 * built.false_positives()[bit] + 0.01


def test_rare_class_stays_in_the_sample(spark):
    """400 blocked urls among four million decided ones: all are drawn."""
    pages = spark.range(4_000_000).select(
        F.when(F.col("id") % 10_000 == 0, F.concat(F.lit("http://a.com/de/p"), F.col("id").cast("string")))
        .otherwise(F.concat(F.lit("http://b.org/x"), F.col("id").cast("string"))).alias("url")
    )
    n = {r["blocked"]: r["count"] for r in url_filter.labelled_by_rules(pages, URL_RULES).groupBy("blocked").count().collect()}
    assert n[True] == 400 and 1600 < n[False] < 2400


def test_pipeline_without_labels_keeps_texts_with_letters(spark):
    rows = [(1, "some words", None), (2, None, None), (3, "123 ???", None), (4, "日本語", None), (None, "é", None), (6, "", None)]
    docs = spark.createDataFrame([(k, t, lang, "s", 1, 0, "", 0) for k, t, lang in rows], DOCS)
    kept = cp.identify_language(spark, docs, "/root/testdata/sf0.001")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 4, None}

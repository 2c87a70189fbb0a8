"""Texts with fewer words than the benchmark item that they copy."""

from __future__ import annotations

import random
from collections import Counter

from crease.llm import decontamination

from .test_operators import words


def plain_short_hits(text, items, threshold=0.8):
    """Brute force: the most similar window of the item's size, or the whole text if it is shorter."""
    w, out = decontamination.words_of(text), {}
    grams = lambda x, k: Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1))
    for item, t in items:
        v = decontamination.words_of(t)
        k = min(5, len(v))
        windows = [(s, w[s : s + len(v)]) for s in range(max(1, len(w) - len(v) + 1))]
        similar, start, n = max((decontamination.weighted_similarity(grams(x, k), grams(v, k)), -s, len(x)) for s, x in windows)
        if similar >= threshold:
            out[item] = (-start, -start + n, round(similar, 9))
    return out


def test_shortened_copies_match_brute_force(spark):
    rng = random.Random(21)
    items = [(k, words(rng, n)) for k, n in enumerate([3, 5, 6, 12, 40, 60, 200])]
    texts = ["", "a", words(rng, 30)]
    for _, t in items:
        w = t.split()
        for cut in (0, 1, 3, len(w) // 10, len(w) // 5, len(w) // 3):
            texts += [" ".join(w[cut:]), " ".join(w[: len(w) - cut]), " ".join([*w[cut:], "tail"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(k, i): v for k, t in enumerate(texts) for i, v in plain_short_hits(t, items).items()}
    got = decontamination.find_contamination(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]): (r["start_word"], r["end_word"], round(r["similarity"], 9)) for r in got} == want
    whole = " ".join(items[4][1].split()[:37])
    assert any(texts[k] == whole and i == 4 for k, i in want)  # 37 of 40 words
    left = {r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()}
    assert left == set(range(len(texts))) - {k for k, _ in want}

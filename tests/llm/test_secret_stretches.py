"""Secrets behind an ordinary name or path, and the stretches they are found by."""

from __future__ import annotations

import random
import string
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from crease.llm import secret_scan

SF = "/root/testdata/sf0.01"
NAMES = ["", "client_credential=", "//hooks.example.com/services/", "//api.example.com/services/incoming/notifications/channel/"]


@pytest.fixture(scope="module")
def models(spark):
    return secret_scan.train(spark.read.parquet(f"{SF}/documents.parquet"))


def drawn(rng, n):
    return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))


def markov(text, models):
    return [text[a:b] for a, k, b in secret_scan.spans_of(text, models, secret_scan.MIN_SCORE, secret_scan.MIN_MEAN) if k == 3]


@pytest.mark.parametrize("name", NAMES)
def test_an_ordinary_name_does_not_hide_a_secret(models, name):
    rng = random.Random(3)
    for n in (20, 24, 32, 40):
        secrets = [drawn(rng, n) for _ in range(100)]
        assert sum(markov(f"see {name}{s} here.", models) == [s] for s in secrets) >= 95
    assert markov(f"see {name} here", models) == []


def test_two_secrets_around_a_path_are_both_covered(models):
    rng = random.Random(4)
    for _ in range(50):
        one, two = drawn(rng, 40), drawn(rng, 40)
        found = markov(f"{one}/incoming/notifications/channel/settings/of/the/services/{two}", models)
        assert all(any(s in f for f in found) for s in (one, two))


def test_stretches_equal_a_plain_search():
    rng = np.random.default_rng(5)

    def plain(g, at):  # the largest stretch (the first, and the shortest of it), then both sides of it
        if not len(g):
            return []
        best = max(((g[a:b].sum(), -a, -b) for a in range(len(g)) for b in range(a + 1, len(g) + 1)))
        a, b = -best[1], -best[2]
        return plain(g[:a], at) + [(at + a, at + b)] + plain(g[b:], at + b) if best[0] > 0 else []

    for n in [1, 2, 5, 9, 14] * 30:
        g = rng.normal(size=n)
        want = [(a, b) for a, b in plain(g, 0) if g[a:b].sum() >= 0.5]
        assert secret_scan.best_stretches(g, 0.5) == want


def _digits(rng, n):
    return "".join(rng.choice(string.digits) for _ in range(n))


ORDINARY = {
    "uuid": lambda rng: str(uuid.UUID(int=rng.getrandbits(128))),
    "card": lambda rng: _digits(rng, 16),
    "card in fours": lambda rng: "-".join(_digits(rng, 4) for _ in range(4)),
    "time": lambda rng: f"20{rng.randrange(10, 30)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}T{_digits(rng, 2)}.{_digits(rng, 2)}.{_digits(rng, 6)}Z",
    "version": lambda rng: f"release-{rng.randrange(20)}.{rng.randrange(20)}.{rng.randrange(200)}-rc{rng.randrange(9)}.build{rng.randrange(10_000)}",
}
LONG_NAMES = [
    "getUserAccountSettingsFromDatabaseConnectionPool", "DEFAULT_MAXIMUM_CONNECTION_TIMEOUT_SECONDS", "parseHttpRequestHeaderFieldValue",
    "sha256-abcdefghijklmnopqrstuvwxyz", "user_profile_image_url_v2_final", "com.example.project.module.ServiceImpl",
    "AbstractSingletonProxyFactoryBean", "IMG_20240115_123456789.jpg",
]


@pytest.mark.parametrize("kind", ORDINARY)
def test_ordinary_strings_with_digits_are_left_alone(models, kind):
    rng = random.Random(6)
    assert sum(bool(markov(f"see {ORDINARY[kind](rng)} here", models)) for _ in range(300)) <= 6


def test_long_names_are_left_alone(models):
    assert [n for n in LONG_NAMES if markov(f"call {n} now", models)] == []


def test_held_out_recall_and_false_alarms(spark):
    """Trained on two thirds of the documents, counted on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    models = secret_scan.train(docs.filter(~third))
    got = {r["random"]: r for r in secret_scan.labelled_counts(docs.filter(third), models).collect()}
    assert got[True]["n"] >= 20 and got[True]["n_found"] >= 0.9 * got[True]["n"]
    assert got[False]["n"] > 1000 and got[False]["n_found"] <= 0.01 * got[False]["n"]

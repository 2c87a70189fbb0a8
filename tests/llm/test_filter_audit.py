"""The filter audit against a plain recount of every order, its SQL, and its
defined results for nulls, repeated rows and empty tables."""

from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from crease.llm import filter_audit
from crease.llm.queries import ORACLE_SQL, QUERIES
from oracle import compare, duck

DOCS = "doc_id long, text string, lang string, mask int, part string, quality int, first long"
LABELS = "doc_id long, quality int, toxic int, lang string"


def plain_audit(rows, labels):
    """{(part, order, step): counts} by applying the filters of each order one after another."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    smallest = {}
    for d, t, _ in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    docs = defaultdict(list)
    for d, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and smallest[t] < d,
        }
        docs[lang or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, ds in docs.items():
        shapley = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            left = ds
            for step, f in enumerate(order, 1):
                gone, kept = [x for x in left if x[0][f]], [x for x in left if not x[0][f]]
                out[part, "".join(order), step] = [
                    len(kept), len(gone), sum(x[0][f] for x in ds) - len(gone),
                    sum(x[0][f] and sum(x[0].values()) == 1 for x in ds), sum(x[1] for x in gone), sum(x[2] for x in gone),
                ]
                shapley[f] += len(gone)
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for k in range(300):
        n = rng.choice([0, 5, 99, 100, 101, 130])
        pool = [word() for _ in range(max(1, int(n * rng.choice([0.5, 0.8, 1.2]))))]
        w = [rng.choice(pool) for _ in range(n)]
        if rng.random() < 0.3:
            w = [x.upper() if rng.random() < 0.12 else x for x in w]
        if rng.random() < 0.3:
            w.append(rng.choice(["#", "50%", "a|b"]))
        out.append((k, rng.choice([" ", "\t", "  \n"]).join(w), rng.choice(["en", "de", None, ""])))
    out += [(k, out[3][1], "en") for k in range(400, 480)]  # a group of copies
    out += [(None, out[3][1], "en"), (None, None, None), (500, None, "en"), (501, "", "de"), (5, out[5][1], "en"), (5, "other", "fr")]
    out += [(502, "É" * 90 + "A" * 10, "en"), (503, "É" * 89 + "A" * 10 + "\U0001f600", "en"), (504, " " + "x" * 200_000, "en")]
    return out


def test_every_order_against_a_plain_recount(spark, rows):
    labels = [(k, k % 3 and 1, int(k % 7 == 0)) for k in range(0, 510, 2)] + [(4, 1, None), (None, 1, 1), (999, 1, 1), (8, 0, 1), (8, 1, 0)]
    docs = spark.createDataFrame([(*r, 1, "x", 0, 9) for r in rows], DOCS).repartition(5)
    got = filter_audit.audit_filters(docs, spark.createDataFrame([(*r, "zz") for r in labels], LABELS)).collect()
    want = plain_audit(rows, labels)
    assert len(got) == len(want) == 600 * 4
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == want


def test_walk_keeps_every_state():
    cells = np.random.default_rng(1).integers(0, 50, (32, 3))
    states = filter_audit.survivors(cells)
    for s in range(32):
        assert (states[s] == cells[[m for m in range(32) if not m & s]].sum(axis=0)).all()


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(docs, labels).collect() == []
    one = spark.createDataFrame([(None, None, None, 1, "x", 0, 0)], DOCS)
    rows = filter_audit.audit_filters(one, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}
    assert {r["kept"] for r in rows if r["step"] == 5} == {0}


def test_query_equals_its_sql(spark):
    r = compare(spark, duck("/root/testdata/sf0.01"), "op11", QUERIES["op11_filter_audit"], ORACLE_SQL["op11_filter_audit"], "/root/testdata/sf0.01")
    assert r["spark_rows"] == 2400 and r["values_match"], r

"""The conversation trie against a plain one, its SQL, and list ranking on
lists of every kind."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from crease.llm import conversation_trie as trie
from crease.llm.queries import ORACLE_SQL, QUERIES
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, conv long, d string, pos int"


def plain_trie(rows):
    """{(conv_id, depth): (parent, n, children, leaves, saved, ends)}"""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = turns.get(first, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)

    below = {}
    for key in sorted(members, key=len, reverse=True):
        kids = children[key]
        below[key] = (
            sum(below[k][0] for k in kids) if kids else 1,
            sum(below[k][1] for k in kids) + ((len(members[key]) - 1) * len(key[-1][1]) if key else 0),
        )
    out = {}
    for key, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(key))
        out[min(m), len(key)] = (min(members[key[:-1]]) if key else None, len(m), len(children[key]), *below[key], hashlib.sha256(ends.encode()).hexdigest())
    return out


def by_node(rows):
    return {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in rows}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    out = []
    for c in [*range(0, 130), *range(250, 290), 5_000, 5_001, 123_456_789_012, -7, -100]:
        n = rng.choice([0, 1, 2, 3, 5, 6, 7, 9])
        for turn in range(n):
            text = rng.choice(["hi", "yes", "", None, "é\U0001f600"]) if turn < 3 else f"{rng.randrange(4)}"
            out.append((c, turn if turn else rng.choice([None, -1, 0]), rng.choice(["user", "assistant", None]), text))
        if not n:
            out.append((c, 1, "user", "only"))
    long = [(77_777, k, "user", f"turn {k}") for k in range(900)]  # one conversation with most of the rows
    out += long + [(77_778, k, "user", f"turn {k}") for k in range(800)]
    out += [(300 + k, 1, "user", "same") for k in range(60)]  # many copies
    out += [(5, 2, "user", "twice"), (5, 2, "user", "twice"), (5, 2, "a", "z"), (None, 1, "user", "lost"), (None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(6)


@pytest.mark.parametrize("task_arcs", [trie.TASK_ARCS, 300, 60])
def test_trie_equals_a_plain_one(table, rows, task_arcs):
    """In one task, over shorter and shorter lists, and by pointer jumping."""
    got = trie.conversation_trie(table, task_arcs).collect()
    want = plain_trie(rows)
    assert len(got) == len(want)
    assert by_node(got) == want


def test_turnless_conversations(spark):
    """A conversation shorter than its h whose block begins nowhere has no turns."""
    lone = [c for c in range(10_001, 10_100) if zlib.crc32(str(c).encode()) % 6 > 1][:3]
    rows = [(c, 1, "user", "x") for c in lone]
    got = trie.conversation_trie(spark.createDataFrame([(*r, 0, "", 0) for r in rows], TURNS)).collect()
    assert by_node(got) == plain_trie(rows) and len(got) == 1 and got[0]["n_convs"] == 3 and got[0]["n_leaves"] == 1


def test_empty_and_null_tables(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x", 1, "", 1)], TURNS)).collect() == []


@pytest.mark.parametrize("task_arcs", [10_000, 200, 20])
def test_list_ranking_of_shuffled_lists(spark, task_arcs):
    """Lists without any locality: what ranges cannot shorten is ranked by jumping."""
    rng = random.Random(task_arcs)
    order = [(rng.randrange(-50, 50), k) for k in range(800)]
    rng.shuffle(order)
    weight = [rng.randrange(9) for _ in order]
    arcs = [(*a, *(order[i + 1] if i + 1 < len(order) else (None, None)), weight[i], 1) for i, a in enumerate(order)]
    df = spark.createDataFrame(rng.sample(arcs, len(arcs)), "c long, s long, nc long, ns long, w long, one long")
    got = {(r["c"], r["s"]): (r["w_before"], r["one_before"]) for r in trie.list_rank(df, ["w", "one"], task_arcs).collect()}
    assert got == {a: (sum(weight[:i]), i) for i, a in enumerate(order)}


def test_hot_parent_and_long_list_of_ends(spark, monkeypatch):
    """One node with most children, and one where most conversations end."""
    monkeypatch.setattr(trie, "ID_CHUNK", 7)
    monkeypatch.setattr(trie, "TASK_ARCS", 1000)
    rows = [(k * 100, t, "user", x) for k in range(700) for t, x in enumerate(["start", f"own {k}"][: 1 + k % 2])]
    got = trie.conversation_trie(spark.createDataFrame([(*r, 0, "", 0) for r in rows], TURNS), 1000).collect()
    assert by_node(got) == plain_trie(rows)


def test_query_equals_plain_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_trie"](spark, SF)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert by_node(got.collect()) == plain_trie(rows)
    r = compare(spark, duck("/root/testdata/sf0.01"), "op13", QUERIES["op13_conversation_trie"], ORACLE_SQL["op13_conversation_trie"], "/root/testdata/sf0.01")
    assert r["spark_rows"] == r["oracle_rows"] > 100 and r["values_match"], r

"""Prefix trie of conversations by an Euler tour.

Every distinct sequence of first turns is a node.  Conversations are ordered and
numbered by running sums over sorted ranges, and the key of a prefix is the running
sum of hashes of (place, turn), so a node is a group of equal keys.  A node becomes
two arcs, enter and exit; each arc knows its successor in the tour.  The tour is
list-ranked: ranges of arcs are walked where the list stays inside them, each such
stretch becomes one arc of a shorter list, and so on until a bounded list is left;
sums go back down.  What a subtree holds is the difference of the sums at its two
arcs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import run_bounds, shuffle_partitions, staged
from crease.llm.scans import next_values, running_sums

BITS = 61  # of each of the two sums that make a key
MASK = (1 << BITS) - 1
TASK_ARCS = 200_000  # arcs that a task holds
HOT_KEYS = 200  # a parent with more than this share of all nodes is hot: there are fewer such
ID_CHUNK = 4096  # conversation ids in a row of an ends list


# --- ordering and rebuilding ---------------------------------------------------------


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, a, b, chars), a row per turn: its place from 1 in its conversation
    and two hashes of (role, text).

    Turns are ordered by number, null first; those that share a number by role and
    then by hash.  Null roles and texts are empty; rows without a conversation id
    belong to no conversation and are left out; other columns are not read.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, F.lit(2), role).alias("b"), F.length(text).cast("long").alias("chars"),
        F.lit(1).cast("long").alias("pos"),
    )
    placed = running_sums(rows, ["conv", "turn", "role", "a", "b"], ["pos"], segment="conv", name="turns")
    return placed.select("conv", F.col("pos_upto").alias("pos"), "a", "b", "chars")


def rebuilt_turns(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(rows (conv, d, a, b, chars), conversations (conv)) of rebuilt conversations:
    the first h turns of the conversation that begins the block of ``block`` ids,
    then the own turns after the first h, h = crc32 of the id modulo ``most``."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    first = F.col("conv") - F.col("conv") % block
    known = turns.filter("pos = 1").select("conv")
    heads = turns.filter((F.col("conv") == first) & (F.col("pos") < most)).withColumnRenamed("conv", "of")  # fewer than `most` of each
    begun = known.select("conv", first.alias("of"), h.alias("h")).join(heads, "of").filter("pos <= h")
    rows = begun.select("conv", F.lit(0).alias("own"), "pos", "a", "b", "chars").unionByName(
        turns.filter(F.col("pos") > h).select("conv", F.lit(1).alias("own"), "pos", "a", "b", "chars")
    )
    placed = running_sums(rows.withColumn("d", F.lit(1).cast("long")), ["conv", "own", "pos"], ["d"], segment="conv", name="rebuilt")
    return placed.select("conv", F.col("d_upto").alias("d"), "a", "b", "chars"), known


# --- nodes ----------------------------------------------------------------------------


def _chunks(batches):
    """Lists of ids of each run of (d, a, b), in pieces of ID_CHUNK."""
    for batch in batches:
        if not batch.num_rows:
            continue
        d, a, b, conv = (batch.column(c).to_numpy() for c in ("d", "a", "b", "conv"))
        starts, lens = run_bounds(d, a, b)
        starts = np.concatenate([np.arange(s, s + n, ID_CHUNK) for s, n in zip(starts.tolist(), lens.tolist())])
        ends = np.append(starts[1:], len(d))
        names = list(map(str, conv.tolist()))
        lists = [",".join(names[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
        columns = [pa.array(d[starts]), pa.array(a[starts]), pa.array(b[starts]), pa.array(conv[starts]), pa.array(lists)]
        yield pa.RecordBatch.from_arrays(columns, names=["d", "a", "b", "conv", "ids"])


def _digests(batches):
    """SHA-256 of the joined pieces of each run of (d, a, b), one piece at a time."""
    key = digest = None
    out: list[tuple] = []

    def flush():
        columns = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["d", "a", "b", "ends"])

    for batch in batches:
        for *k, ids in zip(*[batch.column(c).to_pylist() for c in ("d", "a", "b", "ids")]):
            if k == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, digest.hexdigest()))
            key, digest = k, hashlib.sha256(ids.encode())
        if len(out) > 50_000:
            yield flush()
            out = []
    if key is not None:
        out.append((*key, digest.hexdigest()))
        yield flush()


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, a, b, ends): SHA-256 of the ids that end at each node, ascending and
    joined by commas.  ``ends``: (d, a, b, conv).  A node's ids come as pieces made
    by many tasks; only their digest is taken in one."""
    n = shuffle_partitions(ends.sparkSession)
    order = ["d", "a", "b", "conv"]
    pieces = ends.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_chunks, "d long, a long, b long, conv long, ids string")
    pieces = pieces.repartition(n, "d", "a", "b").sortWithinPartitions(*order)
    return pieces.select("d", "a", "b", "ids").mapInArrow(_digests, "d long, a long, b long, ends string")


def _hot_join(rows: DataFrame, by_key: DataFrame, on: list[str], key: str, hot: list[int]) -> DataFrame:
    """Inner join of ``rows`` with ``by_key``, a row for each key; rows of the
    ``hot`` keys, fewer than HOT_KEYS, stay in place and meet a broadcast of those."""
    if not hot:
        return rows.join(by_key, on)
    is_hot = F.col(key).isin(hot)
    return rows.filter(~is_hot).join(by_key.filter(~is_hot), on).unionByName(rows.filter(is_hot).join(F.broadcast(by_key.filter(is_hot)), on))


def trie_nodes(turns: DataFrame, known: DataFrame) -> DataFrame:
    """(conv, d, parent, n, chars, n_children, first_child, ends), a row per node:
    conv, the smallest member, and depth d name a node; parent is the parent's conv.
    ``turns``: (conv, d, a, b, chars) with d from 1 without gaps; ``known``: every
    conv once, also those without turns."""
    hashes = [F.xxhash64("d", c).bitwiseAND(F.lit(MASK)).alias(c) for c in ("a", "b")]
    keyed = running_sums(turns.select("conv", "d", "chars", *hashes), ["conv", "d"], ["a", "b"], segment="conv", bits=BITS, name="keys")
    before = [(F.col(f"{c}_upto") - F.col(c)).bitwiseAND(F.lit(MASK)).alias(f"p{c}") for c in ("a", "b")]
    keyed = staged(keyed.select("conv", "d", "chars", F.col("a_upto").alias("a"), F.col("b_upto").alias("b"), *before), "prefixes")

    last = keyed.groupBy("conv").agg(F.max(F.struct("d", "a", "b")).alias("end"))
    zero = lambda c: F.coalesce(F.col(f"end.{c}"), F.lit(0)).cast("long").alias(c)
    ends = known.join(last, "conv", "left").select(zero("d"), zero("a"), zero("b"), "conv")
    digests = end_digests(ends)

    groups = keyed.groupBy("d", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.min("chars").alias("chars"), F.min("pa").alias("pa"), F.min("pb").alias("pb")
    )
    none = F.lit(0).cast("long")
    root = known.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).filter("n > 0")
    root = root.select(none.alias("d"), none.alias("a"), none.alias("b"), "n", "conv", none.alias("chars"), none.alias("pa"), none.alias("pb"))
    nodes = staged(groups.unionByName(root).join(digests, ["d", "a", "b"], "left"), "nodes")

    below = nodes.filter("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    below = staged(below.agg(F.count(F.lit(1)).alias("n_children"), F.min("conv").alias("first_child")), "children")
    many = max(TASK_ARCS // 10, nodes.count() // HOT_KEYS)
    hot = [r["a"] for r in below.filter(F.col("n_children") > many).select("a").collect()]  # fewer than HOT_KEYS
    parents = below.join(nodes.select("d", "a", "b", F.col("conv").alias("parent")), ["d", "a", "b"])
    parents = parents.select((F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), "parent")
    nodes = nodes.join(below, ["d", "a", "b"], "left")
    told = _hot_join(nodes.filter("d > 0"), parents, ["d", "pa", "pb"], "pa", hot)
    columns = ["conv", "d", "parent", "n", "chars", F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child", F.coalesce("ends", F.lit(_EMPTY)).alias("ends")]
    return told.select(*columns).unionByName(nodes.filter("d = 0").withColumn("parent", F.lit(None).cast("long")).select(*columns))


_EMPTY = hashlib.sha256(b"").hexdigest()


# --- Euler tour -------------------------------------------------------------------------

_ARC = ["c", "s", "nc", "ns"]


def tour_arcs(nodes: DataFrame) -> DataFrame:
    """(c, s, nc, ns, leaves, saved): the enter arc (s = 2d) and exit arc (2d + 1)
    of every node and the arc that follows, null after the root's exit.  Children
    follow each other by conv."""
    inner = next_values(nodes.filter("d > 0"), ["d", "parent"], "conv", "sibling", "siblings")
    placed = inner.unionByName(nodes.filter("d = 0").withColumn("sibling", F.lit(None).cast("long")))
    enter, leave = F.col("d") * 2, F.col("d") * 2 + 1
    leaf, zero = F.col("n_children") == 0, F.lit(0).cast("long")
    arcs = F.array(
        F.struct(
            F.col("conv").alias("c"), enter.alias("s"),
            F.when(leaf, F.col("conv")).otherwise(F.col("first_child")).alias("nc"), F.when(leaf, leave).otherwise(enter + 2).alias("ns"),
            leaf.cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("chars")).alias("saved"),
        ),
        F.struct(
            F.col("conv").alias("c"), leave.alias("s"),
            F.coalesce("sibling", "parent").alias("nc"), F.when(F.col("sibling").isNotNull(), enter).when(F.col("d") > 0, leave - 2).alias("ns"),
            zero.alias("leaves"), zero.alias("saved"),
        ),
    )
    return placed.select(F.inline(arcs))


def _walked(values: list[str]):
    """Walk the list where it stays inside a range of arcs: for every arc the head
    of its stretch and the sums from there on; the last arc of a stretch keeps its
    successor."""

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        c, s = t.column("c").to_numpy(), t.column("s").to_numpy()
        order = np.lexsort((s, c))
        c, s = c[order], s[order]
        ends = t.column("nc").is_null().to_numpy(zero_copy_only=False)[order]
        nc, ns = (t.column(k).fill_null(0).to_numpy()[order] for k in ("nc", "ns"))
        names = np.unique(c)
        width = int(max(s.max(), ns.max())) + 1
        at = np.minimum(np.searchsorted(names, nc), len(names) - 1)
        own = np.searchsorted(names, c) * width + s
        want = at * width + ns
        there = np.minimum(np.searchsorted(own, want), len(own) - 1)
        inside = ~ends & (names[at] == nc) & (own[there] == want)
        n = len(c)
        before = np.full(n, -1)
        before[there[inside]] = np.flatnonzero(inside)
        sums = [t.column(v).to_numpy()[order].copy() for v in values]
        up, head = before.copy(), np.where(before >= 0, before, np.arange(n))
        while (has := up >= 0).any():  # pointer jumping
            for v in sums:
                v[has] += v[up[has]].copy()
            up = np.where(has, up[up], -1)
        while not np.array_equal(head, head[head]):
            head = head[head]
        out = [pa.array(c), pa.array(s), pa.array(c[head]), pa.array(s[head]), *map(pa.array, sums)]
        own_w = [pa.array(t.column(v).to_numpy()[order]) for v in values]
        tail = ~inside
        out += [*own_w, pa.array(tail), pa.array(nc, mask=ends), pa.array(ns, mask=ends)]
        yield pa.RecordBatch.from_arrays(out, names=["c", "s", "hc", "hs", *[f"{v}_upto" for v in values], *values, "tail", "nc", "ns"])

    return run


def list_rank(arcs: DataFrame, values: list[str], task_arcs: int = TASK_ARCS) -> DataFrame:
    """(c, s, <values>, <value>_before): sums of ``values`` over all arcs before
    each one in its list.  ``arcs``: (c, s, nc, ns, values), all longs, (nc, ns) the
    next arc or null.

    Ranges of about ``task_arcs`` arcs become as many arcs as the list enters them;
    where that leaves more than half, the rest is ranked by pointer jumping, in as
    many rounds as the logarithm of its length."""
    spark = arcs.sparkSession
    count = arcs.count()
    kinds = "c long, s long, hc long, hs long, " + ", ".join(f"{v}_upto long" for v in values) + ", " + ", ".join(f"{v} long" for v in values)
    walk = lambda df: df.select(*_ARC, *values).mapInArrow(_walked(values), f"{kinds}, tail boolean, nc long, ns long")
    if count <= task_arcs:
        done = walk(arcs.coalesce(1))
        if done.filter("tail and nc is not null").limit(1).count():
            raise ValueError("an arc is followed by one that is not there")
        return done.select("c", "s", *values, *[(F.col(f"{v}_upto") - F.col(v)).alias(f"{v}_before") for v in values])
    ranges = max(shuffle_partitions(spark), -(-count // task_arcs))
    local = staged(walk(arcs.repartitionByRange(ranges, "c", "s")), "stretches")
    tails = local.filter("tail").select(F.col("hc").alias("c"), F.col("hs").alias("s"), "nc", "ns", *[F.col(f"{v}_upto").alias(v) for v in values])
    left = tails.count()
    heads = list_rank(tails, values, task_arcs) if left * 2 <= count else _jumped(tails, values)
    heads = staged(heads, "heads").select(F.col("c").alias("hc"), F.col("s").alias("hs"), *[F.col(f"{v}_before").alias(f"{v}_head") for v in values])
    joined = local.join(F.broadcast(heads) if left <= task_arcs else heads, ["hc", "hs"])
    return joined.select("c", "s", *values, *[(F.col(f"{v}_head") + F.col(f"{v}_upto") - F.col(v)).alias(f"{v}_before") for v in values])


def _jumped(arcs: DataFrame, values: list[str]) -> DataFrame:
    """``list_rank`` by pointer jumping: every round doubles how far each arc sees
    ahead; sums to the end of the list turn into sums before the arc."""
    ahead = staged(arcs.select(*_ARC, *values, *[F.col(v).alias(f"{v}_on") for v in values]), "jump")
    while ahead.filter("nc is not null").limit(1).count():
        to = ahead.select(F.col("c").alias("nc"), F.col("s").alias("ns"), F.col("nc").alias("nc2"), F.col("ns").alias("ns2"), *[F.col(f"{v}_on").alias(f"{v}_2") for v in values])
        on = [(F.col(f"{v}_on") + F.coalesce(f"{v}_2", F.lit(0))).alias(f"{v}_on") for v in values]
        moved = ahead.filter("nc is not null").join(to, ["nc", "ns"]).select("c", "s", F.col("nc2").alias("nc"), F.col("ns2").alias("ns"), *values, *on)
        ahead = staged(moved.unionByName(ahead.filter("nc is null")), "jump")
    total = ahead.agg(*[F.max(f"{v}_on").alias(v) for v in values]).first()  # of the whole list, as weights are not negative
    return ahead.select("c", "s", *values, *[(F.lit(total[v]) - F.col(f"{v}_on")).alias(f"{v}_before") for v in values])


def prefix_trie(turns: DataFrame, known: DataFrame, task_arcs: int = TASK_ARCS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), a row per node, the root included; no row where no
    conversation is known.  ``turns`` and ``known`` as for :func:`trie_nodes`."""
    nodes = staged(trie_nodes(turns, known), "trie")
    arcs = staged(tour_arcs(nodes), "arcs")
    ranked = list_rank(arcs, ["leaves", "saved"], task_arcs)
    enters = F.col("s") % 2 == 0
    # up to the exit arc without what comes before the enter arc
    part = lambda v: F.sum(F.when(enters, -F.col(f"{v}_before")).otherwise(F.col(f"{v}_before") + F.col(v)))
    sums = ranked.groupBy(F.col("c").alias("conv"), F.shiftright("s", 1).alias("d")).agg(part("leaves").alias("n_leaves"), part("saved").alias("saved_tokens"))
    return nodes.join(sums, ["conv", "d"]).select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, task_arcs: int = TASK_ARCS) -> DataFrame:
    """The trie of the rebuilt conversations: :func:`ordered_turns`,
    :func:`rebuilt_turns` and :func:`prefix_trie`."""
    return prefix_trie(*rebuilt_turns(ordered_turns(conversations)), task_arcs)

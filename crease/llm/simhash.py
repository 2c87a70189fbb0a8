"""SimHash near-dedup by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints at most d
bits apart differ in at most d bytes, so at least ``8 - d`` positional bytes are
shared: the guaranteed minimum.  Fingerprints are posted under groups of
``width`` positional bytes chosen so that any ``8 - d`` shared positions hold
one of the groups (a covering design); within a posting list the shared bytes
of each pair are tallied, pairs below the minimum are left out and the rest
are verified by their bit distance.  A list returns a spanning forest of its
links, not all pairs.  A list longer than ``list_limit`` is not compared at all:
its fingerprints meet at the values halfway between them instead (every pair
within d bits has a value within ceil(d/2) of one and floor(d/2) of the other),
which is exact, one grouped minimum, and needs no list in one place.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import hot_join, hot_values, local_components, pairs_in_runs, run_bounds, shuffle_partitions, staged, whole_runs
from crease.llm.components import connected_components

SEED = 42  # fixed value: the contract's XXH64 seed


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text: A-Z lower-cased, words split at ASCII white space,
    shingles of ``shingle`` words with repeats.  No word (or null): 0."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle:
        h = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lens = np.fromiter(map(len, words), dtype=np.int64, count=n)
        ends = np.cumsum(lens + 1) - 1
        first, last = (ends - lens)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        h = [digest(joined[s:e], SEED) for s, e in zip(first, last)]
    count, total = np.zeros(64, dtype=np.int64), len(h)
    for at in range(0, total, 1 << 14):  # bounded memory for very long texts
        bits = np.unpackbits(np.array(h[at : at + (1 << 14)], dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def posting_groups(need: int, width: int, positions: int = 8) -> list[tuple[int, ...]]:
    """Groups of ``width`` positions such that every ``need`` shared positions
    hold one of them, chosen greedily (first best in lexical order)."""
    width = min(width, need)
    open_sets = {frozenset(c) for c in combinations(range(positions), need)}
    groups = list(combinations(range(positions), width))
    chosen = []
    while open_sets:
        best = max(groups, key=lambda g: sum(1 for s in open_sets if s.issuperset(g)))
        chosen.append(best)
        open_sets = {s for s in open_sets if not s.issuperset(best)}
    return chosen


def _mask(group: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in group)
    return value - (1 << 64) if value >= 1 << 63 else value


def _list_links(need: int, max_distance: int, limit: int):
    """Links (a, b) within posting lists; a row with b null is a fingerprint of
    a list too long to compare."""

    def run(batches):
        for hot, t in whole_runs(batches, ["group", "key"], limit):
            fp = t.column("fp").to_numpy()
            if hot:
                yield pa.RecordBatch.from_arrays([pa.array(fp), pa.nulls(len(fp), pa.int64())], names=["a", "b"])
                continue
            starts, lens = run_bounds(t.column("group").to_numpy(), t.column("key").to_numpy())
            left, right = [], []
            u = fp.view(np.uint64)
            for i, j in pairs_in_runs(starts, lens):
                x = u[i] ^ u[j]
                shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
                ok = shared >= need  # count filter
                ok[ok] = np.bitwise_count(x[ok]) <= max_distance  # verify
                left.append(i[ok])
                right.append(j[ok])
            if not left:
                continue
            root = local_components(len(fp), np.concatenate(left), np.concatenate(right))
            linked = np.flatnonzero(root != np.arange(len(fp)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], names=["a", "b"])

    return run


def _meet_halfway(hot: DataFrame, max_distance: int) -> DataFrame:
    """Exact links among ``hot`` (fp) without comparing pairs."""
    far, near = (max_distance + 1) // 2, max_distance // 2
    flips = []
    for r in range(far + 1):
        for c in combinations(range(64), r):
            v = sum(1 << k for k in c)
            v -= (1 << 64) if v >= 1 << 63 else 0
            flips.append(f"named_struct('m', cast('{v}' as bigint), 'r', {r})")
    # one fixed array: every flip of at most `far` bits
    met = hot.select("fp", F.explode(F.expr(f"array({', '.join(flips)})")).alias("f")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("f.m")).alias("at"), F.col("f.r").alias("r")
    )
    low = met.groupBy("at").agg(F.min(F.when(F.col("r") <= near, F.col("fp"))).alias("low"), F.count(F.lit(1)).alias("n"))
    low = low.filter("low is not null and n > 1").drop("n")
    return met.join(low, "at").filter("fp != low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def fingerprint_links(distinct_fps: DataFrame, max_distance: int, width: int = 3, list_limit: int = 8192) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (column fp, distinct)
    reachable through pairs at most ``max_distance`` bits apart."""
    need = 8 - max_distance
    if need < 1:
        raise ValueError("max_distance must be below 8: beyond it no positional byte is guaranteed to be shared")
    posts = [F.struct(F.lit(k).alias("group"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("key")) for k, g in enumerate(posting_groups(need, width))]
    lists = (
        distinct_fps.select("fp", F.explode(F.array(*posts)).alias("p"))
        .select("p.group", "p.key", "fp")
        .repartition(shuffle_partitions(distinct_fps.sparkSession), "group", "key")
        .sortWithinPartitions("group", "key", "fp")
    )
    found = staged(lists.mapInArrow(_list_links(need, max_distance, list_limit), "a long, b long"), "simhash-links")
    links = found.filter("b is not null")
    hot = found.filter("b is null").select(F.col("a").alias("fp"))
    if not hot.isEmpty():
        links = links.unionByName(_meet_halfway(hot.distinct(), max_distance))
    return links


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_distance: int = 4,
    width: int = 3,
    list_limit: int = 8192,
) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per row of ``docs``.

    fingerprint: 16 lower-case hex digits.  component_id: the smallest id whose
    fingerprint is reachable over links of at most ``max_distance`` bits.  A null
    or empty text has fingerprint zero and links like any other; a null id keeps
    its row and gets its component's smallest non-null id (null if there is
    none); repeated rows stay, each with the same component; other columns are
    not read; an empty table gives an empty table.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    classes = fps.groupBy("fp").agg(F.min("id").alias("low"))
    links = fingerprint_links(classes.select("fp"), max_distance, width, list_limit)
    roots = connected_components(links)
    linked = roots.select(F.col("node").alias("fp"), F.col("component").alias("root"))
    per_class = staged(classes.join(linked, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-classes")
    component = staged(per_class.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n")), "simhash-roots")
    # the fingerprints of a large component stay in place
    of_fp = hot_join(per_class.select("fp", "root"), component.drop("n"), ["root"], "root", hot_values(component, "root", "n")).select("fp", "component_id")
    return fps.join(of_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

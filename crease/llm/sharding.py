"""Balanced sharding by Karmarkar-Karp differencing.

Groups of equal texts are indivisible.  Differencing keeps partial partitions
(``shards`` subset sizes each) and repeatedly combines the two with the largest
spread, the largest subset of one with the smallest of the other.  It runs over all
groups in one task.  Of more than ``bucket_groups`` groups, those that hold less
than that share of all bytes are first packed into ``bucket_groups`` indivisible
bundles by digest; every larger group stays an item of its own, so the items are
at most twice ``bucket_groups`` and a heavy group meets all that can even it out.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import staged


def difference(parts: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Karmarkar-Karp over partial partitions, each a list of k subset sizes.

    Returns the k subset sizes of the final partition and, per input part, the
    final subset of each of its subsets.  Ties go to the earlier part, so the
    result depends on the order of the input alone."""
    k = len(parts[0])
    nodes: list[tuple] = []  # (part index, order) of a leaf, or (left, right, order)
    heap = []
    for at, sizes in enumerate(parts):
        order = sorted(range(k), key=lambda x: -sizes[x])  # largest first
        ranked = [sizes[x] for x in order]
        heap.append((ranked[-1] - ranked[0], at, ranked))
        nodes.append((at, order))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, one = heapq.heappop(heap)
        _, b, two = heapq.heappop(heap)
        sums = [one[x] + two[k - 1 - x] for x in range(k)]
        order = sorted(range(k), key=lambda x: -sums[x])
        ranked = [sums[x] for x in order]
        nodes.append((a, b, order))
        heapq.heappush(heap, (ranked[-1] - ranked[0], len(nodes) - 1, ranked))
    _, root, final = heap[0]
    where: list[list[int]] = [[]] * len(parts)
    todo = [(root, list(range(k)))]  # node, final subset of each of its ranks
    while todo:
        node, places = todo.pop()
        entry = nodes[node]
        if len(entry) == 2:
            at, order = entry
            place = [0] * k
            for rank, subset in enumerate(order):
                place[subset] = places[rank]
            where[at] = place
        else:
            a, b, order = entry
            at_sum = [0] * k
            for rank, x in enumerate(order):
                at_sum[x] = places[rank]
            todo.append((a, at_sum))
            todo.append((b, [at_sum[k - 1 - x] for x in range(k)]))
    return final, where


def _difference_items(shards: int):
    """The shard of each item, over all items in one task."""

    def run(batches):
        t = pa.Table.from_batches(batches, pa.schema([("item", pa.string()), ("size", pa.int64())]))
        if t.num_rows:
            t = t.sort_by([("size", "descending"), ("item", "ascending")])
            _, where = difference([[s] + [0] * (shards - 1) for s in t.column("size").to_pylist()])
            item = t.column("item").combine_chunks()
            yield pa.RecordBatch.from_arrays([item, pa.array([w[0] for w in where], pa.int32())], names=["item", "shard"])

    return run


def shard_by_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 8,
    bucket_groups: int = 20_000,
    slot_rows: int = 100_000,
) -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, grown_shard), a row per row.

    size: UTF-8 bytes of the text plus 1 (null: 1).  Rows with equal texts share
    a shard (null texts are a group of their own, apart from empty ones), so
    shard sizes are as near equal as indivisible groups allow.  slot: 0, 1, 2...
    within a shard, in an order drawn from id and text.  Repeated rows and null
    ids keep a slot each; other columns are not read; an empty table gives an
    empty table.  text_crc32 of a null text is null.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("digest"),
    )
    groups = staged(rows.groupBy("digest").agg(F.sum("size").alias("size")), "groups")
    n, total = groups.agg(F.count(F.lit(1)), F.sum("size")).first()
    item = F.col("digest")
    if n > bucket_groups:
        bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("digest"), F.lit(bucket_groups)).cast("string"))
        item = F.when(F.col("size") < -(-total // bucket_groups), bundle).otherwise(item)
    dealt = groups.withColumn("item", item)
    items = dealt.groupBy("item").agg(F.sum("size").alias("size")).repartition(1)  # at most 2 x bucket_groups rows
    place = staged(items.mapInArrow(_difference_items(shards), "item string, shard int"), "items")
    of_group = dealt.join(F.broadcast(place), "item").select("digest", "shard")
    placed = staged(rows.join(of_group, "digest"), "placed")

    # slots: dense within (stretch, shard), shifted by the stretches before
    total = placed.count()
    stretches = max(1, -(-total // slot_rows))
    placed = placed.withColumn("stretch", F.pmod(F.xxhash64("id", "digest"), F.lit(stretches)))
    before = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    per = placed.groupBy("stretch", "shard").agg(F.count(F.lit(1)).alias("n"))  # a row for about slot_rows rows and shard
    shift = per.select("stretch", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = F.row_number().over(Window.partitionBy("stretch", "shard").orderBy("id", "digest"))
    numbered = placed.withColumn("rank", within).join(shift, ["stretch", "shard"])
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("shift") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

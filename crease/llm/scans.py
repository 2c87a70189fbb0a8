"""Running sums over a sorted table, also within segments of it: rows are
range-partitioned and sorted, summed within each partition, and what a partition
brings forward is added from one small row per partition.  No task orders more
than a partition, however long a segment is."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import shuffle_partitions, staged


def _local_sums(segment: str | None, values: list[str], mask: int | None):
    def run(batches):
        part, row = TaskContext.get().partitionId(), 0
        last = None  # segment of the last row seen
        carry = [0] * len(values)
        opened = True  # still in the first segment of the partition
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            seg = b.column(segment).to_numpy() if segment else np.zeros(n, dtype=np.int64)
            new = np.concatenate([[last is not None and seg[0] != last], seg[1:] != seg[:-1]])
            starts = np.concatenate([[0], np.flatnonzero(new[1:]) + 1])
            which = np.cumsum(np.concatenate([[False], new[1:]]))
            if new[0]:
                carry = [0] * len(values)
            open_rows = np.cumsum(new) == 0 if opened else np.zeros(n, dtype=bool)
            out = []
            for k, v in enumerate(values):
                total = np.cumsum(b.column(v).to_numpy().astype(np.int64, copy=False).view(np.uint64))
                before = np.concatenate([[np.uint64(0)], total[starts[1:] - 1]]).astype(np.uint64)
                total = total - before[which]
                total[: starts[1] if len(starts) > 1 else n] += np.uint64(carry[k])
                if mask:
                    total &= np.uint64(mask)
                carry[k] = int(total[-1])
                out.append(pa.array(total.view(np.int64)))
            opened, last = bool(open_rows[-1]), seg[-1]
            place = [pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(row, row + n)), pa.array(open_rows)]
            row += n
            yield pa.RecordBatch.from_arrays([*b.columns, *out, *place], names=[*b.schema.names, *[f"{v}_upto" for v in values], "__part", "__row", "__open"])

    return run


def running_sums(df: DataFrame, order: list[str], values: list[str], segment: str | None = None, bits: int | None = None, name: str = "sums") -> DataFrame:
    """``df`` and for each of ``values`` (longs without nulls) the column
    ``<value>_upto``: its running sum by ``order`` (within ``segment``, a long without
    nulls that ``order`` begins with).  Rows that are equal in ``order`` follow each
    other in any order.  ``bits``: sums modulo a power of two, below 2^62."""
    spark = df.sparkSession
    mask = (1 << bits) - 1 if bits else None
    rows = df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    extra = ", ".join(f"{v}_upto long" for v in values)
    kinds = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    local = staged(rows.mapInArrow(_local_sums(segment, values, mask), f"{kinds}, {extra}, __part int, __row long, __open boolean"), name)
    ends = F.struct(*[f"{v}_upto" for v in values], *([segment] if segment else []), "__open")
    parts = local.groupBy("__part").agg(F.max_by(ends, "__row").alias("end"), F.min_by(F.struct(*([segment] if segment else ["__row"])), "__row").alias("begin"))
    carry, found = [0] * len(values), []
    last = None
    for r in sorted(parts.collect(), key=lambda r: r["__part"]):  # one row per partition
        first, end = (r["begin"][segment], r["end"][segment]) if segment else (0, 0)
        if first != last:
            carry = [0] * len(values)
        found.append((r["__part"], *carry))
        sums = [r["end"][f"{v}_upto"] for v in values]
        carry = [(c + s) & mask if mask else c + s for c, s in zip(carry, sums)] if r["end"]["__open"] else sums
        last = end
    names = [f"__carry{k}" for k in range(len(values))]
    before = spark.createDataFrame(found, "__part int, " + ", ".join(f"{n} long" for n in names))
    joined = local.join(F.broadcast(before), "__part")
    for v, n in zip(values, names):
        total = F.col(f"{v}_upto") + F.when(F.col("__open"), F.col(n)).otherwise(F.lit(0))
        joined = joined.withColumn(f"{v}_upto", total.bitwiseAND(F.lit(mask)) if mask else total)
    return joined.drop("__part", "__row", "__open", *names)


def _local_next(segment: list[str], value: str):
    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        first = True
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b] if held is None else [held, b])
            keys = [t.column(s).to_numpy() for s in segment]
            same = np.ones(t.num_rows - 1, dtype=bool)
            for k in keys:
                same &= k[1:] == k[:-1]
            nxt = pa.array(t.column(value).to_numpy()[1:], mask=~same)
            body = t.slice(0, t.num_rows - 1).combine_chunks()
            if body.num_rows:
                begins = np.zeros(body.num_rows, dtype=bool)
                begins[0], first = first, False
                yield from _with(body, nxt, part, begins, False)
            held = t.slice(t.num_rows - 1).combine_chunks().to_batches()[0]
        if held is not None:
            yield from _with(pa.Table.from_batches([held]), pa.array([None], pa.int64()), part, np.array([first]), True)

    def _with(t, nxt, part, begins, ends):
        n = t.num_rows
        t = t.append_column("__next", nxt).append_column("__part", pa.array(np.full(n, part, dtype=np.int32)))
        t = t.append_column("__begins", pa.array(begins)).append_column("__ends", pa.array(np.full(n, ends)))
        return t.combine_chunks().to_batches()

    return run


def next_values(df: DataFrame, segment: list[str], value: str, into: str, name: str = "next") -> DataFrame:
    """``df`` and ``into``: the next larger ``value`` (longs, distinct in a segment)
    of the rows with the same ``segment`` (longs); null for the largest."""
    spark = df.sparkSession
    order = [*segment, value]
    rows = df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    kinds = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    local = staged(rows.mapInArrow(_local_next(segment, value), f"{kinds}, __next long, __part int, __begins boolean, __ends boolean"), name)
    key = [*segment, value]
    edges = local.filter("__begins or __ends").select("__part", "__begins", "__ends", *key).collect()  # two rows per partition
    begin = sorted((r["__part"], tuple(r[k] for k in key)) for r in edges if r["__begins"])
    end = {r["__part"]: tuple(r[k] for k in key) for r in edges if r["__ends"]}
    found = [(p, after[-1]) for (p, _), (_, after) in zip(begin, begin[1:]) if end[p][:-1] == after[:-1]]
    joined = local.join(F.broadcast(spark.createDataFrame(found, "__part int, __after long")), "__part", "left")
    nxt = F.when(F.col("__ends"), F.col("__after")).otherwise(F.col("__next"))
    return joined.withColumn(into, nxt).drop("__next", "__part", "__begins", "__ends", "__after")

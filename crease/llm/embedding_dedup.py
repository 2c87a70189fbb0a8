"""Embedding near-dedup by Euclidean p-stable hashing.

Unit vectors whose cosine is at least c lie within sqrt(2 - 2c) of each other.
Each of ``tables`` tables hashes a vector to ``projections`` quantised Gaussian
projections floor((a.v + b) / width); vectors that share a table's bucket are
compared by exact cosine in double precision.  A pair that shares several
buckets is counted in the first of them only, so link counts need no list of
pairs.  Equal vectors are collapsed first and carried as a weight.  A bucket of
more than ``block_rows`` vectors is split into blocks, and every two blocks
are compared as a task of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm.common import hot_join, hot_values, local_components, pairs_in_runs, run_bounds, shuffle_partitions, staged, whole_runs
from crease.llm.components import connected_components


def collision_probability(distance: float, width: float) -> float:
    """Chance that two points ``distance`` apart share one quantised projection."""
    r = width / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def expected_recall(threshold: float, tables: int, projections: int, width: float) -> float:
    """Chance that a pair exactly at the cosine ``threshold`` shares a bucket."""
    p = collision_probability(math.sqrt(2 - 2 * threshold), width)
    return 1 - (1 - p**projections) ** tables


def _unit(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of rows of one length, in double precision, and which are valid."""
    v = np.array(rows, dtype=np.float64)
    good = np.isfinite(v).all(axis=1)
    top = np.where(good, np.abs(v).max(axis=1, initial=0.0), 1.0)
    good &= top > 0
    top[~good] = 1.0
    v = v / top[:, None]  # so that the norm neither overflows nor vanishes
    v[~good] = 0.0
    norm = np.sqrt((v * v).sum(axis=1))
    norm[~good] = 1.0
    return v / norm[:, None], good


def _keys(unit: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """(rows, tables) 32-bit bucket keys."""
    dim = unit.shape[1]
    rng = np.random.default_rng([seed, dim])
    a = rng.standard_normal((dim, tables * projections))
    b = rng.random(tables * projections) * width
    q = np.floor((unit @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(unit), tables, projections)
    h = np.full((len(unit), tables), dim, dtype=np.uint64)
    for k in range(projections):
        h = (h ^ q[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signatures(tables: int, projections: int, width: float, seed: int):
    def run(batches):
        for batch in batches:
            ids, vecs = batch.column(0), batch.column(1).to_pylist()
            for dim in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                for a in range(0, len(at), 4096):
                    part = at[a : a + 4096]
                    unit, _ = _unit([vecs[i] for i in part])
                    keys = _keys(unit, tables, projections, width, seed)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(part)), pa.array(list(keys), pa.list_(pa.int32()))], names=["class", "keys"]
                    )

    return run


class _Block:
    """Rows of whole buckets: unit vectors, weights, keys, sides."""

    def __init__(self, t: pa.Table):
        self.cls = t.column("class").to_numpy()
        self.weight = t.column("weight").to_numpy()
        self.table = t.column("table").to_numpy()
        self.keys = np.array(t.column("keys").to_pylist(), dtype=np.int32)
        self.block = t.column("block").to_numpy()
        self.i, self.j = t.column("i").to_numpy(), t.column("j").to_numpy()
        self.starts, self.lens = run_bounds(self.table, t.column("key").to_numpy(), self.i, self.j)
        vecs = t.column("vec").to_pylist()
        dims = np.array([len(v) for v in vecs])
        self.unit = np.zeros((len(vecs), int(dims.max(initial=0))))
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            self.unit[at, :dim], _ = _unit([vecs[k] for k in at.tolist()])
        self.dims = dims

    def first_shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs whose first common bucket is this table's."""
        ok = (self.i[i] == self.j[i]) | (self.block[i] != self.block[j])
        ok &= self.dims[i] == self.dims[j]
        i, j = i[ok], j[ok]
        first = (self.keys[i] == self.keys[j]).argmax(axis=1)
        ok[ok] = first == self.table[i]
        return ok


def _bucket_links(threshold: float):
    """Per class: weight of the vectors linked in this bucket, and one link of
    a spanning forest of the bucket's links."""

    def pairs(b: _Block):
        small = b.lens <= 64
        for i, j in pairs_in_runs(b.starts[small], b.lens[small], chunk=1 << 15):
            ok = np.einsum("ij,ij->i", b.unit[i], b.unit[j]) >= threshold
            i, j = i[ok], j[ok]
            ok = b.first_shared(i, j)
            yield i[ok], j[ok]
        for st, n in zip(b.starts[~small].tolist(), b.lens[~small].tolist()):
            k, one = b.keys[st : st + n], b.table[st]
            if (k[:, :one] == k[0, :one]).all(axis=0).any():
                continue  # all of them share an earlier bucket, where they were compared
            rows = max(1, (1 << 18) // n)
            for a in range(0, n - 1, rows):
                e = min(n - 1, a + rows)
                cos = b.unit[st + a : st + e] @ b.unit[st + a + 1 : st + n].T
                i, j = np.nonzero((cos >= threshold) & (np.arange(a, e)[:, None] < np.arange(a + 1, n)[None, :]))
                i, j = i + st + a, j + st + a + 1
                ok = b.first_shared(i, j)
                yield i[ok], j[ok]

    def run(batches):
        for _, t in whole_runs(batches, ["table", "key", "i", "j"], 1 << 62):
            b = _Block(t)
            n = len(b.cls)
            count, left, right = np.zeros(n, dtype=np.int64), [], []
            for i, j in pairs(b):
                np.add.at(count, i, b.weight[j])
                np.add.at(count, j, b.weight[i])
                left.append(i)
                right.append(j)
            if not left:
                continue
            root = local_components(n, np.concatenate(left), np.concatenate(right))
            at = np.flatnonzero(count > 0)
            yield pa.RecordBatch.from_arrays([pa.array(b.cls[at]), pa.array(count[at]), pa.array(b.cls[root[at]])], names=["class", "n", "other"])

    return run


def near_duplicate_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    tables: int = 24,
    projections: int = 10,
    width: float = 2.25,
    seed: int = 11,
    block_rows: int = 2048,
) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row per row of ``df``.

    n_links: other rows linked directly (found pairs with cosine >= threshold);
    component_id: the smallest id reachable; kept: id = component_id.  A vector
    that is null, empty, zero or holds a null or non-finite component links
    with nothing (0 links, its own component).  Vectors of different lengths
    never link.  Equal vectors link to each other, repeated rows count each.  A
    null id keeps its row; its component is the smallest non-null id reachable
    (null if none) and it is not kept unless that is null too.  Other columns
    are not read.  The chance to find a pair right at the threshold is
    ``expected_recall`` (above 0.999 with the defaults), higher for closer ones.
    """
    # float vectors travel as floats; all arithmetic is in double precision
    element = df.schema[vector_col].dataType.elementType
    kind = T.ArrayType(T.FloatType() if isinstance(element, T.FloatType) else T.DoubleType())
    vec = F.col(vector_col).cast(kind)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)
    rows = df.select(F.col(id_col).alias("id"), F.when(F.coalesce(valid, F.lit(False)), F.transform(vec, lambda x: x + F.lit(0.0).cast(kind.elementType))).alias("vec"))

    # equal vectors are one class with a weight
    classes = staged(
        rows.filter("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("low"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    signed = staged(
        classes.select("class", "vec").mapInArrow(_signatures(tables, projections, width, seed), "class long, keys array<int>"),
        "signatures",
    )
    posted = signed.select("class", "keys", F.posexplode("keys").alias("table", "key"))
    sizes = posted.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a bucket of one vector has nothing to compare; large ones are split
    sizes = staged(sizes.withColumn("blocks", F.ceil(F.col("n") / F.lit(block_rows)).cast("int")), "buckets")
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    # the vectors of a large bucket are split where they are
    busy = hot_join(posted, sizes.drop("n"), ["table", "key"], "key", hot_values(sizes, "key", "n")).withColumn("block", block)
    units = busy.select("class", "keys", "table", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    units = units.select("class", "keys", "table", "key", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    units = (
        units.join(classes.select("class", "vec", "weight"), "class")
        .repartition(shuffle_partitions(df.sparkSession), "table", "key", "i", "j")
        .sortWithinPartitions("table", "key", "i", "j", "class")
    )
    found = staged(units.mapInArrow(_bucket_links(threshold), "class long, n long, other long"), "vector-links")

    counts = found.groupBy("class").agg(F.sum("n").alias("links"))
    roots = connected_components(found, "class", "other").select(F.col("node").alias("class"), F.col("component").alias("root"))
    of_class = classes.select("class", "weight", "low").join(counts, "class", "left").join(roots, "class", "left")
    of_class = staged(of_class.withColumn("root", F.coalesce("root", "class")), "vector-classes")
    lowest = staged(of_class.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n")), "vector-roots")
    # the vectors of a large component stay in place
    of_class = hot_join(of_class, lowest.drop("n"), ["root"], "root", hot_values(lowest, "root", "n"))
    of_class = of_class.select("class", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    of_vec = classes.select("class", F.col("vec").alias("same")).join(of_class, "class").drop("class")
    out = rows.join(of_vec, rows["vec"] == of_vec["same"], "left")
    component = F.when(F.col("same").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )

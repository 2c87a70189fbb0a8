"""Helpers shared by the operators: staged tables in the shared folder, whole
runs of equal keys out of sorted Arrow batches, pairs within runs and local
connected components in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.session import scratch_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under spark.checkpoint.dir and read it
    back: cuts the lineage with files every executor can reach."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value):
    """A function that returns ``value`` on the executors: broadcast as bytes that
    hold its class too.  The caller bounds the size of ``value``."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hashed_share(col: Column, share: float, seed: int) -> Column:
    """True for about ``share`` of the values of ``col``, by value and seed
    only: the same rows on every run and layout."""
    return F.pmod(F.xxhash64(F.lit(seed), col), F.lit(1 << 32)) < F.lit(int(min(1.0, share) * (1 << 32)))


HOT_KEYS = 200  # a key with more than this share of all rows is hot: there are fewer such keys


def hot_values(sizes: DataFrame, key: str, count: str, least: int = 1000) -> list:
    """The hot keys of a table of (key, count): fewer than HOT_KEYS."""
    total = sizes.agg(F.sum(count)).first()[0] or 0
    return [r[0] for r in sizes.filter(F.col(count) > max(least, total // HOT_KEYS)).select(key).collect()]


def hot_join(rows: DataFrame, by_key: DataFrame, on: list[str], key: str, hot: list) -> DataFrame:
    """Inner join of ``rows`` with ``by_key``, a row for each key.  Rows of the ``hot``
    keys (:func:`hot_values`; no key is null) stay where they are and meet a broadcast
    of those, so that no task gets all rows of one."""
    if not hot:
        return rows.join(by_key, on)
    is_hot = F.col(key).isin(hot)
    return rows.filter(~is_hot).join(by_key.filter(~is_hot), on).unionByName(rows.filter(is_hot).join(F.broadcast(by_key.filter(is_hot)), on))


def run_bounds(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal (sorted) keys."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, n))


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int) -> Iterator[tuple[bool, pa.Table]]:
    """Regroup sorted batches so that no run of equal ``keys`` is cut.

    Yields (False, table of whole runs of at most ``limit`` rows each) and, for
    a longer run, (True, piece) for every piece of it: memory stays bounded by
    ``limit`` and the batch size however long a run is.
    """
    carry: pa.Table | None = None
    hot = None  # key of the long run that is passing by

    def key_of(t: pa.Table, i: int) -> tuple:
        return tuple(t.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if carry is not None and carry.num_rows:
            t = pa.concat_tables([carry, t])
        carry = None
        starts, lens = run_bounds(*[t.column(k).to_numpy() for k in keys])
        if hot is not None:
            if key_of(t, 0) == hot:
                yield True, t.slice(0, int(lens[0]))
                if len(starts) == 1:
                    continue
                t = t.slice(int(lens[0]))
                starts, lens = starts[1:] - lens[0], lens[1:]
            hot = None
        last = int(starts[-1])
        long = np.flatnonzero(lens[:-1] > limit)
        at = 0
        for r in long:
            if starts[r] > at:
                yield False, t.slice(at, int(starts[r]) - at)
            yield True, t.slice(int(starts[r]), int(lens[r]))
            at = int(starts[r] + lens[r])
        if last > at:
            yield False, t.slice(at, last - at)
        tail = t.slice(last)
        if tail.num_rows > limit:
            hot = key_of(tail, 0)
            yield True, tail
        else:
            carry = tail
    if carry is not None and carry.num_rows:
        yield False, carry


def pairs_in_runs(starts: np.ndarray, lens: np.ndarray, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of rows in the same run, in chunks of about
    ``chunk`` pairs: short runs together by distance, long ones by row blocks."""
    short = 64
    small = lens <= short
    s_starts, s_lens = starts[small], lens[small]
    for d in range(1, int(s_lens.max(initial=0))):
        has = s_lens > d
        st, cnt = s_starts[has], s_lens[has] - d
        total = int(cnt.sum())
        offs = np.cumsum(cnt) - cnt
        i = np.repeat(st - offs, cnt) + np.arange(total)
        for a in range(0, total, chunk):
            p = i[a : a + chunk]
            yield p, p + d
    for st, n in zip(starts[~small].tolist(), lens[~small].tolist()):
        rows = max(1, chunk // n)
        for a in range(0, n - 1, rows):
            b = min(n - 1, a + rows)
            i, j = np.nonzero(np.arange(a, b)[:, None] < np.arange(a + 1, n)[None, :])
            yield st + a + i, st + a + 1 + j


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes over edges (a, b)."""
    label = np.arange(n)
    if not len(a):
        return label
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:  # pointer jumping
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        if np.array_equal(before, label):
            return label

"""Interaction audit of five document filters over all their orders.

A document is a mask of the filters that it fails, so the table is at most 32
cells for each part.  A Gray code walks the 32 sets of active filters, one filter
toggled at a time: the cells that fail it count one active failure more or less,
and only where a counter leaves or reaches zero the running survivors change.
The survivors of all 32 states are kept, and every step of every order is the
difference of two of them.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the contract's filters, their thresholds and the characters of a word
FILTERS = "ABCDE"
WHITE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "[#$%&*|]"
MIN_WORDS = 100
MIN_DISTINCT = 80  # of 100 words
MAX_UPPER = 10  # of 100 code points

KINDS = ("n", "good", "toxic")  # what a cell counts


def own_failures(text: Column) -> list[Column]:
    """Failures that the text alone decides: A short, B repetitive, C upper case, D marks."""
    words = F.array_remove(F.split(text, WHITE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return [n < MIN_WORDS, distinct * 100 < n * MIN_DISTINCT, upper * 100 > F.length(text) * MAX_UPPER, F.regexp_like(text, F.lit(MARKS))]


def failure_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask, good, toxic), a row per row of ``docs``: bit k of the mask
    is the failure of filter k.

    E fails where a row with a smaller id has the same text; a null id is neither
    smaller nor larger than another.  Null texts are empty, a null part is ''.  A
    document is good (toxic) where any label row of its id says so.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(own_failures(F.col("text")))]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("id", "part", sum(bits[1:], bits[0]).alias("own"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))

    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    numbered = rows.filter("id is not null")
    # by digest and id: the rows of a text with many copies spread over all tasks
    first = numbered.groupBy("digest").agg(F.min("id").alias("first"))
    first = first.select(F.col("digest").alias("of_text"), "first", F.lit(True).alias("is_first"))
    told = numbered.join(first, (F.col("digest") == F.col("of_text")) & (F.col("id") == F.col("first")), "left")
    told = told.join(known, F.col("id") == F.col("of"), "left")
    later = F.when(F.col("is_first"), F.lit(0)).otherwise(F.lit(1 << FILTERS.index("E")))
    label = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    told = told.select("id", "part", (F.col("own") + later).alias("mask"), label("good"), label("toxic"))
    return told.unionByName(rows.filter("id is null").select("id", "part", F.col("own").alias("mask"), F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def survivors(cells: np.ndarray) -> np.ndarray:
    """``cells``: (32, k) counts by failure mask.  (32, k): what is left with each
    set of filters active, by a Gray code walk over the sets."""
    masks = np.arange(len(cells))
    failing = np.zeros(len(cells), dtype=np.int64)  # active filters that a cell fails
    states = np.zeros_like(cells)
    running = cells.sum(axis=0)
    states[0] = running
    active = 0
    for step in range(1, len(cells)):
        toggled = (step & -step).bit_length() - 1
        active ^= 1 << toggled
        hit = (masks >> toggled) & 1 == 1
        if active >> toggled & 1:
            running = running - cells[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + cells[hit & (failing == 0)].sum(axis=0)
        states[active] = running
    return states


def shapley_sums(states: np.ndarray) -> list[int]:
    """For each filter what it removes, summed over all orders."""
    n = len(FILTERS)
    out = []
    for f in range(n):
        total = 0
        for s in range(1 << n):
            if not s >> f & 1:
                size = s.bit_count()
                total += math.factorial(size) * math.factorial(n - 1 - size) * int(states[s, 0] - states[s | 1 << f, 0])
        out.append(total)
    return out


def _steps(cells: np.ndarray):
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order."""
    states, every = survivors(cells), (1 << len(FILTERS)) - 1
    shapley = shapley_sums(states)
    for order in itertools.permutations(range(len(FILTERS))):
        name, active = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            removed, good, toxic = (int(x) for x in states[active] - states[active | 1 << f])
            fails = int(states[0, 0] - states[1 << f, 0])
            alone = int(states[every ^ 1 << f, 0] - states[every, 0])
            active |= 1 << f
            yield name, step, int(states[active, 0]), removed, fails - removed, alone, good, toxic, shapley[f]


_COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_TYPES = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]


def _walk(batches):
    for b in batches:
        for part, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            table = np.zeros((1 << len(FILTERS), len(KINDS)), dtype=np.int64)
            for c in cells:
                table[c["mask"]] = [c[k] for k in KINDS]
            columns = zip(*[(part, *row) for row in _steps(table)])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_COLUMNS)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley): 600 rows for each part, zeros included.

    Nulls, repeated rows and labels as :func:`failure_rows` says; other columns
    are not read; an empty table gives an empty table.
    """
    rows = failure_rows(docs, labels, id_col, text_col, part_col)
    cells = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *KINDS)).alias("cells"))  # at most 32 cells a part
    return parts.mapInArrow(_walk, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")

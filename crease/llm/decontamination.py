"""Benchmark decontamination by SimHash over item-sized windows.

For every benchmark item, the windows of a document with the item's word count
are fingerprinted (SimHash over word shingles) and looked up in a multi-index:
a fingerprint is ``BLOCKS`` bytes, and two fingerprints at most ``radius`` bits
apart have a byte at most radius // BLOCKS bits apart, so looking up every byte
value in that ball finds all items within the radius.  Those are verified by
the exact similarity of their weighted shingle sets (sum of the smaller counts
over sum of the larger ones).

A text of fewer words than an item is a single window.

Windows without a single shingle of the benchmark, and texts with too few shingles
for the similarity, cannot be similar to an item and are not fingerprinted; that is
the only thing skipped.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from crease.llm.common import shared

WORDS = re.compile(r"\w+")
BLOCKS = 8
MAX_CELLS = 1 << 24  # window and item pairs marked at a time
MAX_ITEMS = 1 << 15  # of a group: an item takes 2 KB in the multi-index
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def _word_codes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)


def _shingles(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code for every ``width`` consecutive words."""
    n = len(codes) - width + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = (out ^ codes[k : k + n]) * _MULT
        out ^= out >> np.uint64(32)
    return out


def _signs(shingles: np.ndarray) -> np.ndarray:
    """(n, 64): +1 for a set bit of the shingle, else -1."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """(n, 8) fingerprint bytes: a bit is 1 where the sum is positive."""
    return np.packbits(sums > 0, axis=1)


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 0.0


@dataclass
class _Items:
    """Items of one word count: their shingle counts and their multi-index."""

    words: int
    width: int
    ids: list
    counts: list[Counter]
    prints: np.ndarray  # (items, BLOCKS) bytes
    near: np.ndarray = field(default=None)  # (BLOCKS, 256, items): item's byte lies in the value's ball

    def index(self, radius: int) -> None:
        ball = radius // BLOCKS
        values = np.arange(256, dtype=np.uint8)
        self.near = np.stack([np.bitwise_count(values[:, None] ^ self.prints[None, :, k]) <= ball for k in range(BLOCKS)])

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        hit = np.zeros((len(prints), len(self.ids)), dtype=bool)
        for k in range(BLOCKS):
            hit |= self.near[k][prints[:, k]]
        w, i = np.nonzero(hit)
        distance = np.bitwise_count(prints[w] ^ self.prints[i]).sum(axis=1)
        ok = distance <= radius
        return w[ok], i[ok], distance[ok]


class BenchmarkIndex:
    """A bounded set of items, ready to be searched for in texts."""

    def __init__(self, items: list[tuple[object, str]], shingle: int = 5, radius: int = 20):
        self.radius = radius
        by_size: dict[int, list] = {}
        vocabulary: set[str] = set()
        for item_id, text in items:
            words = words_of(text)
            if words:
                by_size.setdefault(len(words), []).append((item_id, words))
                vocabulary.update(words)
        names = sorted(vocabulary)
        self.code_of = dict(zip(names, _word_codes(names).tolist()))
        self.groups: list[_Items] = []
        known: dict[int, list[np.ndarray]] = {}
        for size in sorted(by_size):
            width = min(shingle, size)
            ids, counts, prints = [], [], []
            for item_id, words in by_size[size]:
                s = _shingles(_word_codes(words), width)
                known.setdefault(width, []).append(s)
                ids.append(item_id)
                counts.append(Counter(s.tolist()))
                prints.append(_pack(_signs(s).sum(axis=0, keepdims=True))[0])
            group = _Items(size, width, ids, counts, np.array(prints))
            group.index(radius)
            self.groups.append(group)
        self.known = {w: np.unique(np.concatenate(s)) for w, s in known.items()}

    def search(self, text: str | None, threshold: float) -> list[tuple]:
        """(item id, start word, end word, bits apart, similarity) of the most
        similar window of each item found (ties: the first window)."""
        words = words_of(text)
        if not words or not self.groups:
            return []
        get = self.code_of.get
        known_word = np.fromiter((w in self.code_of for w in words), dtype=bool, count=len(words))
        runs = np.concatenate(([0], np.cumsum(~known_word)))
        anchors: dict[int, np.ndarray] = {}
        codes = None
        for width, shingles in self.known.items():
            if len(words) < width:
                continue
            start = np.flatnonzero(runs[width:] == runs[:-width])  # all words of the shingle are known
            if not len(start):
                continue
            if codes is None:
                codes = np.array([get(w, 0) for w in words], dtype=np.uint64)
            s = _shingles(codes, width)[start]
            at = np.searchsorted(shingles, s)
            hit = shingles[np.minimum(at, len(shingles) - 1)] == s
            if hit.any():
                anchors[width] = start[hit]
        if not anchors:
            return []
        codes = _word_codes(words)
        best: dict[object, tuple] = {}
        for group in self.groups:
            if group.width not in anchors:
                continue
            if len(words) < group.words:
                # fewer shingles than the threshold's share of the item's cannot be similar enough
                if len(words) - group.width + 1 >= threshold * (group.words - group.width + 1):
                    self._search_stretch(group, codes, 0, threshold, best)
                continue
            for a, b in _stretches(anchors[group.width], group.words, group.width, len(words)):
                self._search_stretch(group, codes[a:b], a, threshold, best)
        return [best[k] for k in sorted(best, key=str)]

    def _search_stretch(self, group: _Items, codes: np.ndarray, offset: int, threshold: float, best: dict) -> None:
        s = _shingles(codes, group.width)
        per = min(group.words - group.width + 1, len(s))  # a shorter text is a window of its own
        step = max(1, min(1 << 14, MAX_CELLS // len(group.ids)))  # windows at a time
        for a in range(0, len(s) - per + 1, step):
            part = s[a : a + step + per - 1]
            total = np.concatenate((np.zeros((1, 64), dtype=np.int32), np.cumsum(_signs(part), axis=0, dtype=np.int32)))
            w, i, bits = group.candidates(_pack(total[per:] - total[:-per]), self.radius)
            for w1, i1, d in zip(w.tolist(), i.tolist(), bits.tolist()):
                similar = weighted_similarity(Counter(part[w1 : w1 + per].tolist()), group.counts[i1])
                if similar >= threshold:
                    start = offset + a + w1
                    found = (group.ids[i1], start, start + per + group.width - 1, d, similar)
                    old = best.get(found[0])
                    if old is None or (-similar, start) < (-old[4], old[1]):
                        best[found[0]] = found


def _stretches(anchors: np.ndarray, size: int, width: int, n: int):
    """Word ranges holding all windows of ``size`` words with an anchor shingle."""
    low = np.maximum(anchors - (size - width), 0)
    high = np.minimum(anchors + size, n)
    cut = np.flatnonzero(low[1:] > high[:-1]) + 1
    for part_low, part_high in zip(np.split(low, cut), np.split(high, cut)):
        a, b = int(part_low[0]), int(part_high[-1])
        if b - a >= size:
            yield a, b
        elif n >= size:  # at an end of the text
            yield (0, size) if a == 0 else (n - size, n)


def _item_groups(benchmark: DataFrame, item_col: str, item_text: str, max_bytes: int):
    """The benchmark in groups of about ``max_bytes`` of text and MAX_ITEMS items,
    so that what is sent to the executors stays bounded however large the
    benchmark and however short its items are."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).filter("text is not null")
    n, total = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    groups = max(1, -(-int(total or 0) // max_bytes), -(-n // MAX_ITEMS))
    for g in range(groups):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g)
        yield [(r["item"], r["text"]) for r in part.collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    radius: int = 20,
    max_index_bytes: int = 8 << 20,
) -> DataFrame:
    """(id_col, item_col, start_word, end_word, hamming, similarity): a row for
    each row of ``docs`` and item that its text holds, with the most similar
    window (ties: the first).

    Words are runs of letters, digits and underscores, lower-cased.  An item of fewer
    words than a shingle is one shingle.  Null and empty texts and items match
    nothing; null ids stay null; repeated rows give repeated results, repeated
    items of one id the best window of them; other columns are not read.
    """
    spark = docs.sparkSession
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    out = None
    for items in _item_groups(benchmark, item_col, item_text, max_index_bytes):
        opened = shared(spark, BenchmarkIndex(items, shingle, radius))  # bounded by max_index_bytes

        def run(batches, opened=opened):
            index = opened()
            for b in batches:
                at, hits = [], []
                for k, text in enumerate(b.column(1).to_pylist()):
                    found = index.search(text, threshold)
                    at += [k] * len(found)
                    hits += found
                if hits:
                    item, start, end, bits, similar = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).take(pa.array(at)),
                            pa.array(item, item_type),
                            pa.array(start, pa.int32()),
                            pa.array(end, pa.int32()),
                            pa.array(bits, pa.int32()),
                            pa.array(similar, pa.float64()),
                        ],
                        names=["id", "item", "start_word", "end_word", "hamming", "similarity"],
                    )

        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            run, f"id {id_kind}, item {item_kind}, start_word int, end_word int, hamming int, similarity double"
        )
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start_word", "end_word", "hamming", "similarity")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    radius: int = 20,
    max_index_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; every column
    and every other row stays, in one pass without a shuffle for every
    ``max_index_bytes`` of benchmark."""
    for items in _item_groups(benchmark, item_col, item_text, max_index_bytes):
        opened = shared(docs.sparkSession, BenchmarkIndex(items, shingle, radius))  # bounded by max_index_bytes
        at = docs.columns.index(text_col)

        def run(batches, opened=opened, at=at):
            index = opened()
            for b in batches:
                yield b.filter(pa.array([not index.search(t, threshold) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

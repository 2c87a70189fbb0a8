"""Removal of repeated byte strings with sharded suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Every start position p is owned by an anchor: the least hash among the
short grams within the string from p on, the first of equals.  The anchor and
its distance from p follow from the string alone, so equal strings have equal
anchors; the starts owned by one anchor are a stretch, and with the bytes that
their strings cover they form a window.

Windows whose anchor occurs once hold nothing repeated.  Where all windows of an
anchor are equal, all their starts are repeated.  The remaining windows, one of
each text, are sharded by anchor: a shard builds the suffix array of its windows
(Larsson-Sadakane) and their common prefixes (Kasai), and starts that share
``length`` bytes with a neighbour are repeated.  An anchor with many different
windows (the edge of a passage that many documents share) is spread over several
shards.  Their sorted string hashes are merged by binary search to find the starts
that shards may share; for those, each shard's sorted strings themselves are merged,
again by binary search, so that bytes decide.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import run_bounds, staged
from crease.llm.suffix_arrays import common_prefixes, join_strings, suffix_array

GRAM = 32
HOT_KEYS = 200  # a key with more than this share of all windows is hot: there are fewer such keys
CHUNK = 1 << 20  # start positions handled at a time, so that long texts need bounded memory
_BASE = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)  # odd: invertible modulo 2^64
_powers: dict = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _powers[base] = tuple(out)
    return have


def string_hashes(x: np.ndarray, length: int, base: int = 0) -> np.ndarray:
    """A 64-bit hash of every string of ``length`` bytes."""
    n = len(x)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _power_table(_BASE[base], n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    h = (sums[length:] - sums[:-length]) * inverse[: n - length + 1]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    return h


def owned_stretches(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, last start and anchor hash of each stretch of start
    positions that one anchor owns."""
    starts = len(x) - length + 1
    gram = min(GRAM, length)
    span = length - gram + 1  # grams in a string
    h = string_hashes(x, gram)
    low = np.uint64((1 << 24) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # smallest hash, then first position
    width = 1
    while width * 2 <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < span:
        m = np.minimum(m[:starts], m[span - width : span - width + starts])
    at = (m[:starts] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], starts) - 1
    return first, last, h[at[first]]


def _windows(length: int):
    """(anchor, window, text, lo, hi) of every window of every text."""

    def run(batches):
        for b in batches:
            for text, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                for at in range(0, len(data) - length + 1, CHUNK):
                    part = data[at : at + CHUNK + length - 1]
                    lo, hi, anchor = owned_stretches(np.frombuffer(part, dtype=np.uint8), length)
                    digest = hashlib.blake2b
                    window = b"".join([digest(part[s : e + length], digest_size=8).digest() for s, e in zip(lo.tolist(), hi.tolist())])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor.view(np.int64)),
                            pa.array(np.frombuffer(window, dtype=np.int64)),
                            pa.array([key] * len(lo), pa.binary()),
                            pa.array((lo + at).astype(np.int32)),
                            pa.array((hi + at).astype(np.int32)),
                        ],
                        names=["anchor", "window", "text", "lo", "hi"],
                    )

    return run


def _cut(length: int):
    """Bytes of the wanted windows of each text, once a text."""

    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            for text, key, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if key in seen:
                    continue  # a copy
                seen.add(key)
                data = text.encode("utf-8", "surrogatepass")
                rows = [(w["anchor"], w["window"], w["n"], w["parts"], data[w["lo"] : w["hi"] + length]) for w in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    names=["anchor", "window", "n", "parts", "bytes"],
                )

    return run


_FOUND = "anchor long, window long, starts array<int>, ends array<int>, keys binary, places binary, bytes binary, part int"


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the start positions whose string of ``length`` bytes also
    starts elsewhere among the texts: suffix array, common prefixes, and groups
    of neighbours that share that many bytes."""
    joined, ends, begin = join_strings(texts)
    full = np.arange(len(joined)) + length <= ends  # the string lies within one text
    order = suffix_array(joined, ends)
    lcp = common_prefixes(joined, ends, order)
    group = np.cumsum(lcp < length)
    members = np.bincount(group, weights=full[order])
    repeated = np.zeros(len(joined), dtype=bool)
    repeated[order] = members[group] >= 2
    repeated &= full
    return [np.flatnonzero(repeated[s : s + len(t)]) for s, t in zip(begin.tolist(), texts)]


def _strings(x: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all strings of ``length`` bytes, from two independent ones."""
    return string_hashes(x, length) ^ (string_hashes(x, length, 1) * np.uint64(0x9E3779B97F4A7C15))


def _compared(texts: list[bytes], hashes: list[np.ndarray], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """Repeated starts of each window that occurs once.

    Windows are first cut down to the starts whose string hash occurs again, in
    a window that occurs once at one end; what is cut off cannot be repeated."""
    sizes = np.array([len(h) for h in hashes])
    row = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    _, group = np.unique(np.concatenate(hashes), return_inverse=True)
    often = np.bincount(group) > 1
    of_single = np.bincount(group, weights=counts[row] == 1) > 0
    keep = (often & of_single)[group]
    out = [np.zeros(0, dtype=np.int64) for _ in texts]
    starts, lens = run_bounds(row[keep])
    if not len(starts):
        return out
    rows, first, last = row[keep][starts], place[keep][starts], place[keep][starts + lens - 1]
    cut = [texts[r][a : b + length] for r, a, b in zip(rows.tolist(), first.tolist(), last.tolist())]
    for r, a, at in zip(rows.tolist(), first.tolist(), repeated_starts(cut, length)):
        out[r] = at + a
    return out


def _ranges(at: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last of each run of consecutive positions."""
    if not len(at):
        return [], []
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate(([0], cut + 1))].tolist(), at[np.append(cut, len(at) - 1)].tolist()


def _shard(length: int):
    """Repeated starts of a shard's windows; for anchors spread over several
    shards also the sorted hashes of all their strings, and the bytes."""

    def run(key, t):
        rows = sorted(zip(*[t.column(c).to_pylist() for c in ("anchor", "window", "n", "parts", "part", "bytes")]))
        rows = [r for k, r in enumerate(rows) if k == 0 or r[:2] != rows[k - 1][:2]]
        texts, counts = [r[5] for r in rows], np.array([r[2] for r in rows])
        hashes = [_strings(np.frombuffer(x, dtype=np.uint8), length) for x in texts]
        out = []
        for (anchor, window, n, parts, part, data), h, at in zip(rows, hashes, _compared(texts, hashes, counts, length)):
            if n > 1:  # the whole window occurs elsewhere
                at = np.arange(len(h))
            starts, ends = _ranges(at)
            keys = places = kept = None
            if parts > 1:
                order = np.argsort(h)
                keys, places, kept = h[order].tobytes(), order.astype(np.int32).tobytes(), data
            out.append((anchor, window, starts, ends, keys, places, kept, part))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.int32())
        names = ["anchor", "window", "starts", "ends", "keys", "places", "bytes", "part"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def _slices():
    """Cut the sorted hashes of a window into ``parts`` equal key ranges, the
    edges found by binary search."""

    def run(batches):
        for b in batches:
            out = []
            for anchor, window, keys, places, part, parts in zip(*[b.column(c).to_pylist() for c in ("anchor", "window", "keys", "places", "part", "parts")]):
                k = np.frombuffer(keys, dtype=np.uint64)
                p = np.frombuffer(places, dtype=np.int32)
                edges = np.searchsorted(k, np.array([(s << 64) // parts for s in range(1, parts)], dtype=np.uint64))
                edges = np.concatenate(([0], edges, [len(k)]))
                for s in range(parts):
                    a, e = int(edges[s]), int(edges[s + 1])
                    if e > a:
                        out.append((anchor, s, window, part, k[a:e].tobytes(), p[a:e].tobytes()))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["anchor", "slice", "window", "part", "keys", "places"])

    return run


def _merge():
    """Strings of one anchor and key range whose hash occurs in several shards."""

    def run(key, t):
        windows, parts = t.column("window").to_pylist(), np.array(t.column("part").to_pylist())
        keys = [np.frombuffer(x, dtype=np.uint64) for x in t.column("keys").to_pylist()]
        places = [np.frombuffer(x, dtype=np.int32) for x in t.column("places").to_pylist()]
        shards = [np.unique(np.concatenate([keys[k] for k in np.flatnonzero(parts == p)])) for p in np.unique(parts)]
        merged = np.sort(np.concatenate(shards))  # as often as shards have it
        out = []
        for w, k, p in zip(windows, keys, places):
            many = np.searchsorted(merged, k, side="right") - np.searchsorted(merged, k, side="left") > 1
            if many.any():
                starts, ends = _ranges(np.sort(p[many]))
                out.append((key[0].as_py(), w, starts, ends))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=["anchor", "window", "starts", "ends"])

    return run


def _shared_strings(length: int):
    """The string of every candidate start of a window, dealt by its hash."""

    def run(batches):
        for b in batches:
            out = []
            for anchor, window, part, parts, data, starts, ends in zip(*[b.column(c).to_pylist() for c in ("anchor", "window", "part", "parts", "bytes", "starts", "ends")]):
                for a, z in zip(starts, ends):
                    for p in range(a, z + 1):
                        text = data[p : p + length]
                        out.append((anchor, zlib.crc32(text) % (8 * parts), window, part, p, text))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["anchor", "slice", "window", "part", "place", "string"])

    return run


def _confirm():
    """Starts whose string, byte by byte, another shard has too: each shard's
    strings sorted and merged, and every start looked up by binary search."""

    def run(key, t):
        rows = list(zip(*[t.column(c).to_pylist() for c in ("window", "part", "place", "string")]))
        shards: dict[int, set[bytes]] = {}
        for _, part, _, text in rows:
            shards.setdefault(part, set()).add(text)
        merged = sorted(x for strings in shards.values() for x in strings)  # as often as shards have it
        places: dict[int, list[int]] = {}
        for window, _, place, text in rows:
            at = bisect.bisect_left(merged, text)
            if at + 1 < len(merged) and merged[at + 1] == text:
                places.setdefault(window, []).append(place)
        out = [(key[0].as_py(), window, *_ranges(np.array(sorted(at)))) for window, at in places.items()]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=["anchor", "window", "starts", "ends"])

    return run


def removed_spans(lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) covered by the strings that start in any of the
    stretches lo..hi."""
    order = np.argsort(lo, kind="stable")
    begin, end = lo[order], np.maximum.accumulate(hi[order] + length)
    new = np.concatenate(([True], begin[1:] > end[:-1]))
    at = np.flatnonzero(new)
    return begin[at], end[np.append(at[1:] - 1, len(end) - 1)]


def _hot_join(rows: DataFrame, by_key: DataFrame, on: list[str], key: str, hot: list[int]) -> DataFrame:
    """Inner join of ``rows`` with ``by_key``, which has a row for each key.  Rows
    of the ``hot`` keys, fewer than HOT_KEYS, stay where they are and meet a
    broadcast of those keys, so that no task gets all rows of one."""
    if not hot:
        return rows.join(by_key, on)
    is_hot = F.col(key).isin(hot)
    return rows.filter(~is_hot).join(by_key.filter(~is_hot), on).unionByName(rows.filter(is_hot).join(F.broadcast(by_key.filter(is_hot)), on))


def repeated_stretches(texts: DataFrame, length: int, shard_windows: int = 2048) -> DataFrame:
    """``texts``: (text string, key binary: equal for equal texts alone).  Returns
    (key, stretches array<struct<lo, hi>>) for every key with repeated strings:
    the start positions, in bytes, whose string starts elsewhere too."""
    spark = texts.sparkSession
    windows = staged(
        texts.filter(F.octet_length("text") >= length).select("text", "key").mapInArrow(_windows(length), "anchor long, window long, text binary, lo int, hi int"),
        "windows",
    )
    anchors = windows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("window").alias("a"), F.max("window").alias("b"))
    anchors = staged(anchors.filter("n > 1").select("anchor", "n", (F.col("a") != F.col("b")).alias("varied")), "anchors")
    many = max(shard_windows, windows.count() // HOT_KEYS)  # windows of a key that is hot
    hot = [r["anchor"] for r in anchors.filter(F.col("n") > many).select("anchor").collect()]  # fewer than HOT_KEYS
    hits = staged(_hot_join(windows, anchors.drop("n"), ["anchor"], "anchor", hot), "hits")

    # one window of each text, of the anchors that have different ones
    variants = hits.filter("varied").groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text", "lo", "hi")).alias("one"))
    variants = staged(variants, "variants")
    spread = variants.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_windows)).cast("int").alias("parts")).filter("parts > 1")
    spread = staged(spread, "spread")
    variants = variants.join(spread, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    shards = max(1, -(-variants.count() // shard_windows))
    wanted = variants.groupBy(F.col("one.text").alias("of")).agg(
        F.collect_list(F.struct("anchor", "window", "n", "parts", F.col("one.lo").alias("lo"), F.col("one.hi").alias("hi"))).alias("wanted")
    )
    cut = texts.join(staged(wanted, "wanted"), F.col("key") == F.col("of")).select("text", "key", "wanted")
    cut = cut.mapInArrow(_cut(length), "anchor long, window long, n long, parts int, bytes binary")
    cut = cut.withColumn("part", F.pmod(F.xxhash64("window"), F.col("parts")).cast("int"))
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("anchor", "part"), F.lit(shards)))
    found = staged(cut.groupBy("shard").applyInArrow(_shard(length), _FOUND), "shards")

    ranges = found.select("anchor", "window", "starts", "ends")
    if not spread.isEmpty():
        exported = found.filter("keys is not null").drop("starts", "ends").join(spread, "anchor")
        across = exported.mapInArrow(
            _slices(), "anchor long, slice int, window long, part int, keys binary, places binary"
        )
        kind = "anchor long, window long, starts array<int>, ends array<int>"
        hashed = staged(across.groupBy("anchor", "slice").applyInArrow(_merge(), kind), "candidates")
        hashed = hashed.groupBy("anchor", "window").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
        strings = exported.drop("keys", "places").join(hashed, ["anchor", "window"]).mapInArrow(
            _shared_strings(length), "anchor long, slice long, window long, part int, place int, string binary"
        )
        ranges = ranges.unionByName(strings.groupBy("anchor", "slice").applyInArrow(_confirm(), kind))
    ranges = ranges.filter(F.size("starts") > 0)
    ranges = ranges.groupBy("anchor", "window").agg(F.collect_list(F.arrays_zip("starts", "ends")).alias("r"))
    ranges = ranges.select("anchor", "window", F.flatten("r").alias("r"))

    hot = [r["window"] for r in variants.filter(F.col("n") > many).select("window").distinct().collect()]  # fewer than HOT_KEYS
    some = _hot_join(hits.filter("varied"), staged(ranges, "ranges"), ["anchor", "window"], "window", hot)
    some = some.select("text", "lo", F.explode("r").alias("r"))
    some = some.select("text", (F.col("lo") + F.col("r.starts")).alias("s"), (F.col("lo") + F.col("r.ends")).alias("e"))
    every = hits.filter("not varied").select("text", F.col("lo").alias("s"), F.col("hi").alias("e")).unionByName(some)
    # copies of a text have the same stretches: a set is bounded by the text
    return every.groupBy(F.col("text").alias("key")).agg(F.collect_set(F.struct(F.col("s").alias("lo"), F.col("e").alias("hi"))).alias("stretches"))


def _strip(length: int):
    def run(batches):
        for b in batches:
            out = []
            for text, stretches in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                begin, end, kept = (), (), data
                if stretches:
                    lo, hi = np.array([(s["lo"], s["hi"]) for s in stretches], dtype=np.int64).T
                    begin, end = (v.tolist() for v in removed_spans(lo, hi, length))
                    edges = [0, *[x for span in zip(begin, end) for x in span], len(data)]
                    kept = b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                spans = [{"start": s, "end": e} for s, e in zip(begin, end)]
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
            cols = zip(*out) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["id", "n_bytes", "n_removed", "spans", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, shard_windows: int = 2048) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, spans): a row per row.

    Every byte covered by a string of ``length`` bytes that also starts anywhere
    else in the table, the same text included, is removed; spans are the maximal
    removed runs [start, end) in bytes.  Strings are judged on the input, and
    rows with equal texts repeat each other whole.  A null text is empty; texts
    shorter than ``length`` lose nothing; null and repeated ids keep their rows;
    other columns are not read; an empty table gives an empty table.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    # a table of its own, so that adaptive execution can split a text with very many copies
    found = staged(repeated_stretches(rows, length, shard_windows).withColumnRenamed("key", "of"), "stretches")
    joined = rows.join(found, F.col("key") == F.col("of"), "left").select("id", "text", "stretches")
    kind = docs.schema[id_col].dataType.simpleString()
    out = joined.mapInArrow(_strip(length), f"id {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string")
    return out.select(
        F.col("id").alias(id_col), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans"
    )

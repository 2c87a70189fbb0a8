"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai common prefixes.

The text is one or several strings, each followed by a zero byte; ``ends``
gives for every position the place of the zero byte that ends its string.  A
suffix stops there: it is smaller than its continuations, and of suffixes that
are equal up to their ends the one of the earlier string comes first.
"""

from __future__ import annotations

import numpy as np


def join_strings(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, ends, begin of each string)."""
    text = np.frombuffer(b"".join(s + b"\0" for s in strings), dtype=np.uint8)
    size = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    stop = np.cumsum(size)
    return text, np.repeat(stop - 1, size), stop - size


def byte_keys(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number, zero from
    the end of the string on."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key |= padded[k : k + n] << np.uint64(56 - 8 * k)
    left = ends - np.arange(n)
    short = np.flatnonzero(left < 8)
    drop = (8 * (8 - left[short])).astype(np.uint64)
    key[short] = np.where(left[short] > 0, key[short] >> np.minimum(drop, 63) << np.minimum(drop, 63), 0)
    return key


def _sorted_places(major: np.ndarray, minor: np.ndarray, minor_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of (major, minor), and whether each differs from the
    one before.  Where all fits into 64 bits, plain numbers are sorted."""
    m = len(major)
    at_bits = max(1, int(m).bit_length())
    pair = (major.astype(np.uint64) << np.uint64(minor_bits)) | minor.astype(np.uint64)
    if int(pair.max(initial=0)).bit_length() + at_bits <= 64:
        packed = (pair << np.uint64(at_bits)) | np.arange(m, dtype=np.uint64)
        packed.sort()
        by = (packed & np.uint64((1 << at_bits) - 1)).astype(np.int64)
        pair = packed >> np.uint64(at_bits)
    else:
        by = np.argsort(pair)
        pair = pair[by]
    changed = np.ones(m, dtype=bool)
    changed[1:] = pair[1:] != pair[:-1]
    return by, changed


def suffix_array(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order.

    Larsson and Sadakane: suffixes are sorted by their first bytes, then the
    groups that are still equal, and only those, by the rank of the suffix h
    further on, h doubling."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    h = 5
    kind = np.int32 if n < 1 << 30 else np.int64
    ends = ends.astype(kind)
    string = np.cumsum(np.concatenate(([0], (ends[1:] != ends[:-1]).astype(kind))), dtype=kind)
    strings = int(string[-1]) + 1
    order, new = _sorted_places(byte_keys(text, ends) >> np.uint64(24), np.zeros(n, dtype=np.uint64), 0)
    rank = np.empty(n, dtype=kind)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # start of the group of each place
    open_at = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in groups of more than one
    zeros = int((text == 0).sum()) > strings  # zero bytes within strings look like ends
    while len(open_at):
        suffix = order[open_at]
        after = suffix + h
        # beyond its end a suffix is smaller than those that go on: the shorter
        # one first (equal ones have equal lengths unless there are zero bytes)
        ended, base = string[suffix], strings
        if zeros:
            ended, base = ended + strings * np.minimum(ends[suffix] - suffix, h), strings * (h + 1)
        second = np.where(after <= ends[suffix], base + rank[np.minimum(after, n - 1)], ended)
        bits = int(base + n).bit_length()
        by, changed = _sorted_places(rank[suffix], second, bits)
        suffix = suffix[by]
        order[open_at] = suffix  # groups are contiguous and keep their places
        rank[suffix] = np.maximum.accumulate(np.where(changed, open_at, 0))
        open_at = open_at[~(changed & np.append(changed[1:], True))]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, ends: np.ndarray, order: np.ndarray, stretch: int = 48) -> np.ndarray:
    """Length of the common prefix, within their strings, of each suffix in
    ``order`` with the one before it (the first: 0).

    Kasai et al.: the value of suffix i+1 is at least that of i less one.  The
    recurrence runs along many stretches of the text at the same time."""
    n = len(text)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    key = byte_keys(text, ends)
    left = ends - np.arange(n)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    value = np.zeros(n, dtype=np.int64)
    stretch = min(stretch, n)
    first = np.arange(0, n, stretch)
    length = np.zeros(len(first), dtype=np.int64)
    for t in range(stretch):
        i = first + t
        if i[-1] >= n:
            i = i[:-1]
        j = before[i]
        most = np.minimum(left[i], left[j])
        most[j < 0] = 0
        length = np.minimum(np.maximum(length[: len(i)] - 1, 0), most)
        # most prefixes end here: look at one byte before comparing eight at a time
        active = np.flatnonzero((length < most) & (text[i + length] == text[j + length]))
        while len(active):
            m, room = length[active], most[active]
            x = key[i[active] + m] ^ key[j[active] + m]
            same = np.full(len(active), 8, dtype=np.int64)
            for k in range(7, -1, -1):  # equal leading bytes
                same[(x >> np.uint64(56 - 8 * k)) != 0] = k
            length[active] = np.minimum(m + same, room)
            active = active[(same == 8) & (m + 8 < room)]
        value[i] = length
    return value[order]

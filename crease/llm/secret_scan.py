"""Secret scans: fixed patterns plus character Markov models.

Two first-order models over the characters of a token, one of random strings
and one of ordinary identifiers, are trained from labelled samples; a stretch of a
token whose log-likelihood ratio is high enough is a secret, whatever ordinary
name or path is written around it.  Training counts transitions on the executors
and returns two small matrices.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import hashed_share

# fixed values: the contract's patterns, in its order
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same as runs of any length kept from 32 on
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN, MIN_ACCESS = 8, 16

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SYMBOLS = len(ALPHABET)
CODE = {c: k for k, c in enumerate(ALPHABET)}
SEPARATORS = "/_.=-"
PIECE = re.compile(r"[^/_.=-]+")
MIN_TOKEN = 16
# nats of a stretch and of its transitions, chosen on documents outside the training sample
MIN_SCORE, MIN_MEAN = 14.0, 0.6
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_TOKEN)
WORD = re.compile(r"[A-Za-z0-9+/_.=-]{4,}")


def base_matches(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, kind index, value, value start, end) of the pattern matches."""
    found = []
    if ":" in text or "=" in text:  # the pattern needs one of them
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_ASSIGN:
                found.append((m.start(), 0, m[2], m.start(2), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= MIN_ACCESS:
                found.append((m.start(), 1, m[0], m.start(), m.end()))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m[0], m.start(), m.end()))
    return sorted(found)


class Reach:
    """For sorted (start, ..., end) spans: how far those reach that start before
    a place.  One bisection a question, however many spans a text has."""

    def __init__(self, spans: list[tuple]):
        self.starts = [s[0] for s in spans]
        self.ends = list(itertools.accumulate((s[-1] for s in spans), max))

    def before(self, place: int) -> int:
        """The largest end among the spans that start before ``place`` (0: none)."""
        k = bisect.bisect_left(self.starts, place)
        return self.ends[k - 1] if k else 0

    def holds(self, start: int, end: int) -> bool:
        return self.before(start + 1) >= end

    def meets(self, start: int, end: int) -> bool:
        return self.before(end) > start


def _codes(token: str) -> np.ndarray:
    return np.array([CODE[c] for c in token], dtype=np.int64)


@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihood ratio of each transition, random over ordinary."""

    ratio: np.ndarray

    @staticmethod
    def from_counts(random: np.ndarray, ordinary: np.ndarray, prior: float = 10.0) -> MarkovModels:
        """Row-normalised counts; rows with few counts lean on how often the next
        character occurs at all (as ``prior`` more counts)."""

        def log_p(c: np.ndarray) -> np.ndarray:
            overall = c.sum(axis=0) + 0.5
            return np.log((c + prior * overall / overall.sum()) / (c.sum(axis=1, keepdims=True) + prior))

        return MarkovModels(log_p(random) - log_p(ordinary))

    def score(self, token: str) -> float:
        """Nats by which the random model explains the token better."""
        return float(self.gains(token).sum())

    def gains(self, token: str) -> np.ndarray:
        """The nats of each transition."""
        c = _codes(token)
        return self.ratio[c[:-1], c[1:]]


def best_stretches(gains: np.ndarray, least: float) -> list[tuple[int, int]]:
    """The disjoint maximal stretches [a, b) of ``gains`` (Ruzzo and Tompa) that
    sum to ``least`` or more, by start; linear time."""
    sums = np.concatenate(([0.0], np.cumsum(gains)))
    if (sums - np.minimum.accumulate(sums)).max() < least:
        return []
    sums = sums.tolist()
    parts: list[tuple[int, int, int]] = []  # start, end, the last part before it that starts lower (-1: none)
    for k, gain in enumerate(gains.tolist()):
        if gain <= 0:
            continue
        a, b = k, k + 1
        while True:
            j = len(parts) - 1
            while j >= 0 and sums[parts[j][0]] >= sums[a]:
                j = parts[j][2]
            if j < 0 or sums[parts[j][1]] >= sums[b]:
                parts.append((a, b, j))
                break
            a = parts[j][0]
            del parts[j:]
    return [(a, b) for a, b, _ in parts if sums[b] - sums[a] >= least]


def secret_stretches(token: str, models: MarkovModels, min_score: float, min_mean: float) -> list[tuple[int, int]]:
    """[start, end) of the parts of a token that the models call random.

    A part is a maximal stretch of transitions, each less ``min_mean``, with
    ``min_score`` nats, so that a long ordinary name between two secrets hides neither;
    where there is none, a maximal stretch with that score and mean.  A part reaches
    out to the separators around it, so that no end of a secret is left behind,
    but not over pieces at its ends that are ordinary by themselves; it has
    MIN_TOKEN characters at least."""
    gains = models.gains(token)
    found: list[tuple[int, int]] = []
    for a, b in best_stretches(gains, min_score):
        inner = [(a + x, a + y) for x, y in best_stretches(gains[a:b] - min_mean, 0.0)]
        inner = [(x, y) for x, y in inner if gains[x:y].sum() >= min_score]
        if not inner and gains[a:b].sum() >= min_mean * (b - a + 1):
            inner = [(a, b)]
        found += inner
    out: list[tuple[int, int]] = []
    for a, b in found:
        a, b = _whole_pieces(token, gains, a, b + 1)
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))  # two stretches of one piece
        else:
            out.append((a, b))
    return [(a, b) for a, b in out if b - a >= MIN_TOKEN]


def _whole_pieces(token: str, gains: np.ndarray, a: int, b: int) -> tuple[int, int]:
    """[a, b) out to the separators around it, without those at its ends and
    without the pieces there that are ordinary by themselves."""
    while a > 0 and token[a - 1] not in SEPARATORS:
        a -= 1
    while b < len(token) and token[b] not in SEPARATORS:
        b += 1
    pieces = [m.span() for m in PIECE.finditer(token, a, b)]
    ordinary = [bool(gains[x : y - 1].sum() < 0) for x, y in pieces]
    if all(ordinary):
        return a, b
    last = len(pieces) - 1 - ordinary[::-1].index(False)
    return pieces[ordinary.index(False)][0], pieces[last][1]


SHAPED_WORDS = 40  # words of a text that names are made of
SHAPED_IDS = 4  # identifiers in the common 8-4-4-4-12 form for each text
SEQUENCES = (ALPHABET[26:52], ALPHABET[:26], ALPHABET[52:62])


def shaped_strings(text: str) -> Iterator[str]:
    """Ordinary strings with digits and capitals, made from a text's own words by
    rule: names in camel, Pascal, snake and upper case, paths and settings,
    identifiers, numbers, dates, versions and the alphabets.  Texts hold few of them, and a model that never saw
    one takes every digit or inner capital for a sign of a random string."""
    words = [w for w in text.split() if w.isascii() and w.isalpha()][:SHAPED_WORDS]
    for k in range(SHAPED_IDS):
        h = hashlib.md5(f"{k} {' '.join(words[:20])}".encode()).hexdigest()
        yield "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))
    n = int(h[:15], 16)
    yield str(n)[:16]
    yield f"{1900 + n % 200}-{1 + n % 12:02d}-{1 + n % 28:02d}"
    yield f"{n % 10}.{n % 100}.{n % 1000}"
    yield from SEQUENCES
    for k in range(0, len(words) - 3, 4):
        part = [w.lower() for w in words[k : k + 4]]
        capital = [w.capitalize() for w in part]
        yield part[0] + "".join(capital[1:])
        yield "".join(capital)
        yield "_".join(part) + str(n % 100)
        yield "_".join(part).upper()
        yield "//" + ".".join(part[:2]) + "/" + "/".join(part[2:]) + "/"
        yield f"{part[0]}-{part[1]}={part[2]}+{part[3]}"


def labelled_strings(text: str) -> Iterator[tuple[str, bool]]:
    """Labelled samples in a text: values matched by the fixed patterns are
    random; tokens without a digit and :func:`shaped_strings` are ordinary."""
    spans = []
    for _, _, value, start, end in base_matches(text):
        yield value, True
        spans.append((start, end))
    secrets = Reach(sorted(spans))
    for m in WORD.finditer(text):
        if not any(c.isdigit() for c in m[0]) and not secrets.meets(m.start(), m.end()):
            yield m[0], False
    for made in shaped_strings(text):
        yield made, False


def train(samples: DataFrame, text_col: str = "text") -> MarkovModels:
    """Train from the labelled strings in every text of ``samples``.  Texts are
    whole; null ones count as empty.  No sample at all gives a ratio of 0."""

    def count(batches):
        for b in batches:
            counts = np.zeros((2, SYMBOLS * SYMBOLS), dtype=np.int64)
            for text in b.column(0).to_pylist():
                pieces = ([], [])
                for s, random in labelled_strings(text or ""):
                    pieces[random].append(s)
                for label, strings in enumerate(pieces):
                    for s in strings:
                        c = _codes(s)
                        np.add.at(counts[label], c[:-1] * SYMBOLS + c[1:], 1)
            label, pair = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(counts[label, pair])], names=["label", "pair", "n"])

    found = samples.select(F.col(text_col)).mapInArrow(count, "label int, pair int, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, SYMBOLS * SYMBOLS))
    for r in found.collect():  # at most 2 x 68 x 68 numbers
        counts[r["label"], r["pair"]] = r["n"]
    return MarkovModels.from_counts(counts[1].reshape(SYMBOLS, SYMBOLS), counts[0].reshape(SYMBOLS, SYMBOLS))


def labelled_counts(samples: DataFrame, models: MarkovModels, text_col: str = "text", min_score: float = MIN_SCORE, min_mean: float = MIN_MEAN) -> DataFrame:
    """(random, n, n_found): of the labelled strings of at least MIN_TOKEN
    characters in ``samples``, how many the models call random -- recall of the random
    ones, and what the ordinary ones cost in precision.  For documents that the
    models were not trained on."""

    def count(batches):
        totals = np.zeros((2, 2), dtype=np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                for s, random in labelled_strings(text or ""):
                    if len(s) >= MIN_TOKEN:
                        totals[int(random)] += (1, bool(secret_stretches(s, models, min_score, min_mean)))
        yield pa.RecordBatch.from_arrays([pa.array([False, True]), pa.array(totals[:, 0]), pa.array(totals[:, 1])], names=["random", "n", "n_found"])

    found = samples.select(F.col(text_col)).mapInArrow(count, "random boolean, n long, n_found long")
    return found.groupBy("random").agg(F.sum("n").alias("n"), F.sum("n_found").alias("n_found"))


def training_sample(docs: DataFrame, id_col: str, max_documents: int, seed: int = 5) -> DataFrame:
    """About ``max_documents`` documents, drawn by a hash of the id."""
    n = docs.count()
    return docs.filter(hashed_share(F.col(id_col), max_documents / max(1, n), seed))


def spans_of(text: str, models: MarkovModels, min_score: float, min_mean: float) -> list[tuple[int, int, int]]:
    """(start, kind index, end): the base spans, and the parts of tokens that the
    models call random outside of them."""
    base = [(start, kind, end) for start, kind, _, _, end in base_matches(text)]
    known = Reach(base)
    added = []
    for m in TOKEN.finditer(text):
        if known.holds(m.start(), m.end()):
            continue
        for a, b in secret_stretches(m[0], models, min_score, min_mean):
            if not known.holds(m.start() + a, m.start() + b):
                added.append((m.start() + a, 3, m.start() + b))
    return sorted(base + added)


def find_secrets(
    docs: DataFrame,
    models: MarkovModels,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_score: float = MIN_SCORE,
    min_mean: float = MIN_MEAN,
) -> DataFrame:
    """(id_col, spans): a row per row; spans is an array of (kind, start, end) in
    code points, end exclusive, by start and then kind (assign, access, hex,
    markov).  Null and empty texts have none; ids may be null or repeated; other
    columns are not read."""

    def run(batches):
        for b in batches:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t, models, min_score, min_mean)] if t else []
                for t in b.column(1).to_pylist()
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, spans array<struct<kind:string,start:long,end:long>>"
    )
    return out.select(F.col("id").alias(id_col), "spans")


def joined(spans) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "<secret>") -> str:
    """The text with each span (start, end) replaced, overlaps merged."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from the spans."""
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        id_col,
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        n("markov").alias("n_markov"),
    )


def sha256_of(spans: list[tuple[int, int, int]]) -> str:
    """base_sha256 of (start, kind index, end) spans, as digest_columns gives it."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans) if k < 3).encode()).hexdigest()

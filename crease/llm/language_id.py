"""Language ID with language-bitmask n-gram filters.

The profile of a language is its most frequent character n-grams.  All profiles
go into one bit-sliced Bloom filter: a slot holds one bit per language, so the
AND of an n-gram's slots returns every language that (probably) contains it.
A text's n-grams are counted per language, each count is corrected for the
filter's false positives, and the language with the largest share decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm.common import shared, staged

UNKNOWN = "und"
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_letters: dict = {}


def _is_letter(cp: np.ndarray) -> np.ndarray:
    """Unicode letters among code points."""
    if "bmp" not in _letters:
        _letters["bmp"] = np.array([chr(c).isalpha() for c in range(1 << 16)])
    out = _letters["bmp"][np.minimum(cp, 0xFFFF)]
    high = cp > 0xFFFF
    if high.any():
        out[high] = [chr(c).isalpha() for c in cp[high].tolist()]
    return out


def ngrams(text: str, n: int) -> np.ndarray:
    """Codes of the text's character n-grams: lower case, one space for every
    stretch of other characters, one at each end.  No letter: none."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(cp):
        return np.zeros(0, dtype=np.uint64)
    letter = _is_letter(cp)
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character of a stretch stays as its space
    s = np.where(letter, cp, 32)[keep].astype(np.uint64)
    s = np.concatenate(([32], s, [32])).astype(np.uint64)
    if s[-2] == 32:
        s = s[:-1]
    if len(s) < n:
        return np.zeros(0, dtype=np.uint64)
    code = np.zeros(len(s) - n + 1, dtype=np.uint64)
    for k in range(n):
        code = (code + s[k : k + len(code)]) * _MULT[0]
        code ^= code >> np.uint64(31)
    return code


def _bit(k: int) -> np.uint64:
    return np.uint64(1) << np.uint64(k % 64)


@dataclass(frozen=True)
class LanguageFilter:
    """languages: names, by bit; slots: bitmasks, a row per slot (a power of two
    of them) and a 64-bit column for every 64 languages; hashes: slots per n-gram;
    n: n-gram length."""

    languages: tuple[str, ...]
    slots: np.ndarray
    hashes: int
    n: int

    @staticmethod
    def build(profiles: dict[str, np.ndarray], n: int, hashes: int = 3, slots_per_gram: int = 12) -> LanguageFilter:
        names = tuple(sorted(profiles))
        largest = max((len(p) for p in profiles.values()), default=1)
        size = 1 << int(np.ceil(np.log2(max(64, largest * slots_per_gram))))
        out = LanguageFilter(names, np.zeros((size, max(1, -(-len(names) // 64))), dtype=np.uint64), hashes, n)
        for k, name in enumerate(names):
            for at in out._slots_of(profiles[name]):
                np.bitwise_or.at(out.slots[:, k // 64], at, _bit(k))
        return out

    def _slots_of(self, code: np.ndarray):
        shift = np.uint64(64 - int(len(self.slots)).bit_length() + 1)
        for k in range(self.hashes):
            yield ((code * _MULT[k]) >> shift).astype(np.int64)

    def members(self, code: np.ndarray) -> np.ndarray:
        """Bitmask of the languages containing each n-gram: a 64-bit number, or a
        Python integer where there are more languages."""
        mask = self._masks(code)
        if mask.shape[1] == 1:
            return mask[:, 0]
        return np.array([sum(x << 64 * k for k, x in enumerate(row)) for row in mask.tolist()] + [None], dtype=object)[:-1]

    def _masks(self, code: np.ndarray) -> np.ndarray:
        """The bitmasks in columns of 64 languages."""
        mask = np.full((len(code), self.slots.shape[1]), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in self._slots_of(code):
            mask &= self.slots[at]
        return mask

    def false_positives(self) -> np.ndarray:
        """Chance per language that an n-gram outside its profile passes."""
        set_ = np.array([np.count_nonzero(self.slots[:, k // 64] & _bit(k)) for k in range(len(self.languages))])
        return (set_ / len(self.slots)) ** self.hashes

    def shares(self, text: str | None, fp: np.ndarray) -> np.ndarray | None:
        """Per language: the share of the text's n-grams in its profile,
        corrected for false positives.  None where there is no letter."""
        code = ngrams(text, self.n) if text else ()
        if not len(code):
            return None
        total = np.zeros(len(self.languages))
        for a in range(0, len(code), 1 << 18):
            mask = self._masks(code[a : a + (1 << 18)])
            for k in range(len(self.languages)):
                total[k] += np.count_nonzero(mask[:, k // 64] & _bit(k))
        return np.clip((total / len(code) - fp) / (1 - fp), 0.0, 1.0)


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    n: int = 3,
    profile_grams: int = 2000,
    max_documents: int = 5000,
    seed: int = 3,
) -> LanguageFilter:
    """Learn profiles from a bounded sample: about ``max_documents`` whole
    documents per language (all, if there are fewer), drawn by a hash of the id.
    Rows with a null text or language teach nothing.  A profile is the
    ``profile_grams`` n-grams found in most documents (ties by code)."""
    usable = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    sizes = staged(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("documents")), "languages")  # one row a language
    share = F.least(F.lit(1.0), F.lit(float(max_documents)) / F.col("documents"))
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 32)) < F.floor(share * F.lit(float(1 << 32)))

    def count(batches):
        for b in batches:
            by: dict[str, list] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(np.unique(ngrams(text, n)))
            for lang, grams in by.items():
                code, docs = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code)), pa.array(code.view(np.int64)), pa.array(docs.astype(np.int64))], names=["lang", "code", "docs"]
                )

    grams = usable.join(sizes, "lang").filter(drawn).select("text", "lang").mapInArrow(count, "lang string, code long, docs long")
    totals = grams.groupBy("lang", "code").agg(F.sum("docs").alias("docs"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("docs"), "code"))
    top = totals.withColumn("rank", rank).filter(F.col("rank") <= profile_grams).select("lang", "code").collect()
    profiles: dict[str, list] = {r["lang"]: [] for r in sizes.select("lang").collect()}
    for r in top:
        profiles[r["lang"]].append(r["code"])
    return LanguageFilter.build({k: np.sort(np.array(v, dtype=np.int64)).view(np.uint64) for k, v in profiles.items()}, n)


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score added, from the text alone.

    lang_pred: the language with the largest corrected share (ties: first by
    name), 'und' for a null text or one without a letter, or when the model
    knows no language; score: that share, 0 for 'und'.  Every row and column
    stays; columns that were already called lang_pred or score are replaced.
    """
    opened = shared(docs.sparkSession, model)  # for each language a profile of a fixed size

    def run(batches):
        m = opened()
        fp = m.false_positives()
        for b in batches:
            names, scores = [], []
            for text in b.column("__text").to_pylist():
                share = m.shares(text, fp) if m.languages else None
                best = int(share.argmax()) if share is not None else -1
                names.append(m.languages[best] if best >= 0 else UNKNOWN)
                scores.append(float(share[best]) if best >= 0 else 0.0)
            keep = [k for k, f in enumerate(b.schema.names) if f != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*[b.schema.names[k] for k in keep], "lang_pred", "score"],
            )

    rest = docs.drop("lang_pred", "score")
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rest.withColumn("__text", F.col(text_col)).mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """The contract's fold: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


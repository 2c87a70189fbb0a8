"""Exact token counts of every prefix of a text, by dynamic programming.

A BPE tokenizer with merges that make every token in one way has this property:
a sequence of tokens is the encoding of its text if each two neighbours are the
encoding of their joint text.  So the last token of a prefix is the only token
that ends there and fits the last token of the shorter prefix before it, and
tokens(prefix) = tokens(shorter prefix) + 1.  Where the last token of a word has
a form of its own (a suffix such as ``</w>``), a second state per prefix holds the
count with the word ending there; shorter prefixes use the first state only.

Texts are cut into words as the tokenizer cuts them.  Counts of a word's prefixes
are added to those of the words before it, so the table of a text holds the
tokens of each of its prefixes, each taken as a text of its own.  Truncation and
budget questions are answered from that table; no text is encoded again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm.common import shared
from crease.llm.scans import running_sums

PIECE = 1 << 16  # prefixes in a row of the table
MEMO = 600_000  # words (twice), prefixes and pairs of tokens remembered by a worker
MEMO_CHARS = 32  # longest remembered prefix
WORD_CHARS = 60  # a word up to this length has fewer than 256 tokens
NO_CUT = -1  # a place inside characters that are normalised together


def _by_ends(inner: dict[str, int], final: dict[str, int]) -> tuple:
    """Tokens by their symbols from the last one back: a node is (nodes by the symbol
    before, the token that these symbols are inside a word, and at its end)."""
    root: list = [{}, None, None]
    for kind, tokens in ((1, inner), (2, final)):
        for symbols, token in tokens.items():
            node = root
            for c in reversed(symbols):
                node = node[0].setdefault(c, [{}, None, None])
            node[kind] = token
    return tuple(root)


class Bpe:
    """The merges of a tokenizer, and the states of word prefixes."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("a plain BPE model is needed")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.inner: dict[str, int] = {}  # symbols -> token that does not end a word
        self.final: dict[str, int] = {}  # symbols -> token that ends one
        self.symbols: dict[int, str] = {}
        self.ends: set[int] = set()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> place of its merge and token made
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> place of its merge and the pair
        for c in (c for c in vocab if len(c) == 1):
            self.inner[c] = vocab[c]
            self.symbols[vocab[c]] = c
            if suffix and c + suffix in vocab:
                self._end(vocab[c + suffix], c)
        for k, pair in enumerate(model["merges"]):
            pair = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = vocab[pair[0]], vocab[pair[1]], vocab["".join(pair)]
            symbols = self.symbols[left] + self.symbols[right]
            if made in self.symbols:
                raise ValueError(f"two merges make {symbols!r}")
            self.rank[left, right] = (k, made)
            self.parts[made] = (k, left, right)
            if right in self.ends:
                self._end(made, symbols)
            else:
                self.inner[symbols] = made
                self.symbols[made] = symbols
        if not suffix:
            self.final = self.inner
        self.suffix = suffix
        self.by_ends = _by_ends(self.inner, self.final)
        self.fits: dict[int, bool] = {}  # by before << 32 | token
        self.states: dict[str, int] = {}  # prefix -> token << 16 | tokens << 8 | tokens if the word ends there

    def _end(self, token: int, symbols: str) -> None:
        self.final[symbols] = token
        self.symbols[token] = symbols
        self.ends.add(token)

    def merged(self, symbols: str, ends: bool) -> list[int]:
        """The encoding by merges, lowest rank and leftmost first."""
        ids = [self.inner[c] for c in symbols]
        if ends and self.suffix:
            ids[-1] = self.final[symbols[-1]]
        while len(ids) > 1:
            best = min(((self.rank[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            ids[k : k + 2] = [self.rank[ids[k], ids[k + 1]][1]]
        return ids

    def fit(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (-1: begins the word); remembered."""
        if before < 0:
            known = self.merged(self.symbols[token], token in self.ends) == [token]
        else:
            known = not self.crosses(before, token)
        if len(self.fits) > MEMO:
            self.fits.clear()
        self.fits[before << 32 | token] = known
        return known

    def crosses(self, left: int, right: int) -> bool:
        """Whether merges join the two sides: undo the merges at their border, the latest
        first, and see if the pair met there would have been merged before the one undone.
        Of equal merges the left one comes first."""
        undone, of_left = len(self.rank), False
        while True:
            meet = self.rank.get((left, right))
            if meet is not None and (meet[0] < undone or meet[0] == undone and not of_left):
                return True
            made_left, made_right = self.parts.get(left), self.parts.get(right)
            if made_left is None and made_right is None:
                return False
            of_left = made_right is None or made_left is not None and made_left[0] > made_right[0]
            if of_left:
                undone, left = made_left[0], made_left[2]
            else:
                undone, right = made_right[0], made_right[1]

    def prefixes(self, word: str) -> list[int]:
        """Tokens of word[:1], word[:2], ... where each ends a word."""
        states, fits, fit, root = self.states, self.fits, self.fit, self.by_ends[0]
        last, count, out = [-1], [0], []
        for i in range(1, len(word) + 1):
            prefix = word[:i] if i <= MEMO_CHARS else ""
            state = states.get(prefix)
            if state is not None:
                last.append(state >> 16)
                count.append(state >> 8 & 255)
                out.append(state & 255)
                continue
            # the tokens that end here, shorter ones first: of each kind one fits
            token = inside = ended = None
            k, nodes = i, root
            while k and (token is None or ended is None):
                k -= 1
                node = nodes.get(word[k])
                if node is None:
                    break
                nodes, inner, final = node
                if inner is not None and token is None:
                    known = fits.get(last[k] << 32 | inner)
                    if known or known is None and fit(last[k], inner):
                        token, inside = inner, count[k] + 1
                if final is not None and ended is None:
                    known = fits.get(last[k] << 32 | final)
                    if known or known is None and fit(last[k], final):
                        ended = count[k] + 1
            if token is None or ended is None:
                raise ValueError(f"no encoding of {word[:i]!r}")
            if prefix:
                if len(states) > MEMO:
                    states.clear()
                states[prefix] = token << 16 | inside << 8 | ended
            last.append(token)
            count.append(inside)
            out.append(ended)
        return out


class _Words(dict):
    """Counts of the prefixes of words, a byte each: of those met lately, as a full
    half becomes the old one and what is met there again moves on."""

    def __init__(self, count):
        self.count, self.old = count, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.count(word)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class PrefixCounter:
    """Token counts of the prefixes of texts, for one tokenizer file."""

    def __init__(self, tokenizer_json: str):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer")]
        kinds = [s and s["type"] for s in steps]
        if kinds != ["Split", "ByteLevel"] or steps[1].get("use_regex") or steps[1].get("add_prefix_space") or not steps[0].get("invert"):
            raise ValueError("a tokenizer is needed that splits texts by one pattern into words of bytes")
        pattern = steps[0]["pattern"]["Regex"]
        if "(?" in pattern:
            raise ValueError("a pattern that looks around makes words depend on what follows them")
        special = spec.get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in special):
            raise ValueError("special strings that take in their surroundings are not supported")
        self.library = Tokenizer.from_str(tokenizer_json)
        self.bpe = Bpe(spec["model"])
        # for Latin texts, with the classes spelled out
        self.split = re.compile(_latin_classes(pattern))
        self.white = np.array([chr(c).isspace() for c in range(256)])
        words = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, words))) if words else None
        one = lambda x: [x[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(x)]
        own = self.split.findall
        # characters that the two pattern engines, or the normaliser, see in another way
        odd = [
            c for c in map(chr, range(256))
            if any(one(x) != own(x) for x in (c + c, "a" + c + "a", "1" + c, "." + c, c + "."))
            or self._normal(c) not in (c.lower(), " ") or c.isspace() != (not one(c))
        ]
        self.odd = regex.compile("[" + "".join(map(regex.escape, odd)) + "]") if odd else None
        self.simple = bool(self.library.normalizer) and self._normal("Aé") == "aé"
        # symbols of the bytes that go on with a character, from letters whose second byte takes every value
        self.inside = {self.library.pre_tokenizer.pre_tokenize_str(chr(k))[0][0][-1] for k in range(0x180, 0x1C0)}
        # the symbols of each Latin character, as the library writes its bytes
        symbols = {c: [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(chr(c))] for c in range(256)}
        self.latin = {c: x[0] for c, x in symbols.items() if x}
        self.words = _Words(lambda w: bytes(self._word(w)))
        self.clusters: dict[str, str] = {}

    def _normal(self, text: str) -> str:
        return self.library.normalizer.normalize_str(text) if self.library.normalizer else text

    def _word(self, word: str) -> list[int]:
        """Counts after each character of a word."""
        symbols = word.translate(self.latin) if _latin(word) is not None else self.library.pre_tokenizer.pre_tokenize_str(word)[0][0]
        counts = self.bpe.prefixes(symbols)
        if len(symbols) > len(word):
            counts = [n for n, after in zip(counts, [*symbols[1:], ""]) if after not in self.inside]
        if word[0] == "'" and 1 < len(word) <= 3 and word[1].isalpha():  # its prefixes are words of another kind
            for k in range(1, len(word)):
                counts[k - 1] = sum(self.bpe.prefixes(p)[-1] for p, _ in self.library.pre_tokenizer.pre_tokenize_str(word[:k]))
        return counts

    def _words_sum(self, words: list[str], white: np.ndarray) -> np.ndarray:
        """Counts after each character of a text, ``words`` being all of it that is not
        ``white``: behind a word the count stays."""
        if not words:
            return np.zeros(len(white), dtype=np.int32)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        if sizes.max() <= WORD_CHARS:
            counts = np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype=np.uint8)
        else:
            counts = np.concatenate([np.frombuffer(self.words[w], dtype=np.uint8) if len(w) <= WORD_CHARS else np.array(self._word(w)) for w in words])
        total = counts[np.cumsum(sizes) - 1].astype(np.int32)
        upto = np.zeros(len(counts) + 1, dtype=np.int32)
        upto[1:] = counts + np.repeat(np.cumsum(total, dtype=np.int32) - total, sizes)
        return upto[np.cumsum(~white)]

    def _ordinary(self, text: str) -> np.ndarray:
        """Counts after each code point of a text without special strings."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        latin = _latin(text) if self.simple and (self.odd is None or not self.odd.search(text)) else None
        if latin is not None:
            return self._words_sum(self.split.findall(text.lower()), self.white[np.frombuffer(latin, dtype=np.uint8)])
        clusters = _clusters(text)
        normal = []
        for c in clusters:
            n = self.clusters.get(c)
            if n is None:
                n = self._normal(c)
                if len(self.clusters) > MEMO:
                    self.clusters.clear()
                self.clusters[c] = n
            normal.append(n)
        joined = "".join(normal)
        white, words = np.ones(len(joined), dtype=bool), []
        for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(joined):
            words.append(joined[a:b])
            white[a:b] = False
        counts = np.concatenate([[0], self._words_sum(words, white)]).astype(np.int32)
        after = counts[np.cumsum([len(n) for n in normal])]
        out = np.full(len(text), NO_CUT, dtype=np.int32)
        out[np.cumsum([len(c) for c in clusters]) - 1] = after
        return out

    def counts(self, text: str) -> np.ndarray:
        """Entry i: tokens of the first i + 1 code points, NO_CUT where the text
        cannot end there without changing the characters before."""
        if self.special is None:
            return self._ordinary(text)
        out, at, base = [], 0, 0
        for m in self.special.finditer(text):
            part = self._ordinary(text[at : m.end() - 1])  # ends within the special string are plain
            before = _last(part[: m.start() - at])
            out.append(np.where(part == NO_CUT, NO_CUT, part + base))
            base += before + 1
            out.append(np.array([base], dtype=np.int32))
            at = m.end()
        part = self._ordinary(text[at:])
        out.append(np.where(part == NO_CUT, NO_CUT, part + base) if base else part)
        return np.concatenate(out).astype(np.int32) if len(out) > 1 else out[0]


def _latin_classes(pattern: str) -> str:
    """The pattern for characters below U+0100: letters and numbers by name."""
    for name, of in ((r"\p{L}", "L"), (r"\p{N}", "N")):
        pattern = pattern.replace(name, "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == of))
    return pattern


def _last(counts: np.ndarray) -> int:
    return int(counts[-1]) if len(counts) else 0


def _latin(text: str) -> bytes | None:
    """The text as one byte a character, if it has none beyond U+00FF."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


_joining: list = []


def _clusters(text: str) -> list[str]:
    """Pieces of a text that are normalised independently: a new one begins at
    every character that neither combines with nor composes with one before."""
    import regex

    if not _joining:
        import sys

        second = set()
        for k in range(sys.maxunicode + 1):
            if 0xAC00 <= k <= 0xD7A3:
                continue
            parts = unicodedata.decomposition(chr(k)).split()
            if len(parts) == 2 and not parts[0].startswith("<"):
                second.add(chr(int(parts[1], 16)))
        joins = "".join(regex.escape(c) for c in sorted(second)) + r"ᅠ-ᇿힰ-퟿\p{M}"
        _joining.append(regex.compile(rf"(?s).[{joins}]*"))
    return _joining[0].findall(text)


_counters: dict[str, PrefixCounter] = {}


def _counter(tokenizer_json: str) -> PrefixCounter:
    """One counter for each worker process and tokenizer, which keeps its memory of words."""
    key = str(hash(tokenizer_json))
    if key not in _counters:
        _counters[key] = PrefixCounter(tokenizer_json)
    return _counters[key]


def _pieces(tokenizer, piece: int, id_type):
    def run(batches: Iterator[pa.RecordBatch]):
        counter = _counter(tokenizer())
        names = ["id", "n_bytes", "n_chars", "piece", "start", "counts", "tokens", "last"]
        rows: list[tuple] = []
        held = 0

        def flush():
            ids, *rest, counts, tokens, last = zip(*rows)
            sizes = np.fromiter(map(len, counts), dtype=np.int64, count=len(counts))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            arrays = [pa.array(ids, id_type)] + [pa.array(c, t) for c, t in zip(rest, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(counts)))
            return pa.RecordBatch.from_arrays([*arrays, lists, pa.array(tokens, pa.int64()), pa.array(last, pa.bool_())], names=names)

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                counts = counter.counts(text)
                n_bytes = len(text.encode("utf-8", "surrogatepass"))
                for k, at in enumerate(range(0, max(1, len(counts)), piece)):
                    part = counts[at : at + piece]
                    rows.append((key, n_bytes, len(text), k, at, part, _last(part), at + piece >= len(counts)))
                    held += len(part)
                    if held > 16 * piece:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    return run


def prefix_table(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """The table of prefix counts: rows (id, n_bytes, n_chars, piece, start,
    counts, tokens, last), one for each ``piece`` prefixes of a text and one for
    a text without any.  Entry k of ``counts`` is the number of tokens of the
    first start + k + 1 code points, as the tokenizer counts them without begin
    and end tokens; -1 where a text cannot end, inside characters that are
    normalised together.  ``tokens``: the count at the end of the piece; ``last``
    marks the piece that ends the text.

    A special string inside a text is one token and a prefix that ends inside it
    plain text.  A null text is empty; null and repeated ids keep their rows;
    other columns are not read; an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    run = _pieces(shared(docs.sparkSession, tokenizer_json), piece, to_arrow_type(kind))
    schema = f"id {kind.simpleString()}, n_bytes long, n_chars long, piece int, start long, counts array<int>, tokens long, last boolean"
    return rows.mapInArrow(run, schema)


def text_counts(table: DataFrame, limit: int) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text of a prefix table."""
    return table.filter("last").select("id", "n_bytes", F.col("tokens").alias("n_tokens"), (F.col("tokens") > limit).alias("over_limit"))


def truncated(table: DataFrame, limit: int) -> DataFrame:
    """(id, n_chars, cut_chars, cut_tokens): the longest prefix of each text that
    has at most ``limit`` tokens, and how many it has.  Ids must be unique."""
    fits = lambda c: (c <= F.lit(limit)) & (c != F.lit(NO_CUT))
    at = F.transform("counts", lambda c, k: F.when(fits(c), F.struct((F.col("start") + k + 1).alias("chars"), c.cast("long").alias("tokens"))))
    best = F.max(F.array_max(at))
    out = table.groupBy("id").agg(F.max("n_chars").alias("n_chars"), best.alias("best"))
    return out.select("id", "n_chars", F.coalesce("best.chars", F.lit(0)).cast("long").alias("cut_chars"), F.coalesce("best.tokens", F.lit(0)).cast("long").alias("cut_tokens"))


def tokens_of(table: DataFrame, questions: DataFrame, piece: int = PIECE) -> DataFrame:
    """Answer ``questions`` (id, chars): adds n_tokens, the tokens of the first
    ``chars`` code points; null for an unknown id, for more code points than the
    text has and where a text cannot end.  Ids of the table must be unique."""
    asked = questions.withColumn("__piece", F.greatest(F.lit(0), F.floor((F.col("chars") - 1) / piece)).cast("int"))
    found = table.select(F.col("id").alias("__id"), F.col("piece").alias("__at"), "start", "counts")
    joined = asked.join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("__piece") == F.col("__at")), "left")
    at = F.get("counts", (F.col("chars") - 1 - F.col("start")).cast("int"))
    count = F.when((F.col("chars") <= 0) & F.col("__at").isNotNull(), F.lit(0)).when(at != NO_CUT, at)
    return joined.select(*[F.col(f"`{c}`") for c in questions.columns], count.cast("long").alias("n_tokens"))


def within_budget(table: DataFrame, budget: int) -> DataFrame:
    """(id, before, n_tokens, taken, cut_chars): texts are taken in the order of
    their ids up to ``budget`` tokens in all; the one at the edge gives its longest
    prefix that still fits.  Running sums go over sorted ranges of ids.  Ids must be
    unique; a null id comes first."""
    texts = table.filter("last").select("id", "n_chars", F.col("tokens").alias("n_tokens"))
    sums = running_sums(texts, ["id"], ["n_tokens"])
    rows = sums.withColumn("before", F.col("n_tokens_upto") - F.col("n_tokens"))
    whole = rows.filter(F.col("n_tokens_upto") <= budget).select("id", "before", "n_tokens", F.col("n_tokens").alias("taken"), F.col("n_chars").alias("cut_chars"))
    none = rows.filter((F.col("n_tokens_upto") > budget) & (F.col("before") >= budget))
    none = none.select("id", "before", "n_tokens", F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("cut_chars"))
    edge = rows.filter((F.col("n_tokens_upto") > budget) & (F.col("before") < budget)).select(F.col("id").alias("of"), "before", "n_tokens")  # one text
    at = table.join(edge, F.col("id").eqNullSafe(F.col("of")))
    left = F.lit(budget) - F.col("before")
    fits = F.transform("counts", lambda c, k: F.when((c <= left) & (c != F.lit(NO_CUT)), F.struct((F.col("start") + k + 1).alias("chars"), c.cast("long").alias("tokens"))))
    cut = at.groupBy("id", "before", "n_tokens").agg(F.max(F.array_max(fits)).alias("best"))
    cut = cut.select("id", "before", "n_tokens", F.coalesce("best.tokens", F.lit(0)).cast("long").alias("taken"), F.coalesce("best.chars", F.lit(0)).cast("long").alias("cut_chars"))
    return whole.unionByName(cut).unionByName(none)


def read_tokenizer(path: str) -> str:
    """A tokenizer file on the driver; executors get its text."""
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit): a row per row of ``docs``, taken
    from its prefix table."""
    table = prefix_table(docs, read_tokenizer(tokenizer_path), id_col, text_col)
    return text_counts(table, limit).withColumnRenamed("id", id_col)

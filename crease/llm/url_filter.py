"""URL filters: rules, and logistic regression on hashed character n-grams of
host and path for the urls that no rule decides.

Everything is DataFrame expressions: the features are hashed substrings, every
training step is one aggregation over the labelled urls, and scoring adds up
the weights of an url's features.  Only the weights, ``buckets`` numbers, are
held by the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import hashed_share, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, paths that start with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path

    @staticmethod
    def parse(text: str, allow: bool) -> Rule:
        host, slash, path = text.partition("/")
        return Rule(host.lower(), slash + path, allow)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, allow) of the longest rule that fits; nulls if none does."""
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, allow = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.allow)).otherwise(allow)
    return name, allow


def _gram(text: Column, tag: int, n: int, buckets: int):
    """The bucket of the n-gram that starts at a place of the text."""
    return lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substring(text, i, F.lit(n))), F.lit(buckets)).cast("int")


def features(host: Column, path: Column, sizes: tuple[int, ...], buckets: int) -> Column:
    """Hashed n-grams (with repeats) of host and path, their ends marked."""
    parts = []
    for tag, text in ((1, F.concat(F.lit("^"), host, F.lit("$"))), (2, F.concat(F.lit("^"), path, F.lit("$")))):
        for n in sizes:
            last = F.length(text) - (n - 1)
            starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.expr("cast(array() as array<int>)"))
            parts.append(F.transform(starts, _gram(text, tag, n, buckets)))
    return F.concat(*parts)


@dataclass(frozen=True)
class UrlModel:
    """Weights of the buckets and a bias; the score is the chance to be blocked."""

    weights: tuple[float, ...]
    bias: float
    sizes: tuple[int, ...]

    def score(self, host: Column, path: Column) -> Column:
        table = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")  # one folded literal
        f = features(host, path, self.sizes, len(self.weights))
        total = F.aggregate(f, F.lit(0.0), lambda acc, x: acc + F.element_at(table, x + 1))
        return 1 / (1 + F.exp(-(F.lit(self.bias) + total / F.greatest(F.lit(1.0), F.sqrt(F.size(f).cast("double"))))))


def train(
    labelled: DataFrame,
    host_col: str = "host",
    path_col: str = "path",
    blocked_col: str = "blocked",
    sizes: tuple[int, ...] = (3, 4),
    buckets: int = 4096,
    steps: int = 12,
    rate: float = 4.0,
    l2: float = 1e-4,
) -> UrlModel:
    """Full-batch gradient steps on a labelled table; both classes weigh the
    same.  Rows with a null label are left out; without a row of each class the
    model allows everything (a score below one half)."""
    rows = labelled.filter(F.col(blocked_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(blocked_col).cast("double").alias("y"),
        features(F.coalesce(host_col, F.lit("")), F.coalesce(path_col, F.lit("")), sizes, buckets).alias("f"),
    )
    scaled = rows.withColumn("scale", 1 / F.greatest(F.lit(1.0), F.sqrt(F.size("f").cast("double"))))
    data = staged(scaled, "urls")
    n = {r["y"]: r["n"] for r in data.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0.0) or not n.get(1.0):
        return UrlModel((0.0,) * buckets, -1.0, sizes)
    weight = F.when(F.col("y") > 0, F.lit(0.5 / n[1.0])).otherwise(F.lit(0.5 / n[0.0]))
    w, bias = [0.0] * buckets, 0.0
    g2 = [0.0] * (buckets + 1)  # squared gradients so far, for the step sizes
    for _ in range(steps):
        table = F.split(F.lit(",".join(map(repr, w))), ",").cast("array<double>")
        margin = F.lit(bias) + F.col("scale") * F.aggregate("f", F.lit(0.0), lambda acc, x: acc + F.element_at(table, x + 1))
        error = (1 / (1 + F.exp(-margin)) - F.col("y")) * weight
        # the bias is the last bucket
        parts = F.concat(F.col("f"), F.array(F.lit(buckets)))
        moved = data.select(error.alias("e"), "scale", parts.alias("f")).select("e", "scale", F.explode("f").alias("k"))
        grads = moved.groupBy("k").agg(F.sum(F.when(F.col("k") == buckets, F.col("e")).otherwise(F.col("e") * F.col("scale"))).alias("g"))
        for r in grads.collect():  # at most buckets + 1 numbers
            k, g = r["k"], round(r["g"], 12)  # sums arrive in any order
            g += l2 * (w[k] if k < buckets else 0.0)
            g2[k] += g * g
            if g2[k] > 0:
                move = rate * 0.25 * g / math.sqrt(g2[k])
                if k < buckets:
                    w[k] -= move
                else:
                    bias -= move
    return UrlModel(tuple(round(x, 9) for x in w), round(bias, 9), sizes)


def labelled_by_rules(pages: DataFrame, rules: list[Rule], url_col: str = "url", max_rows: int = 4000, seed: int = 9) -> DataFrame:
    """A small labelled table: urls decided by a rule (blocked: by a block rule),
    about ``max_rows`` / 2 of each class, or all there are, drawn by a hash of the
    url: a rare class is there at any number of pages."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    _, allow = rule_of(host, path, rules)
    decided = pages.select(F.col(url_col).alias("url"), host.alias("host"), path.alias("path"), (~allow).alias("blocked")).filter("blocked is not null")
    n = {r["blocked"]: r["n"] for r in decided.groupBy("blocked").agg(F.count(F.lit(1)).alias("n")).collect()}
    of_class = lambda c: (F.col("blocked") == c) & hashed_share(F.col("url"), max_rows / 2 / max(1, n.get(c, 0)), seed)
    return decided.filter(of_class(True) | of_class(False)).select("host", "path", "blocked")


def judge_urls(pages: DataFrame, rules: list[Rule], model: UrlModel, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """(id_col, host, path, rule, verdict, score): a row per row of ``pages``.

    verdict: the longest fitting rule's, else block where the model's score
    reaches ``threshold``.  A null url, or one without ``://``, has an empty host and
    path and is scored like any other; null ids and repeated rows stay; other
    columns are not read.
    """
    host, path = F.col("host"), F.col("path")
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    name, allow = rule_of(host, path, rules)
    scored = rows.select("id", "host", "path", name.alias("rule"), allow.alias("allow"), model.score(host, path).alias("score"))
    verdict = F.when(F.coalesce(F.col("allow"), F.col("score") < threshold), F.lit("allow")).otherwise(F.lit("block"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")

"""Mixing sources to target weights by temperature.

A source's share p of all tokens is raised to an exponent a and normalised:
w = p^a / sum p^a.  a is found by bisection, so that the weights have a target
entropy or no source is repeated more than a limit.  The weights become token
budgets, and a source's budget is realised over a permutation of its blocks:
as many whole passes as fit, then blocks in permuted order up to the rest, the
block at the edge in the permuted order of its documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import staged


def bisect_exponent(holds: Callable[[float], bool], low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The smallest exponent in [low, high] for which ``holds`` (which stays
    true from some exponent on) holds; high if it never does."""
    if holds(low):
        return low
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if holds(mid) else (mid, high)
    return high


class Shares:
    """What weights of sources depend on, for logarithms l of their sizes over the
    largest: at exponent a the sums of exp(a l) and of l exp(a l).  Sizes are held
    as (size, how many sources have it) up to ``max_classes`` sizes, beyond that the
    sums are made on the executors, a small job for each exponent tried."""

    def __init__(self, sources: DataFrame, max_classes: int = 1 << 20):
        sizes = sources.filter("tokens > 0").groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))
        first = sizes.agg(F.sum(F.col("tokens") * F.col("n")), F.max("tokens"), F.min("tokens"), F.max_by("n", "tokens"), F.sum("n"), F.count(F.lit(1))).first()
        self.total, self.largest, self.smallest, self.at_largest, self.sources = (x or 0 for x in first[:5])
        self.logs = self.sizes = None
        if first[5] <= max_classes:
            rows = sorted((r["tokens"], r["n"]) for r in sizes.collect())
            self.logs = [(math.log(t / self.largest), n) for t, n in rows]
        else:
            self.sizes = staged(sizes.select(F.log(F.col("tokens") / F.lit(float(self.largest))).alias("l"), "n"), "mix-sizes")

    def moments(self, a: float) -> tuple[float, float]:
        if self.logs is not None:
            parts = [(n * math.exp(a * x), x) for x, n in self.logs]
            return math.fsum(p for p, _ in parts), math.fsum(p * x for p, x in parts)
        part = F.col("n") * F.exp(F.lit(a) * F.col("l"))
        return tuple(self.sizes.agg(F.sum(part), F.sum(part * F.col("l"))).first())

    def norm(self, a: float) -> float:
        return self.moments(a)[0]

    def entropy(self, a: float) -> float:
        """Entropy of the weights in nats."""
        z, first = self.moments(a)
        return math.log(z) - a * first / z

    def _steepest(self, a: float) -> float:
        """The largest exp(a l)."""
        return max(1.0, math.exp(a * math.log(self.smallest / self.largest)))

    def passes(self, a: float, budget: float) -> float:
        """Passes over the most repeated source."""
        return budget / (self.norm(a) * self.largest) * self._steepest(a - 1)

    def covering_budget(self, a: float) -> float:
        """The smallest budget that takes every source at least once."""
        return self.norm(a) * self.largest * self._steepest(1 - a)


def choose_exponent(shares: Shares, budget_tokens: int | None, target_entropy: float | None, repetition_limit: float | None) -> tuple[float, bool]:
    """(exponent, whether it meets the target): for the target entropy, a share of
    the greatest possible one, by bisection between 0 (all sources alike) and an
    upper end that is doubled until the entropy is below the target; or the flattest
    exponent that keeps within the repetition limit.

    More than 1 sharpens the shares.  Where the largest size is shared by so many
    sources that no exponent gives so little entropy, the shares stay as they are."""
    if not shares.total:
        return 1.0, False
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("give either target_entropy or repetition_limit")
    if target_entropy is not None:
        target = target_entropy * math.log(shares.sources)
        if math.log(shares.at_largest) > target - 1e-9 and shares.at_largest > 1 or shares.sources == 1:
            return 1.0, abs(shares.entropy(1.0) - target) < 1e-9
        high = 1.0
        while shares.entropy(high) > target:
            high *= 2
        return bisect_exponent(lambda a: shares.entropy(a) <= target, high / 2 if high > 1 else 0.0, high), True
    budget = lambda a: budget_tokens if budget_tokens is not None else shares.covering_budget(a)
    holds = lambda a: shares.passes(a, budget(a)) <= repetition_limit * (1 + 1e-12)
    a = bisect_exponent(holds)
    return a, holds(a)


def count_tokens(text: Column) -> Column:
    """Words split at white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget_tokens: int | None = None,
    budget_share: float | None = None,
    target_entropy: float | None = None,
    repetition_limit: float | None = None,
    block_documents: int = 1000,
    seed: int = 1,
    keep_columns: bool = False,
) -> DataFrame:
    """A row per row of ``docs``: id, source, n_tokens, exponent, target_met (whether
    it gives the entropy or limit asked for), weight, budget, n_copies (how often the mixture takes it; 0: not at all), block,
    block_rank (place of the block in its source's permutation) and order_key
    (sorting by it deals every source out evenly).  With ``keep_columns`` all
    columns of ``docs`` stay beside n_copies and order_key.

    budget_tokens: tokens of the mixture (budget_share: as a share of all tokens);
    by default as many as take every document at least once.  A budget is never exceeded; it is missed by less
    than a document.  Null sources are one source; documents without words cost
    nothing and follow their block, those of a source without any words are
    taken once.  Null ids and repeated rows are rows like others; an empty table
    gives an empty table.
    """
    tokens = count_tokens(F.col(text_col))
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), tokens.alias("tokens"), draw.alias("draw"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_columns else []),
    )
    narrow = staged(rows.select("id", "source", "tokens", "draw"), "mix-rows")
    sources = staged(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "mix-sources")
    shares = Shares(sources)
    if budget_share is not None:
        budget_tokens = int(budget_share * shares.total)
    a, met = choose_exponent(shares, budget_tokens, target_entropy, repetition_limit)
    z = shares.norm(a) if shares.total else 1.0
    budget = budget_tokens if budget_tokens is not None else (shares.covering_budget(a) if shares.total else 0.0)
    log_size = F.log(F.col("tokens") / F.lit(float(shares.largest or 1)))
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(a) * log_size) / F.lit(z)).otherwise(F.lit(0.0))
    passes = F.when(F.col("tokens") > 0, weight * F.lit(float(budget)) / F.col("tokens")).otherwise(F.lit(1.0))
    full = F.floor(passes + F.lit(1e-9))
    plan = sources.select(
        F.col("source").alias("of"),
        F.lit(a).alias("exponent"),
        F.lit(met).alias("target_met"),
        weight.alias("weight"),
        F.floor(weight * F.lit(float(budget)) + F.lit(1e-6)).cast("long").alias("budget"),
        full.cast("long").alias("full"),
        F.greatest(F.lit(0), F.floor((passes - full) * F.col("tokens") + F.lit(1e-6))).cast("long").alias("rest"),
        F.ceil(F.col("docs") / F.lit(block_documents)).cast("long").alias("blocks"),
    )

    def dealt(df: DataFrame) -> DataFrame:
        return df.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("block", F.pmod(F.col("draw"), F.col("blocks")))

    # permuted blocks of each source and the tokens before each
    blocks = dealt(narrow).groupBy("source", "block", "full", "rest", "blocks").agg(F.sum("tokens").alias("block_tokens"))
    blocks = _ranked(blocks.withColumn("place", F.xxhash64(F.lit(seed), F.lit("block"), "block", "full")))
    whole = (F.col("before") + F.col("block_tokens") <= F.col("rest")).alias("whole")
    edge = ((F.col("before") < F.col("rest")) & ~(F.col("before") + F.col("block_tokens") <= F.col("rest"))).alias("edge")
    blocks = staged(blocks.select(F.col("source").alias("of"), F.col("block").alias("of_block"), "block_rank", "before", whole, edge), "mix-blocks")

    joined = dealt(rows).join(blocks, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))).drop("of", "of_block")
    # only the block at the edge of each source's budget is ordered by document
    along = Window.partitionBy("source", "block").orderBy("draw", "id")  # up to and with rows equal in both
    at_edge = dealt(narrow).join(
        blocks.filter("edge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    )
    cut = at_edge.withColumn("upto", F.sum("tokens").over(along) + F.col("before")).filter("upto <= rest")
    cut = cut.groupBy("source", "block").agg(F.max(F.struct("draw", "id")).alias("last"))
    cut = staged(cut.select(F.col("source").alias("of"), F.col("block").alias("of_block"), "last"), "mix-cut")
    joined = joined.join(cut, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")), "left").drop("of", "of_block")
    inside = F.col("whole") | (F.col("edge") & F.coalesce(F.struct("draw", "id") <= F.col("last"), F.lit(False)))
    copies = (F.col("full") + F.when(inside, F.lit(1)).otherwise(F.lit(0))).cast("long")
    place = (F.col("block_rank") + F.pmod(F.col("draw"), F.lit(1 << 20)) / F.lit(float(1 << 20))) / F.col("blocks")
    if keep_columns:
        return joined.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], copies.alias("n_copies"), place.alias("order_key"))
    return joined.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("tokens").alias("n_tokens"), "exponent", "target_met", "weight", "budget",
        copies.alias("n_copies"), "block", F.col("block_rank").cast("long").alias("block_rank"), place.alias("order_key"),
    )


def _ranked(blocks: DataFrame) -> DataFrame:
    """Rank of each block in its source by (place, block), and the tokens before it.

    The places of a source are cut into as many equal stretches as the square
    root of its blocks: running sums go over the stretches, then within each,
    so that no task orders all blocks of a large source."""
    stretches = F.ceil(F.sqrt("blocks"))
    at = F.col("place") / F.lit(2.0**64) + F.lit(0.5)  # grows with the place
    blocks = blocks.withColumn("stretch", F.least(F.floor(at * stretches), stretches - 1).cast("long"))
    past = Window.unboundedPreceding
    along = Window.partitionBy("of").orderBy("in_stretch").rowsBetween(past, -1)
    sums = blocks.groupBy(F.col("source").alias("of"), F.col("stretch").alias("in_stretch")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("block_tokens").alias("t")
    )
    sums = sums.select("of", "in_stretch", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(along), F.lit(0)).alias("t0"))
    within = Window.partitionBy("source", "stretch").orderBy("place", "block")
    upto = F.sum("block_tokens").over(within.rowsBetween(past, Window.currentRow))
    blocks = blocks.withColumn("rank", F.row_number().over(within) - 1).withColumn("upto", upto - F.col("block_tokens"))
    joined = blocks.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("in_stretch"))).drop("of", "in_stretch")
    return joined.withColumn("block_rank", F.col("n0") + F.col("rank")).withColumn("before", F.col("t0") + F.col("upto"))


def realise(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as the mixture takes
    it, with the columns of ``docs``."""
    mixed = mix_sources(docs, keep_columns=True, **options).filter("n_copies > 0")
    repeated = mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Connected components over a links table, by alternating large-star and
small-star rounds (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014): every round is two grouped minima and two joins, the links
never leave the executors, and each round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import hot_join, hot_values, staged


HUB_CHECK = 200_000  # links from which on hubs are looked for


def _star(pairs: DataFrame, keep, n_links: int) -> DataFrame:
    """pairs (n, m): link each kept neighbour m of n to n's smallest neighbour (or n).
    The links of a hub stay in place."""
    low = pairs.groupBy("n").agg(F.min("m").alias("low"), F.count(F.lit(1)).alias("links"))
    hubs = []
    if n_links > HUB_CHECK:
        low = staged(low, "lows")
        hubs = hot_values(low, "n", "links")
    joined = hot_join(pairs, low.drop("links"), ["n"], "n", hubs).withColumn("low", F.least("n", "low"))
    return keep(joined)


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``links``: undirected pairs of one comparable type.  Returns (node,
    component) for every node that has a link to a smaller one or reaches one,
    component being the smallest node reachable.  Self-links and links with a null end are ignored;
    repeated links count once; an empty table gives an empty table."""
    x, y = F.col(a), F.col(b)
    edges = staged(
        links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links"
    )
    mark, n_links = None, edges.count()
    for _ in range(max_rounds):
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(
            edges.select(F.col("v").alias("n"), F.col("u").alias("m"))
        )
        large = _star(both, lambda j: j.filter("m > n").select(F.col("m").alias("n"), F.col("low").alias("m")), n_links).distinct()
        small = _star(
            large,
            lambda j: j.select(F.explode(F.array(F.struct("n", "low"), F.struct(F.col("m").alias("n"), "low"))).alias("e"))
            .select(F.col("e.n").alias("u"), F.col("e.low").alias("v"))
            .filter("u != v"),
            n_links,
        ).distinct()
        edges = staged(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark, n_links = tuple(now), now[0]
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

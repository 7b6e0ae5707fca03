"""Connected components by alternating stars, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node that can be reached.

    Each round hangs the larger neighbours of a node, then the smaller ones, on its smallest
    neighbour, until only stars are left. Minima are formed on the map side and joined back, so no
    node's neighbours are gathered; every round is a written table.
    """
    links = stored(_down(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    mark = _mark(links)
    while mark[0]:
        links = stored(_small_star(_large_star(links)))
        before, mark = mark, _mark(links)
        if before == mark:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _down(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with u > v."""
    return pairs.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31)).alias("s")).first()
    return row["n"], row["s"] or 0


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _down(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _down(moved.union(least.select("u", F.col("m").alias("v"))))

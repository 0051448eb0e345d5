"""Connected components of a link table by alternating star contractions, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest node around it."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    smaller = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    """Count and order-free digest of a link table; a round that leaves both alone has converged."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b; longs); root is the component's smallest node.

    Each round cuts lineage with a checkpoint in the shared folder; the number of rounds is
    logarithmic in the longest path. An empty table gives an empty result.
    """
    links = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    while state[0]:
        links = materialize(_small_star(_large_star(links)))
        new = _state(links)
        if new == state:
            break
        state = new
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)

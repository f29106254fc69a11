"""Connected components of a link graph with joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of the links (``a``, ``b``): the smallest node reachable.

    Large-star and small-star steps by turns until no link changes: each links the neighbours of
    a node to the smallest of them. A node with very many links costs one row per link; minima
    are combined before the shuffle and the joins can be split.
    """
    links = links.where(F.col("a") != F.col("b"))
    now = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = materialize(large.where("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                    .alias("link"))
            .select("link.a", "link.b").where("a <> b").distinct()
        )
        now = materialize(small)
        after = _mark(now)
        if after == mark:
            break
        mark = after
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Number of links and a sum of their hashes: equal for equal sets of links."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash"),
    ).first()
    return row["n"], row["hash"]

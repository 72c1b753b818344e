"""Connected components of an undirected graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relgraph.plans.staging import Staging


def connected_components(links: DataFrame, staging: Staging) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b), where root is the smallest node reachable.

    Alternates two steps until nothing changes.  Large star: each node tells
    its larger neighbours the smallest node it sees.  Small star: each node
    ties its smaller neighbours, and itself, to the smallest of them.  Both
    keep the components, and every round shortens all paths, so the number of
    rounds is logarithmic for practical graphs.  The minimum of a node is an
    aggregate that is combined before the shuffle, and the join that sends it
    back may be split, so a node with very many links is no one task's work.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs, rows = staging.keep(pairs, "links")
    signature = None
    while rows:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = large.distinct()
        large, _ = staging.keep(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        pairs, rows = staging.keep(small, "small")
        found = pairs.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if found == signature:
            break
        signature = found
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )

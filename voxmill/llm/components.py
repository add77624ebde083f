"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, only_larger: bool) -> DataFrame:
    """Each node u links its neighbours to the smallest node m of its neighbourhood.

    The neighbourhood's minimum is an aggregate joined back on u, so a node with
    very many neighbours is never one row.
    """
    low = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = pairs.join(low, "a")
    if only_larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node BIGINT, component BIGINT) for every node of an edge; a component is named by its smallest node.

    Nulls and loops are ignored, repeated edges count once, and no edge gives no
    row. The number of rounds grows with the logarithm of the longest path; each
    round is cut off by a checkpoint.
    """
    edges = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b"))
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        large = _star(_neighbours(now), only_larger=True)
        now = cut(_star(large.where("b < a"), only_larger=False))
        row = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if (row.n, row.h) == state:
            break
        state = (row.n, row.h)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)

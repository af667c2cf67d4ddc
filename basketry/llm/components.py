"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """a, b: every node that is not the least of its component, with the least one.

    edges: a, b of one orderable type, in any direction. Alternates the large and
    the small star until nothing changes: the number of rounds grows with the
    logarithm of the nodes. Each round is written down, so a lost executor costs one round at
    most. Per node only minima are gathered; a node with many edges
    is split by the skew handling of its join.
    """
    edges = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges).distinct()).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges

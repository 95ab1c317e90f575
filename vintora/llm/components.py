"""Connected components by alternating star contractions.

Each round is grouping by node and a join of the group's minimum back to its edges, so no neighbourhood is ever
collected and a node with very many edges is summed up before it moves. Rounds are written to shared storage; their
number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.sources.workspace import materialise


def _minimum(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of a node and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    return both.join(_minimum(both), F.col("u") == F.col("_u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_minimum(down), F.col("u") == F.col("_u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge to another; component is the smallest node id.

    Null ends and loops are no edges; repeated edges count once; an empty table gives an empty result.
    """
    proper = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = materialise(proper.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "edges")
    while not _is_contracted(current):
        current = materialise(_small_star(_large_star(current)).where("u <> v").distinct(), "edges")
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _is_contracted(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that hangs on none."""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    heads = edges.select(F.col("v").alias("_head")).distinct()
    return several.union(edges.select("u").join(heads, F.col("u") == F.col("_head"), "left_semi")).isEmpty()

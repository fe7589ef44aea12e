"""Connected components as Spark joins: alternating large-star and small-star rounds.

Every round is two aggregations and two joins over the edge table; a hub with
very many edges is partially aggregated and its join side can be split by AQE.
No edge, label or component reaches the driver: it learns per round whether
the edges are stars already, and that is decided exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    up = both.where("b > a").join(least, F.col("a") == F.col("c"))
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # edges have a > b here: b are the smaller neighbours of a
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least.select(F.col("a").alias("c"), "m"), F.col("a") == F.col("c"))
    moved = down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, and that one none: its star is then the whole component."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def star_forest(edges: DataFrame, a: str = "a", b: str = "b", name: str = "edges") -> DataFrame:
    """(node, root) for every node of an undirected edge table, roots excluded; root is the least node reachable.

    Self loops, repeated edges and edges with a null end are ignored; an empty
    table gives an empty result.
    """
    cur = stored(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct(), name)
    while not _is_stars(cur):
        cur = stored(_small_star(_large_star(cur)), name)
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))

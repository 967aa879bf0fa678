"""Connected components of an edge table by alternating stars.

Every round hooks the larger neighbours of a vertex to its smallest neighbour (large star), then the
smaller ones (small star). Each step is one aggregation by vertex and one join; the edge table is written
between rounds, and two numbers tell the driver when it no longer changes. Rounds grow with the logarithm
of the longest chain, and the edge count never grows, so neither chains nor stars of any size gather on
one task: the minimum of a vertex is combined map-side, and a hot vertex's rows of the join can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.plans.storage import materialise


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """edges: (u, v), u > v. One star step over them, as distinct (u, v) with u > v."""
    if larger:
        # Around u: all neighbours larger than u move to the smallest of u and its neighbours.
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        # Around u: its smaller neighbours and u itself move to the smallest of these.
        around = edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if larger:
        # Written, so that both sides of the join are plain shuffles and a hot vertex can be split.
        least = materialise(least)
    moved = around.join(least, "u")
    if larger:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return moved.where("u > v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(u, component) for every vertex that is not the smallest of its component.

    The component is its smallest vertex. NULL ends and loops are ignored; edges may repeat.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = materialise(now.select(high.alias("u"), low.alias("v")).distinct())
    before = None
    while True:
        mark = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if mark == before or not mark.n:
            return now.select("u", F.col("v").alias("component"))
        before = mark
        now = materialise(_star(materialise(_star(now, larger=True)), larger=False))

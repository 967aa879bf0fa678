"""Kendall's tau-b of many column pairs over pairwise complete rows, without forming pairs of rows.

Values become dense places within their columns. Two rows whose places in y differ part at one bit, the
highest in which they differ; above it they agree. So among the rows that agree above a bit, the discordant
pairs that part there are those in which a row with the bit set has the smaller x. That is a running sum
over x, for every bit and every group of rows that agree above it: one sorted table for all of them and for
all column pairs, cut into ranges whose totals give each range what lies before it. Rows of one x are summed
first, as they form no pair.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.operators.ranks import running_weight
from rowmill.plans.storage import materialise


def discordant_weights(table: DataFrame, bits: int) -> dict[int, float]:
    """Per pair, the sum of n * n' over its rows with x < x' and y > y'. table: pair, x, y, n; y below 2^bits."""
    each = table.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(max(bits, 1) - 1))))
    shifted = lambda by: F.call_function("shiftright", F.col("y"), by)
    high = shifted(F.col("bit")).bitwiseAND(F.lit(1)) == 1
    rows = each.groupBy("pair", "bit", shifted(F.col("bit") + 1).alias("above"), "x").agg(
        F.coalesce(F.sum(F.when(high, F.col("n"))), F.lit(0)).alias("ones"),
        F.coalesce(F.sum(F.when(~high, F.col("n"))), F.lit(0)).alias("zeros"),
    )
    parted = running_weight(rows, ["pair", "bit", "above"], "x", ["ones"])
    weight = F.sum(F.col("zeros").cast("double") * F.col("before_ones")).alias("d")
    return {r.pair: r.d for r in parted.groupBy("pair").agg(weight).collect()}


def _tied(n: Column) -> Column:
    n = n.cast("double")
    return F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).alias("tied")


def kendall(places: DataFrame, pairs: Sequence[tuple[int, int]]) -> dict[tuple[int, int], float | None]:
    """tau-b of pairs of different columns i, j, whose dense places are __d<i> and __d<j>; None where undefined."""
    pairs = [p for p in pairs if p[0] != p[1]]
    entries = []
    for k, (i, j) in enumerate(pairs):
        x, y = F.col(f"__d{i}"), F.col(f"__d{j}")
        own = F.struct(F.lit(k).alias("pair"), x.alias("x"), y.alias("y"))
        entries.append(F.when(x.isNotNull() & y.isNotNull(), own))
    table = materialise(
        places.select(F.inline(F.array(*entries)))
        .filter("pair is not null")
        .groupBy("pair", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = table.groupBy("pair").agg(F.sum("n").alias("n"), _tied(F.col("n")), F.max("y").alias("high")).collect()
    ties = {}
    for c in ("x", "y"):
        sums = table.groupBy("pair", c).agg(F.sum("n").alias("n"))
        ties[c] = {r.pair: r.tied for r in sums.groupBy("pair").agg(_tied(F.col("n"))).collect()}
    discordant = discordant_weights(table, max((r.high for r in totals), default=0).bit_length())
    out: dict[tuple[int, int], float | None] = dict.fromkeys(pairs)
    for r in totals:
        rows, x, y = r.n * (r.n - 1) / 2, ties["x"][r.pair], ties["y"][r.pair]
        scale = math.sqrt(rows - x) * math.sqrt(rows - y)
        if scale:
            tau = (rows - x - y + r.tied - 2 * discordant[r.pair]) / scale
            out[pairs[r.pair]] = max(-1.0, min(1.0, tau))
    return out

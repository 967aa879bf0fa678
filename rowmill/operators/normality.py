"""Shapiro-Wilk normality test per numeric column.

Follows the published approximation of the weights and of the p-value (Royston 1992, 1995), which was fitted
for up to 5000 values; beyond, W is as exact and p an extrapolation. Every column is tested on all its
values, or on a seeded sample that does not depend on the layout of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions import bands
from rowmill.functions.columns import (
    ROW_ID,
    col,
    nan_to_null,
    numeric_columns,
    require_columns,
    require_numeric,
)
from rowmill.functions.scalars import double, inverse_normal, key_hash, rounded
from rowmill.functions.shipping import runs_in_workers
from rowmill.operators.ranks import running_weight
from rowmill.plans.storage import materialise

runs_in_workers(__name__)

# Places of one value whose scores are summed in one part.
PART = 1 << 16

# Published polynomial coefficients, lowest power first.
LAST_WEIGHT = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
NEXT_WEIGHT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SMALL_GAMMA = [-2.273, 0.459]
SMALL_MEAN = [0.5440, -0.39978, 0.025054, -0.0006714]
SMALL_LOG_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_LOG_SD = [-0.4803, -0.082676, 0.0030302]


def _polynomial(coefficients: Sequence[float], x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


def p_value(w: float, n: int) -> float:
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(min(w, 1.0))) - math.asin(math.sqrt(0.75)))
        return min(max(p, 0.0), 1.0)
    if w >= 1.0:
        return 1.0
    if n <= 11:
        room = _polynomial(SMALL_GAMMA, n) - math.log(1 - w)
        if room <= 0:
            return 0.0
        y, mean = -math.log(room), _polynomial(SMALL_MEAN, n)
        sd = math.exp(_polynomial(SMALL_LOG_SD, n))
    else:
        y, log_n = math.log(1 - w), math.log(n)
        mean = _polynomial(LARGE_MEAN, log_n)
        sd = math.exp(_polynomial(LARGE_LOG_SD, log_n))
    return 0.5 * math.erfc((y - mean) / sd / math.sqrt(2))


def statistic(n: int, squares: float, weighted: float, spread: float, edges: Sequence[float]) -> float:
    """W of n sorted values.

    squares: the sum of the squared normal scores; weighted: that of scores times values; spread: that of
    squared deviations; edges: the largest less the smallest value, and the same of the second ones.
    """
    if n == 3:
        return min(0.5 * edges[0] ** 2 / spread, 1.0)
    score = lambda i: NormalDist().inv_cdf((i - 0.375) / (n + 0.25))
    u, ends = 1 / math.sqrt(n), [score(n), score(n - 1)]
    own = [ends[0] / math.sqrt(squares) + _polynomial(LAST_WEIGHT, u)]
    if n > 5:
        own.append(ends[1] / math.sqrt(squares) + _polynomial(NEXT_WEIGHT, u))
    # The outer weights are given; the others are scores, scaled so that all squares add up to 1.
    phi = (squares - 2 * sum(m * m for m, _ in zip(ends, own))) / (1 - 2 * sum(a * a for a in own))
    inner = weighted - sum(m * e for m, e, _ in zip(ends, edges, own))
    return min((inner / math.sqrt(phi) + sum(a * e for a, e in zip(own, edges))) ** 2 / spread, 1.0)


def _scored(values: DataFrame, k: int) -> dict[int, tuple]:
    """Per item (n, squares, weighted, spread, edges) from rows (item, x), without a sort of whole columns.

    Values are counted, running counts over ranges give the places of each, and the scores of its places are
    summed. A value on very many rows has its places cut into parts, which spread over all tasks.
    """
    counts = materialise(values.groupBy("item", F.col("x").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    mean = (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean")
    about = counts.groupBy("item").agg(F.sum("n").alias("n"), mean, F.min("value").alias("low"), F.max("value").alias("high"))
    known = {r.item: r for r in about.collect() if r.n >= 3 and r.low < r.high}
    if not known:
        return {}
    of = lambda field: F.element_at(
        F.array(*[F.lit(known[i][field] if i in known else None).cast("double") for i in range(k)]), F.col("item") + 1
    )
    ranked = materialise(
        running_weight(counts.filter(F.col("item").isin(list(known))), ["item"], "value", ["n"])
        .select("item", (F.col("value") - of("mean")).alias("d"), "n", F.col("before_n").alias("before"), of("n").alias("all"))
    )
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PART)))
    cut = ranked.select("item", "d", "n", "before", "all", parts.alias("part"))
    few, many = cut.filter(F.col("n") <= PART), cut.filter(F.col("n") > PART).repartition("item", "d", "part")
    first = F.col("before") + 1 + F.col("part") * PART
    last = F.least(F.col("before") + F.col("n"), first + PART - 1)
    score = inverse_normal((F.col("place") - 0.375) / (F.col("all") + 0.25))
    scores = few.unionByName(many).select("item", "d", "all", F.explode(F.sequence(first, last)).alias("place"))
    sums = scores.select("item", "d", score.alias("m")).groupBy("item")
    sums = sums.agg(F.sum(F.col("m") * F.col("m")).alias("squares"), F.sum(F.col("m") * F.col("d")).alias("weighted"))
    # The second value from either end, by its place.
    at = lambda i: F.max(F.when((F.col("before") < i) & (i <= F.col("before") + F.col("n")), F.col("d")))
    ends = ranked.groupBy("item").agg(
        F.sum(F.col("d") * F.col("d") * F.col("n")).alias("spread"), (F.max("d") - F.min("d")).alias("outer"),
        (at(F.col("all") - 1) - at(F.lit(2))).alias("inner"),
    )
    return {
        r.item: (known[r.item].n, r.squares, r.weighted, r.spread, (r.outer, r.inner))
        for r in sums.join(ends, "item").collect()
    }


def smallest(rows: DataFrame, k: int) -> DataFrame:
    """The k rows of the smallest (spot, x) of every item, from rows (item, spot, x).

    Every task keeps at most k per item, the lists of all tasks are merged in about as many groups as their
    square root, and the last few lists once more; what a task holds does not depend on the keys.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            item, spot, x = (c.to_numpy() for c in batch.columns)
            for i in np.unique(item):
                own = np.empty((item == i).sum(), dtype=[("spot", "i8"), ("x", "f8")])
                own["spot"], own["x"] = spot[item == i], x[item == i]
                both = np.concatenate([held.get(i, own[:0]), own])
                held[i] = np.sort(both)[:k] if len(both) > k else both
        for i, own in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), i, dtype=np.int32)), pa.array(own["spot"]), pa.array(own["x"])],
                names=["item", "spot", "x"],
            )

    schema = "item int, spot bigint, x double"
    groups = math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    merged = rows.mapInArrow(keep, schema).repartition(groups, "spot").mapInArrow(keep, schema)
    place = F.row_number().over(Window.partitionBy("item").orderBy("spot", "x"))
    return merged.withColumn("place", place).filter(F.col("place") <= k).select("item", "x")


def normality(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    key: str = ROW_ID,
    digits: int | None = 4,
    sample_size: int | None = None,
    labels: Sequence[str] = bands.CLOSENESS_LABELS,
) -> DataFrame:
    """(column, n, w, closeness, p, normal); fewer than 3 values or a constant gives no row.

    All values are tested. With `sample_size` at most so many per column are, those with the smallest hash
    of `key`, a column that identifies a row; equal keys are told apart by value.
    """
    names = require_numeric(df, columns or numeric_columns(df))
    wanted = list(names)
    if sample_size is not None:
        require_columns(df, [key])
        wanted.append(key)
    df = nan_to_null(df.select(*[col(c) for c in dict.fromkeys(wanted)]))
    spot = F.lit(0).cast("bigint") if sample_size is None else key_hash(key)
    entries = [
        F.when(col(c).isNotNull(), F.struct(F.lit(i).alias("item"), spot.alias("spot"), double(col(c)).alias("x")))
        for i, c in enumerate(names)
    ]
    values = df.select(F.inline(F.array(*entries))).filter("item is not null")
    if sample_size is not None:
        values = smallest(values, sample_size)
    rows = []
    for item, (n, *sums) in sorted(_scored(values, len(names)).items()):
        w = statistic(n, *sums)
        rows.append((names[item], n, w, p_value(w, n)))
    tested = df.sparkSession.createDataFrame(rows, "column string, n bigint, w double, p double")
    return tested.select(
        "column",
        "n",
        rounded(F.col("w"), digits).alias("w"),
        bands.closeness_band(F.col("w"), labels).alias("closeness"),
        rounded(F.col("p"), digits).alias("p"),
        bands.normal_verdict(F.col("p")).alias("normal"),
    )

"""Exact linear-interpolated quantiles of many columns.

One pass outlines every column: the number of its values, their extent, and a sketch's values at a grid of
ranks. The outline brackets each wanted order statistic. A second pass counts the values inside the brackets
one by one and all others by the gap they fall in; running sums over these counts place every entry. A wanted
rank that falls on a gap proves that its bracket missed; that bracket is widened, in the end to the whole
range, so the result never depends on the sketch. There is one path for every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, nan_to_null, require_numeric
from rowmill.functions.scalars import double
from rowmill.operators.ranks import running_weight

SKETCH_SIZE = 4096
GRID = 1000

# Half the share of ranks that a bracket covers, in the first attempt and in the second.
HALF_WIDTHS = (0.003, 0.024)


@dataclass(frozen=True)
class Outline:
    """Number of values, extent, and about the value at every rank share k / GRID of one column."""

    n: int
    low: float | None
    high: float | None
    grid: Sequence[float] | None

    def bracket(self, first: float, last: float) -> tuple[float, float]:
        """A range that should hold the values from one share of the ranks to another."""
        a, b = math.floor(first * GRID), math.ceil(last * GRID)
        low = self.low if self.grid is None or a <= 0 else self.grid[a]
        high = self.high if self.grid is None or b >= GRID else self.grid[b]
        return low, high

    def outside(self, low: float, high: float) -> int:
        """About how many values lie outside a range; rather too many than too few."""
        if self.grid is None:
            return self.n
        inside = sum(low <= g <= high for g in self.grid)
        return min(self.n, math.ceil(self.n * (GRID + 2 - inside) / GRID))


def outline_expressions(name: str) -> list[Column]:
    """The aggregates that make up the outline of a column."""
    x = double(col(name))
    shares = F.expr(f"array({', '.join(f'{k / GRID}D' for k in range(GRID + 1))})")
    sketch = F.kll_sketch_agg_double(x, SKETCH_SIZE)
    # A sketch without values answers no question.
    grid = F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(sketch, shares))
    return [F.count(x), F.min(x), F.max(x), grid]


def outlines(df: DataFrame, columns: Sequence[str]) -> dict[str, Outline]:
    """The outline of each column, all in one pass."""
    row = df.agg(*[e for c in columns for e in outline_expressions(c)]).first()
    return {c: Outline(*row[4 * i : 4 * i + 4]) for i, c in enumerate(columns)}


def _order_statistics(n: int, p: float) -> tuple[int, int, float]:
    position = p * (n - 1)
    lower = min(int(math.floor(position)), n - 1)
    return lower, min(lower + 1, n - 1), position - lower


def _interpolate(lower: float, upper: float, share: float) -> float:
    if share == 0.0 or lower == upper:
        return lower
    return lower + (upper - lower) * share


def _brackets(
    outline: Outline, probs: Sequence[float], width: float, dropped: int = 0
) -> list[tuple[float, float]]:
    """Disjoint ascending ranges that should hold the order statistics at `probs`.

    Of the outlined values up to `dropped` may be gone. A rank among the others is then up to that many
    places further up in the outline.
    """
    gone = min(dropped / outline.n, 1.0)
    step = 1 / max(outline.n - 1, 1)
    found: list[tuple[float, float]] = []
    for p in sorted(probs):
        first = p * (1 - gone)
        low, high = outline.bracket(first - width - step, first + gone + width + step)
        if found and low <= found[-1][1]:
            found[-1] = found[-1][0], max(found[-1][1], high)
        else:
            found.append((low, high))
    return found


def _counted(df: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(item, at, before_n, n): the values inside brackets, and the gaps between them, in order with counts.

    Places of gaps are even, those of brackets odd; a gap has no value. `item` indexes the keys of `brackets`.
    """
    entries = []
    for i, (c, ranges) in enumerate(brackets.items()):
        x = double(col(c))
        place, value = F.lit(2 * len(ranges)), F.lit(None).cast("double")
        for j, (low, high) in reversed(list(enumerate(ranges))):
            below, inside = x < F.lit(low), x <= F.lit(high)
            place = F.when(below, 2 * j).when(inside, 2 * j + 1).otherwise(place)
            value = F.when(below, None).when(inside, x).otherwise(value)
        entry = F.struct(F.lit(i).alias("item"), F.struct(place.alias("place"), value.alias("value")).alias("at"))
        entries.append(F.when(x.isNotNull(), entry))
    counts = (
        df.select(F.inline(F.array(*entries)))
        .filter("item is not null")
        .groupBy("item", "at")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return running_weight(counts, ["item"], "at", ["n"])


def _at_ranks(placed: DataFrame, ranks: list[set[int]]) -> dict[tuple[int, int], float | None]:
    """The value at every (item, rank); None where the rank falls on a gap."""
    hit = F.lit(False)
    for i, wanted in enumerate(ranks):
        for r in sorted(wanted):
            there = (F.col("before_n") <= r) & (F.lit(r) < F.col("before_n") + F.col("n"))
            hit = hit | ((F.col("item") == i) & there)
    found = {}
    # At most one row per wanted order statistic.
    for row in placed.filter(hit).select("item", "before_n", "n", "at.value").collect():
        for r in ranks[row["item"]]:
            if row["before_n"] <= r < row["before_n"] + row["n"]:
                found[row["item"], r] = row["value"]
    return found


def _settled(
    df: DataFrame, outline: dict[str, Outline], probs: Sequence[float], width: float | None, dropped: int
) -> tuple[dict[str, list[float | None]], list[str]]:
    """The quantiles of the columns whose brackets held, and the names of the other columns."""
    if width is None:
        brackets = {c: [(o.low, o.high)] for c, o in outline.items()}
    else:
        brackets = {c: _brackets(o, probs, width, dropped) for c, o in outline.items()}
    placed = _counted(df, brackets)
    sizes = [o.n for o in outline.values()]
    if dropped:
        left = placed.groupBy("item").agg(F.sum("n").alias("n")).collect()
        sizes = [next((r["n"] for r in left if r["item"] == i), 0) for i in range(len(sizes))]
    ranks = [{r for p in probs for r in _order_statistics(n, p)[:2]} if n else set() for n in sizes]
    found = _at_ranks(placed, ranks) if any(ranks) else {}
    result, missed = {}, []
    for i, (c, n) in enumerate(zip(outline, sizes)):
        if any(found[i, r] is None for r in ranks[i]):
            missed.append(c)
            continue
        result[c] = []
        for p in probs:
            lower, upper, share = _order_statistics(n, p) if n else (0, 0, 0.0)
            result[c].append(_interpolate(found[i, lower], found[i, upper], share) if n else None)
    return result, missed


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    exact: bool = True,
    known: dict[str, Outline] | None = None,
    dropped: int = 0,
) -> dict[str, list[float | None]]:
    """Quantiles of each column at `probs`; None where a column has no values.

    `known` passes on the outlines when the caller has them already. They may be those of a table from which
    rows were dropped since, about `dropped` of them: brackets are wider then, and the result as exact.
    `exact=False` answers from a percentile sketch in one pass.
    """
    columns, probs = require_numeric(df, columns), list(probs)
    if not columns:
        return {}
    df = nan_to_null(df.select(*[col(c) for c in columns]))
    if not exact:
        row = df.agg(*[F.percentile_approx(double(col(c)), probs, 100_000) for c in columns]).first()
        return {c: list(row[i]) if row[i] is not None else [None] * len(probs)
                for i, c in enumerate(columns)}
    known = outlines(df, columns) if known is None else known
    open_ = {c: known[c] for c in columns if known[c].n}
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for width in (*HALF_WIDTHS, None):
        if open_ and probs:
            found, missed = _settled(df, open_, probs, width, dropped)
            result |= found
            open_ = {c: open_[c] for c in missed}
    return result


def extents(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """(non-null count, min, max) of each column, in one pass."""
    exprs = []
    for c in columns:
        x = double(col(c))
        exprs += [F.count(x), F.min(x), F.max(x)]
    row = df.agg(*exprs).first()
    return {c: (row[3 * i], row[3 * i + 1], row[3 * i + 2]) for i, c in enumerate(columns)}

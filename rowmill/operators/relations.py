"""Covariance and correlation matrices over pairwise complete rows.

Matrices are long: one row (col_a, col_b, value) per ordered pair.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, nan_to_null, numeric_columns, require_numeric
from rowmill.functions.scalars import double, rounded
from rowmill.operators.kendall import kendall
from rowmill.operators.ranks import placed_values

METHODS = ("pearson", "spearman", "kendall")

MIN_COLUMNS = 2
MAX_COLUMNS = 10


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return nan_to_null(df.select(*[double(col(c)).alias(c) for c in columns]))


def _checked(df: DataFrame, columns: Sequence[str] | None, max_columns: int | None) -> list[str]:
    names = list(dict.fromkeys(require_numeric(df, columns or numeric_columns(df))))
    if len(names) < MIN_COLUMNS:
        raise ValueError("at least two numeric columns are needed")
    if max_columns is not None and len(names) > max_columns:
        raise ValueError(f"at most {max_columns} columns, got {len(names)}")
    return names


def _pairs(k: int) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(k), 2))


def _matrix(df: DataFrame, names: Sequence[str], values: dict, value: str, digits) -> DataFrame:
    rows = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            rows.append((a, b, values[(min(i, j), max(i, j))]))
    table = df.sparkSession.createDataFrame(rows, f"col_a string, col_b string, {value} double")
    return table.coalesce(1).withColumn(value, rounded(F.col(value), digits))


@dataclass(frozen=True)
class _Column:
    """What one pass tells about a column."""

    n: int
    gaps: bool
    centre: float
    varies: bool


def _survey(df: DataFrame, names: Sequence[str]) -> list[_Column]:
    exprs = [F.count(F.lit(1))]
    for c in names:
        x = col(c)
        exprs += [F.count(x), F.avg(x), F.min(x), F.max(x)]
    rows, *found = df.agg(*exprs).first()
    out = []
    for i in range(len(names)):
        n, mean, low, high = found[4 * i : 4 * i + 4]
        out.append(_Column(n, n < rows, mean or 0.0, n > 0 and low < high))
    return out


def _pair_correlations(
    df: DataFrame,
    sides: dict[tuple[int, int | None], Column],
    columns: Sequence[_Column],
) -> dict[tuple[int, int], float | None]:
    """r per pair from one pass of plain sums around the column centres.

    sides[i, None] is column i, sides[i, j] its values on the rows that have column j; the latter is
    needed only where column j has gaps. Sums of this kind compile to far less code than one
    built-in central moment per pair and side.
    """

    def key(i: int, j: int) -> tuple[int, int | None]:
        return (i, j) if i != j and columns[j].gaps else (i, None)

    pairs, exprs, place = _pairs(len(columns)), [], {}

    def want(name: tuple, *wanted: Column) -> None:
        if name not in place:
            place[name] = slice(len(exprs), len(exprs) + len(wanted))
            exprs.extend(wanted)

    def centred(k: tuple[int, int | None]) -> Column:
        return sides[k] - F.lit(columns[k[0]].centre)

    for i, j in pairs:
        for k in (key(i, j), key(j, i)):
            d = centred(k)
            want(("side", k), F.sum(d), F.sum(d * d))
            if k[1] is not None:
                want(("range", k), F.count(sides[k]), F.min(sides[k]) < F.max(sides[k]))
        want(("pair", i, j), F.sum(centred(key(i, j)) * centred(key(j, i))))
    row = df.agg(*exprs).first()

    def known(k: tuple[int, int | None]) -> tuple[int, bool]:
        if k[1] is None:
            return columns[k[0]].n, columns[k[0]].varies
        n, varies = row[place["range", k]]
        return n, bool(varies)

    result: dict[tuple[int, int], float | None] = {}
    for i, j in pairs:
        a, b = key(i, j), key(j, i)
        (n, x_varies), (_, y_varies) = known(a), known(b)
        if not (x_varies and y_varies):
            # A constant is recognised by its range, as its computed deviation may not be zero.
            result[i, j] = None
        elif i == j:
            result[i, j] = 1.0
        else:
            (sx, sxx), (sy, syy) = row[place["side", a]], row[place["side", b]]
            (sxy,) = row[place["pair", i, j]]
            scale = math.sqrt(max(sxx - sx * sx / n, 0.0)) * math.sqrt(max(syy - sy * sy / n, 0.0))
            r = (sxy - sx * sy / n) / scale if scale else None
            result[i, j] = None if r is None else max(-1.0, min(1.0, r))
    return result


def _pearson(df: DataFrame, names: Sequence[str], columns: Sequence[_Column]) -> dict:
    sides: dict[tuple[int, int | None], Column] = {}
    for i, c in enumerate(names):
        sides[i, None] = col(c)
        for j, other in enumerate(names):
            sides[i, j] = F.when(col(other).isNotNull(), col(c))
    return _pair_correlations(df, sides, columns)


def covariance(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    digits: int | None = None,
    max_columns: int | None = MAX_COLUMNS,
) -> DataFrame:
    """Sample covariance of every pair, from one pass."""
    names = _checked(df, columns, max_columns)
    pairs = _pairs(len(names))
    row = _doubles(df, names).agg(
        *[F.covar_samp(col(names[i]), col(names[j])) for i, j in pairs]
    ).first()
    return _matrix(df, names, dict(zip(pairs, row)), "covariance", digits)


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace every value by its average rank within its column; NULL stays NULL."""
    names = require_numeric(df, columns)
    values = _doubles(df, names)
    ranked = placed_values(values, names).select(*[col(f"__r{i}").alias(c) for i, c in enumerate(names)])
    without = values.filter(F.coalesce(*[col(c) for c in names]).isNull())
    return ranked.unionByName(without.select(*[F.lit(None).cast("double").alias(c) for c in names]))


def _spearman(df: DataFrame, names: Sequence[str], columns: Sequence[_Column]) -> dict:
    partners = [j for j, c in enumerate(columns) if c.gaps]
    ranked = placed_values(df, names, partners)
    sides: dict[tuple[int, int | None], Column] = {}
    for i in range(len(names)):
        sides[i, None] = col(f"__r{i}")
        for j in partners:
            # Ranks over fewer rows are smaller, so pairs with gaps have ranks of their own.
            sides[i, j] = F.when(col(f"__r{j}").isNotNull(), col(f"__r{i}_{j}"))
    centred = [replace(c, centre=(c.n + 1) / 2) for c in columns]
    return _pair_correlations(ranked, sides, centred)


def _kendall(df: DataFrame, names: Sequence[str], columns: Sequence[_Column]) -> dict:
    pairs = _pairs(len(names))
    own = {(i, i): 1.0 if c.varies else None for i, c in enumerate(columns)}
    return own | kendall(placed_values(df, names), pairs)


def correlation(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "pearson",
    digits: int | None = None,
    max_columns: int | None = MAX_COLUMNS,
) -> DataFrame:
    """Pearson, Spearman or Kendall tau-b of every pair of columns."""
    if method not in METHODS:
        raise ValueError(f"unknown correlation method: {method}")
    names = _checked(df, columns, max_columns)
    df = _doubles(df, names)
    of_method = {"pearson": _pearson, "spearman": _spearman, "kendall": _kendall}[method]
    values = of_method(df, names, _survey(df, names))
    return _matrix(df, names, values, "r", digits)


def mean_abs_correlation(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "pearson",
    digits: int | None = 3,
    max_columns: int | None = None,
) -> DataFrame:
    """Mean over columns of the mean |r| of each column, diagonal included; 0 for one column."""
    names = list(dict.fromkeys(require_numeric(df, columns or numeric_columns(df))))
    if len(names) < MIN_COLUMNS:
        return df.sparkSession.createDataFrame([(0.0,)], "mean_abs_corr double")
    matrix = correlation(df, names, method, max_columns=max_columns)
    return (
        matrix.groupBy("col_a")
        .agg(F.avg(F.abs("r")).alias("mean_r"))
        .agg(rounded(F.avg("mean_r"), digits).alias("mean_abs_corr"))
    )

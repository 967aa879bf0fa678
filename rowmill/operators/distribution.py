"""The numbers behind distribution figures: bins, density curves, boxes, shares, scatter cells."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.columns import (
    categorical_columns,
    col,
    is_datetime,
    nan_to_null,
    numeric_columns,
    require_columns,
    require_numeric,
)
from rowmill.functions.scalars import double, key_hash
from rowmill.operators.profile import distinct_and_nulls, iqr_fences, per_column
from rowmill.operators.quantiles import extents, quantiles
from rowmill.operators.ranks import count_values

GRID_POINTS = 200
WIDE_BINS = 50
POINTS_PER_CELL = 50
KINDS = ("hist", "hist_density", "box")

# Density curves: cells and reach of the kernel in bandwidths, and the degree of its expansion within a cell.
CELL_SIZE = 0.5
KERNEL_REACH = 9.0
DEGREE = 17


def default_bins(n: int) -> int:
    return min(30, max(10, math.isqrt(n)))


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return nan_to_null(df.select(*[double(col(c)).alias(c) for c in columns]))


def _finite(column: str, low: float, high: float) -> None:
    if math.isinf(low) or math.isinf(high):
        raise ValueError(f"{column} holds infinite values")


@dataclass(frozen=True)
class _Bins:
    n: int
    low: float
    high: float
    count: int

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.count

    def index(self, x: Column) -> Column:
        if self.width == 0:
            return F.lit(0)
        place = F.floor((x - F.lit(self.low)) / F.lit(self.width)).cast("int")
        return F.least(place, F.lit(self.count - 1))

    def edges(self, bin_: Column) -> tuple[Column, Column]:
        low = F.lit(self.low) + bin_ * F.lit(self.width)
        return low, F.when(bin_ == self.count - 1, F.lit(self.high)).otherwise(
            F.lit(self.low) + (bin_ + 1) * F.lit(self.width)
        )


def _fit_bins(df: DataFrame, columns: Sequence[str], bins: int | None) -> dict[str, _Bins]:
    """Equal bins over [min, max] per column; one bin for a constant, none without values."""
    fitted = {}
    for c, (n, low, high) in extents(df, columns).items():
        if n:
            _finite(c, low, high)
            fitted[c] = _Bins(n, low, high, 1 if low == high else (bins or default_bins(n)))
    return fitted


def histogram(
    df: DataFrame,
    columns: Sequence[str] | str,
    bins: int | None = None,
    density: bool = False,
) -> DataFrame:
    """(column, bin, low, high, n[, density]), empty bins included.

    Without `bins` their number follows the number of values, between 10 and 30.
    """
    names = require_numeric(df, [columns] if isinstance(columns, str) else columns)
    df = _doubles(df, names)
    return _bars(df, _fit_bins(df, names, bins), density)


def _bars(df: DataFrame, fitted: dict[str, _Bins], density: bool = False) -> DataFrame:
    if not fitted:
        schema = "column string, bin int, low double, high double, n bigint"
        return df.sparkSession.createDataFrame([], schema + ", density double" * density)
    present, bins = list(fitted), list(fitted.values())

    def entries(item: Sequence[tuple[Column, Column]]) -> Column:
        return F.inline(
            F.array(
                *[
                    F.when(shown, F.struct(F.lit(i).alias("item"), bin_.alias("bin")))
                    for i, (shown, bin_) in enumerate(item)
                ]
            )
        )

    counts = (
        df.select(entries([(col(c).isNotNull(), fitted[c].index(col(c))) for c in present]))
        .filter("item is not null")
        .groupBy("item", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Every bin of every column once, with weight zero, so that empty bins stay in the result.
    number = F.col("id").cast("int")
    zero = (
        df.sparkSession.range(max(b.count for b in bins))
        .select(entries([(number < b.count, number) for b in bins]))
        .filter("item is not null")
    )
    filled = (
        counts.unionByName(zero.withColumn("n", F.lit(0).cast("long")))
        .groupBy("item", "bin")
        .agg(F.sum("n").alias("n"))
    )

    def pick(values: Sequence[Column]) -> Column:
        return F.element_at(F.array(*values), F.col("item") + 1)

    edges = [b.edges(F.col("bin")) for b in bins]
    shown = [
        pick([F.lit(c) for c in present]).alias("column"),
        "bin",
        pick([low for low, _ in edges]).alias("low"),
        pick([high for _, high in edges]).alias("high"),
        "n",
    ]
    if density:
        area = pick([F.lit(b.n * b.width) for b in bins])
        shown.append(F.try_divide(F.col("n"), area).alias("density"))
    return filled.select(*shown)


def numeric_distribution(
    df: DataFrame, columns: Sequence[str] | None = None, bins: int = WIDE_BINS
) -> DataFrame:
    """The histogram of every numeric column; box_stats gives the matching boxes."""
    return histogram(df, columns or numeric_columns(df), bins)


def _factors(x: Column, degree: int) -> list[Column]:
    """x^k / k! for k up to `degree`."""
    found = [F.lit(1.0)]
    for k in range(1, degree + 1):
        found.append(found[-1] * x / F.lit(float(k)))
    return found


def kde(df: DataFrame, column: str, points: int = GRID_POINTS) -> DataFrame:
    """(point, x, density): Gaussian density between min and max, bandwidth sd * n^(-1/5).

    Values are summed up by cells of half a bandwidth: per cell the moments around its middle. The kernel of a
    value d bandwidths from the middle m, seen from a point u bandwidths from m, is the sum over k of
    d^k / k! * He_k(u) * exp(-u * u / 2) with the Hermite polynomials He_k, so each cell adds its moments times
    these to the points within KERNEL_REACH bandwidths. As |He_k(u)| exp(-u * u / 4) < 1.09 sqrt(k!) and
    d <= 1/4, what is cut off is below 1e-16 of one value's peak; what is out of reach is below 1e-17 of it.
    The cost is that of one aggregation over the rows, and cells times points in reach.

    Empty for a column with fewer than two different values.
    """
    require_numeric(df, [column])
    spark = df.sparkSession
    schema = "point int, x double, density double"
    df = _doubles(df, [column]).select(col(column).alias("x")).filter("x is not null")
    n, low, high, sd = df.agg(
        F.count("x"), F.min("x"), F.max("x"), F.stddev_samp("x")
    ).first()
    if n < 2 or low == high:
        return spark.createDataFrame([], schema)
    _finite(column, low, high)
    bandwidth = sd * n ** (-1 / 5)
    step = (high - low) / (points - 1)
    size = CELL_SIZE * bandwidth
    placed = df.select(
        F.floor((F.col("x") - F.lit(low)) / F.lit(size)).alias("cell"), F.col("x")
    ).select("cell", ((F.col("x") - F.lit(low) - (F.col("cell") + 0.5) * size) / F.lit(bandwidth)).alias("d"))
    cells = placed.groupBy("cell").agg(
        *[F.sum(f).alias(f"m{k}") for k, f in enumerate(_factors(F.col("d"), DEGREE))]
    )
    # The grid points in reach of each cell, and the distance of each in bandwidths.
    middle, reach = (F.col("cell") + 0.5) * size, KERNEL_REACH * bandwidth
    first = F.greatest(F.ceil((middle - reach) / step), F.lit(0).cast("long")).cast("int")
    last = F.least(F.floor((middle + reach) / step), F.lit(points - 1).cast("long")).cast("int")
    seen = cells.filter(first <= last).select("*", F.explode(F.sequence(first, last)).alias("point"))
    u = (F.col("point") * F.lit(step) - middle) / F.lit(bandwidth)
    moments = [f"m{k}" for k in range(DEGREE + 1)]
    state = seen.select("point", *moments, u.alias("u")).select(
        "point", *moments, "u", F.exp(F.col("u") * F.col("u") * -0.5).alias("peak")
    )
    # sum of m_k He_k(u) by He_(k+1) = u He_k - k He_(k-1), kept as (total, He_k, He_(k-1)).
    terms = F.array(*[F.struct(F.lit(float(k)).alias("k"), F.col(m).alias("m")) for k, m in enumerate(moments)])
    start = F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("now"), F.lit(0.0).alias("before"))

    def add(so_far: Column, term: Column) -> Column:
        now, before = so_far["now"], so_far["before"]
        return F.struct(
            (so_far["total"] + term["m"] * now).alias("total"),
            (F.col("u") * now - term["k"] * before).alias("now"),
            now.alias("before"),
        )

    total = F.aggregate(terms, start, add, lambda so_far: so_far["total"]) * F.col("peak")
    curve = state.select("point", total.alias("total")).groupBy("point").agg(F.sum("total").alias("total"))
    # Points out of every value's reach have density zero.
    grid = spark.range(points).select(F.col("id").cast("int").alias("point"))
    scale = n * bandwidth * math.sqrt(2 * math.pi)
    return grid.join(F.broadcast(curve), "point", "left").select(
        "point",
        (F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
        F.greatest(F.coalesce(F.col("total"), F.lit(0.0)) / F.lit(scale), F.lit(0.0)).alias("density"),
    )


def box_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, mean, whiskers and number of outliers per column.

    A whisker ends at the last value inside the 1.5 IQR fence.
    """
    names = require_numeric(df, columns or numeric_columns(df))
    df = _doubles(df, names)
    entries = []
    for c, (q1, median, q3) in quantiles(df, names, [0.25, 0.5, 0.75]).items():
        if q1 is None:
            continue
        low, high = iqr_fences(q1, q3)
        x = col(c)
        inside = x.between(low, high)
        entries.append(
            (
                c,
                {
                    "n": F.count(x), "mean": F.avg(x), "q1": F.lit(q1), "median": F.lit(median),
                    "q3": F.lit(q3), "whisker_low": F.min(F.when(inside, x)),
                    "whisker_high": F.max(F.when(inside, x)), "outliers": F.count_if(~inside),
                },
            )
        )
    if not entries:
        return df.sparkSession.createDataFrame(
            [],
            "column string, n bigint, mean double, q1 double, median double, q3 double, "
            "whisker_low double, whisker_high double, outliers bigint",
        )
    return per_column(df, entries)


def box_outliers(df: DataFrame, column: str) -> DataFrame:
    """The values outside the fences, one row each."""
    require_numeric(df, [column])
    values = _doubles(df, [column]).select(col(column).alias("value"))
    q1, q3 = quantiles(values, ["value"], [0.25, 0.75])["value"]
    if q1 is None:
        return values.filter(F.lit(False))
    low, high = iqr_fences(q1, q3)
    return values.filter((F.col("value") < low) | (F.col("value") > high))


def distribution(df: DataFrame, column: str, kind: str = "hist") -> dict[str, DataFrame]:
    """The tables of one figure: hist, hist_density (bars and curve) or box."""
    if kind not in KINDS:
        raise ValueError(f"unknown figure: {kind}")
    if kind == "hist":
        return {"histogram": histogram(df, column)}
    if kind == "hist_density":
        return {"histogram": histogram(df, column, density=True), "kde": kde(df, column)}
    return {"box": box_stats(df, [column]), "outliers": box_outliers(df, column)}


def category_shares(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_categories: int | None = None,
) -> DataFrame:
    """(column, value, n, share, distinct, reason) of the non-null values per column.

    A column with one value or none gives a single row with a reason instead, and so does a column of dates
    or, where `max_categories` is given (15 suit a figure), one with more values than that.
    """
    names = require_columns(df, columns or categorical_columns(df))
    dates = [c for c in names if is_datetime(df.schema[c].dataType)]
    names = [c for c in names if c not in dates]
    df = nan_to_null(df.select(*[col(c) for c in names]))
    # The sizes decide first, so that only columns with few values are grouped by their text.
    sizes = (
        {names[r["item"]]: r for r in distinct_and_nulls(df, names).collect()} if names else {}
    )
    limit = float("inf") if max_categories is None else max_categories
    shown = [c for c in names if 2 <= sizes[c]["distinct"] <= limit]
    reasons = [(c, None, None, None, None, "datetime") for c in dates]
    for c in names:
        if c not in shown:
            few = sizes[c]["distinct"] < 2
            reason = "fewer than 2 values" if few else "too many values"
            reasons.append((c, None, None, None, sizes[c]["distinct"], reason))
    omitted = df.sparkSession.createDataFrame(
        reasons,
        "column string, value string, n bigint, share double, distinct bigint, reason string",
    )
    if not shown:
        return omitted

    def pick(values: Sequence[Column]) -> Column:
        return F.element_at(F.array(*values), F.col("item") + 1)

    texts = df.select(*[col(c).cast("string").alias(c) for c in shown])
    shares = (
        count_values(texts, shown)
        .filter("value is not null")
        .select(
            pick([F.lit(c) for c in shown]).alias("column"),
            "value",
            "n",
            (F.col("n") / pick([F.lit(sizes[c]["present"]) for c in shown])).alias("share"),
            pick([F.lit(sizes[c]["distinct"]) for c in shown]).cast("bigint").alias("distinct"),
            F.lit(None).cast("string").alias("reason"),
        )
    )
    return shares.unionByName(omitted) if reasons else shares


@dataclass(frozen=True)
class Scatter:
    """Tables of a scatter figure; `reason` is set, and the tables are empty, without points."""

    points: DataFrame
    cells: DataFrame
    marginal_x: DataFrame
    marginal_y: DataFrame
    reason: str | None


def scatter(
    df: DataFrame, x: str, y: str, colour: str | None = None, bins: int = WIDE_BINS,
    per_cell: int | None = POINTS_PER_CELL, key: str | None = None,
) -> Scatter:
    """Complete rows of two columns as points, as counts per 2-D cell, and both margins.

    `points` holds all rows of a cell and colour, or a sample of `per_cell` of them where there are more: those
    with the smallest hash of `key` (without one, of the point itself), so that sparse regions stay whole and
    the table does not grow with the rows. `cells` and the margins count all rows.
    """
    require_numeric(df, [x, y])
    require_columns(df, [c for c in (colour, key) if c is not None])
    wanted = [double(col(x)).alias("x"), double(col(y)).alias("y")]
    if colour is not None:
        wanted.append(col(colour).alias("colour"))
    names = ["x", "y", "colour"][: len(wanted)]
    spot = F.xxhash64(*[w for w in wanted]) if key is None else key_hash(key)
    spotted = nan_to_null(df.select(*wanted, spot.alias("__spot"))).na.drop(subset=names)
    points = spotted.drop("__spot")
    fitted = _fit_bins(points, ["x", "y"], bins)
    groups = ["colour"] if colour is not None else []
    reason = None if fitted else "no complete rows"
    spots = {
        c: (b.index(F.col(c)) if (b := fitted.get(c)) else F.lit(0)).alias(f"bin_{c}")
        for c in ("x", "y")
    }
    cells = points.groupBy(*spots.values(), *groups).agg(F.count(F.lit(1)).alias("n"))
    margins = _bars(points, fitted)
    shown = points
    if per_cell is not None:
        # Spark keeps the first rows of every cell in each task before it gathers them.
        order = Window.partitionBy("bin_x", "bin_y", *groups).orderBy("__spot", "x", "y")
        placed = spotted.select("*", *spots.values()).withColumn("place", F.row_number().over(order))
        shown = placed.filter(F.col("place") <= per_cell).select(*names)
    return Scatter(
        shown,
        cells,
        margins.filter(F.col("column") == "x").drop("column"),
        margins.filter(F.col("column") == "y").drop("column"),
        reason,
    )

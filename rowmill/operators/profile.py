"""Reports about a table: shape, nulls, types, descriptive statistics, outliers.

Every report has one row per column. Statistics of all columns come from shared passes over the
table; what reaches the driver is a handful of numbers per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions import bands
from rowmill.functions.columns import (
    ROW_ID,
    categorical_columns,
    col,
    column_class,
    dtype_name,
    is_atomic,
    is_fractional,
    nan_to_null,
    numeric_columns,
    raw_columns,
    require_columns,
    require_numeric,
    scaled_columns,
    visible_columns,
)
from rowmill.functions.scalars import (
    corrected_kurtosis,
    corrected_skewness,
    double,
    percent,
    rounded,
)
from rowmill.operators.quantiles import Outline, outline_expressions, quantiles
from rowmill.operators.ranks import count_values
from rowmill.plans.storage import materialise

# Longer text is compared by its SHA-256 digest when distinct values are counted.
DIGEST_OVER_BYTES = 64

FENCE = 1.5


def per_column(df: DataFrame, entries: Sequence[tuple[str, dict[str, Column]]]) -> DataFrame:
    """One global aggregation, turned into one row per entry: (column, metric...)."""
    structs = [
        F.struct(F.lit(name).alias("column"), *[e.alias(k) for k, e in metrics.items()])
        for name, metrics in entries
    ]
    return df.agg(F.array(*structs).alias("__rows")).select(F.inline("__rows"))


def _report(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema).coalesce(1)


def _nulls(c: str) -> Column:
    return F.count_if(col(c).isNull())


def _total_nulls(columns: Sequence[str]) -> Column:
    per_row = F.lit(0)
    for c in columns:
        per_row = per_row + col(c).isNull().cast("int")
    return F.coalesce(F.sum(per_row.cast("long")), F.lit(0).cast("long"))


def overview_shape(df: DataFrame, digits: int | None = 1) -> DataFrame:
    """Rows, columns, missing cells and their share of all cells in percent."""
    df = nan_to_null(df)
    names = visible_columns(df)
    counted = df.agg(F.count(F.lit(1)).alias("rows"), _total_nulls(names).alias("nulls"))
    cells = F.col("rows") * F.lit(len(names))
    return counted.select(
        "rows",
        F.lit(len(names)).cast("long").alias("columns"),
        "nulls",
        percent(F.col("nulls"), cells, digits).alias("null_pct"),
    )


def table_status(df: DataFrame, operations: int = 0) -> DataFrame:
    """Shape, missing cells, categorical columns and the number of logged operations."""
    return overview_shape(df, None).select(
        "rows",
        "columns",
        "nulls",
        F.lit(len(categorical_columns(df))).cast("long").alias("categorical"),
        F.lit(operations).cast("long").alias("operations"),
    )


def run_summary(source: DataFrame, current: DataFrame, operations: int = 0) -> DataFrame:
    """Rows and columns before and after, missing cells left, operations."""
    names = visible_columns(current)
    rows_before = source.count()
    rows_after, nulls_left = (
        nan_to_null(current).agg(F.count(F.lit(1)), _total_nulls(names)).first()
    )
    row = (
        rows_before, rows_after, len(visible_columns(source)), len(names), nulls_left, operations,
    )
    return _report(
        current,
        [row],
        "rows_before bigint, rows_after bigint, columns_before bigint, columns_after bigint, "
        "nulls_left bigint, operations bigint",
    )


def selection_counts(
    df: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None
) -> dict[str, int]:
    """How many numeric and categorical columns a selection covers; none means all."""
    return {
        "numeric": len(numeric or numeric_columns(df)),
        "categorical": len(categorical or categorical_columns(df)),
    }


def missing_report(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    digits: int | None = 2,
    labels: Sequence[str] = bands.MISSING_LABELS,
) -> DataFrame:
    """Missing values per column with percent and severity; the band follows the shown percent."""
    names = require_columns(df, columns or visible_columns(df))
    rows = F.count(F.lit(1))
    report = per_column(
        nan_to_null(df.select(*[col(c) for c in names])),
        [(c, {"nulls": _nulls(c), "pct": percent(_nulls(c), rows, digits)}) for c in names],
    )
    return report.withColumn("severity", bands.missing_band(F.col("pct"), labels))


def null_counts(df: DataFrame, digits: int | None = 1) -> DataFrame:
    """Columns with missing values, most affected first."""
    return (
        missing_report(df, digits=digits)
        .filter("nulls > 0")
        .select("column", "nulls", "pct")
        .orderBy(F.desc("nulls"), "column")
    )


def columns_with_nulls(df: DataFrame) -> list[str]:
    names = visible_columns(df)
    row = nan_to_null(df.select(*[col(c) for c in names])).agg(*[_nulls(c) for c in names]).first()
    return [c for c, n in zip(names, row) if n]


def _distinct_key(x: Column, data_type: T.DataType) -> tuple[Column, Column]:
    """A number slot and a text slot that together identify a value."""
    if is_fractional(data_type):
        return double(x), F.lit(None).cast("string")
    if isinstance(data_type, T.TimestampType):
        # As text of a zone, the two passes of an hour that the clock repeats would be one.
        return F.lit(None).cast("double"), F.unix_micros(x).cast("string")
    text = x.cast("string")
    if isinstance(data_type, T.StringType):
        text = F.when(F.octet_length(x) <= DIGEST_OVER_BYTES, x).otherwise(
            F.concat(F.lit("sha256:"), F.sha2(x, 256))
        )
        text = F.when(x.isNotNull(), text)
    return F.lit(None).cast("double"), text


def distinct_and_nulls(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(item, distinct, nulls, present): distinct values, nulls and values of `columns[item]`."""
    if not exact:
        entries = []
        for i, c in enumerate(columns):
            distinct = F.approx_count_distinct(col(c))
            counts = {"distinct": distinct, "nulls": _nulls(c), "present": F.count(col(c))}
            entries.append((str(i), counts))
        return per_column(df, entries).select(
            F.col("column").cast("int").alias("item"), "distinct", "nulls", "present"
        )
    keys = []
    for i, c in enumerate(columns):
        number, text = _distinct_key(col(c), df.schema[c].dataType)
        keys.append(
            F.struct(F.lit(i).alias("item"), number.alias("number"), text.alias("text"))
        )
    counts = (
        df.select(F.inline(F.array(*keys)))
        .groupBy("item", "number", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A zero-weight entry per column keeps columns of an empty table in the report.
    empty = df.sparkSession.range(len(columns)).select(
        F.col("id").cast("int").alias("item"),
        F.lit(None).cast("double").alias("number"),
        F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n"),
    )
    missing = F.col("number").isNull() & F.col("text").isNull()
    return (
        counts.unionByName(empty)
        .groupBy("item")
        .agg(
            F.count_if(~missing).alias("distinct"),
            F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("nulls"),
            F.sum(F.when(missing, 0).otherwise(F.col("n"))).alias("present"),
        )
    )


def column_report(df: DataFrame, exact: bool = True) -> DataFrame:
    """Class, type, distinct non-null values and nulls of every column.

    Nested columns have no distinct count.
    """
    df = nan_to_null(df)
    names = visible_columns(df)
    flat = [c for c in names if is_atomic(df.schema[c].dataType)]
    nested = [c for c in names if c not in flat]

    def described(report: DataFrame, columns: list[str]) -> DataFrame:
        def pick(texts: list[str]) -> Column:
            return F.element_at(F.array(*[F.lit(t) for t in texts]), F.col("item") + 1)

        types = [df.schema[c].dataType for c in columns]
        return report.select(
            pick(columns).alias("column"),
            pick([column_class(t) for t in types]).alias("class"),
            pick([dtype_name(t) for t in types]).alias("dtype"),
            "distinct",
            "nulls",
        )

    parts = []
    if flat:
        parts.append(described(distinct_and_nulls(df, flat, exact), flat))
    if nested:
        entries = [
            (str(i), {"distinct": F.lit(None).cast("long"), "nulls": _nulls(c)})
            for i, c in enumerate(nested)
        ]
        report = per_column(df, entries).withColumn("item", F.col("column").cast("int"))
        parts.append(described(report, nested))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def distinct_count(df: DataFrame, column: str, exact: bool = True) -> int:
    """Distinct non-null values of one column."""
    require_columns(df, [column])
    return distinct_and_nulls(nan_to_null(df.select(col(column))), [column], exact).first()[1]


_STATS = [
    "mean", "q1", "median", "q3", "min", "max", "range", "iqr", "variance", "sd", "cv",
    "skewness", "kurtosis", "count", "sum",
]


def _outline_expressions(name: str, exact: bool) -> list[Column]:
    """Those of an outline, without its sketch where nothing asks for it."""
    found = outline_expressions(name)
    return found if exact else [*found[:3], F.lit(None)]


def numeric_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    digits: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """Fifteen statistics per numeric column; skewness and kurtosis are bias-corrected."""
    names = require_numeric(df, columns or numeric_columns(df))
    schema = "column string, " + ", ".join(
        f"{m} {'bigint' if m == 'count' else 'double'}" for m in _STATS
    )
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    df = nan_to_null(df.select(*[col(c) for c in names]))
    exprs = []
    for c in names:
        x = double(col(c))
        exprs += [
            *_outline_expressions(c, exact), F.avg(x), F.var_samp(x), F.skewness(x), F.kurtosis(x), F.sum(x),
        ]
    flat = df.agg(*exprs).first()
    found = {c: flat[9 * i : 9 * i + 9] for i, c in enumerate(names)}
    known = {c: Outline(*f[:4]) for c, f in found.items()}
    moments = {c: (*f[:3], *f[4:]) for c, f in found.items()}
    quartiles = quantiles(df, names, [0.25, 0.5, 0.75], exact=exact, known=known)
    base = [(c, *moments[c], *quartiles[c]) for c in names]
    raw = _report(
        df,
        base,
        "column string, count bigint, min double, max double, mean double, variance double, "
        "g1 double, g2 double, sum double, q1 double, median double, q3 double",
    )
    sd, mean, n = F.sqrt("variance"), F.col("mean"), F.col("count")
    stats = {
        "mean": mean, "q1": F.col("q1"), "median": F.col("median"), "q3": F.col("q3"),
        "min": F.col("min"), "max": F.col("max"), "range": F.col("max") - F.col("min"),
        "iqr": F.col("q3") - F.col("q1"), "variance": F.col("variance"), "sd": sd,
        "cv": F.when(mean == 0, F.lit(0.0)).otherwise(F.try_divide(sd, mean)),
        "skewness": corrected_skewness(F.col("g1"), n, sd),
        "kurtosis": corrected_kurtosis(F.col("g2"), n, sd),
        "count": n, "sum": F.coalesce(F.col("sum"), F.lit(0.0)),
    }
    return raw.select(
        "column",
        *[(e if m == "count" else rounded(e, digits)).alias(m) for m, e in stats.items()],
    )


def describe_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    digits: int | None = 3,
    exact: bool = True,
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per numeric column."""
    names = require_numeric(df, columns or numeric_columns(df))
    schema = (
        "column string, count bigint, mean double, sd double, min double, q1 double, "
        "median double, q3 double, max double"
    )
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    df = nan_to_null(df.select(*[col(c) for c in names]))
    exprs = []
    for c in names:
        x = double(col(c))
        exprs += [*_outline_expressions(c, exact), F.avg(x), F.stddev_samp(x)]
    flat = df.agg(*exprs).first()
    found = {c: flat[6 * i : 6 * i + 6] for i, c in enumerate(names)}
    known = {c: Outline(*f[:4]) for c, f in found.items()}
    quartiles = quantiles(df, names, [0.25, 0.5, 0.75], exact=exact, known=known)
    rows = [
        (c, found[c][0], found[c][4], found[c][5], found[c][1], *quartiles[c], found[c][2])
        for c in names
    ]
    table = _report(df, rows, schema)
    return table.select(
        "column", "count", *[rounded(col(c), digits).alias(c) for c in table.columns[2:]]
    )


def moment_stats(
    df: DataFrame, columns: Sequence[str], digits: int | None = 3
) -> DataFrame:
    """Mean, standard deviation, minimum and maximum per column."""
    names = require_numeric(df, columns)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, mean double, sd double, min double, max double"
        )
    entries = []
    for c in names:
        x = double(col(c))
        stats = {"mean": F.avg(x), "sd": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        entries.append((c, {k: rounded(e, digits) for k, e in stats.items()}))
    return per_column(nan_to_null(df.select(*[col(c) for c in names])), entries)


def raw_stats(df: DataFrame, digits: int | None = 3) -> DataFrame:
    """moment_stats of the numeric columns that are not scaled."""
    return moment_stats(df, raw_columns(df), digits)


def scaled_stats(df: DataFrame, digits: int | None = 3) -> DataFrame:
    """moment_stats of the scaled columns."""
    return moment_stats(df, scaled_columns(df), digits)


def categorical_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    digits: int | None = 3,
    null_label: str | None = "nan",
) -> DataFrame:
    """Distinct values, rows, mode, its frequency and share per text column.

    NULL competes for the mode and is then shown as `null_label`. Among equally frequent values the
    smallest wins, NULL last.
    """
    names = require_columns(df, columns or categorical_columns(df))
    if not names:
        return df.sparkSession.createDataFrame(
            [],
            "column string, distinct bigint, rows bigint, mode string, mode_count bigint, "
            "mode_share double",
        )
    shown = nan_to_null(df.select(*[col(c) for c in names]))
    counts = count_values(shown.select(*[col(c).cast("string").alias(c) for c in names]), names)
    order = F.struct(-F.col("n"), F.col("value").isNull(), F.col("value"))
    return (
        counts.groupBy("item")
        .agg(
            F.count("value").alias("distinct"),
            F.sum("n").alias("rows"),
            F.min_by("value", order).alias("mode"),
            F.max("n").alias("mode_count"),
        )
        .select(
            F.element_at(F.array(*[F.lit(c) for c in names]), F.col("item") + 1).alias("column"),
            "distinct",
            "rows",
            F.coalesce(F.col("mode"), F.lit(null_label)).alias("mode"),
            "mode_count",
            rounded(F.col("mode_count") / F.col("rows"), digits).alias("mode_share"),
        )
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n) of the non-null values, most frequent first, then by value."""
    require_columns(df, [column])
    return (
        nan_to_null(df.select(col(column)))
        .filter(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def encoding_status(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    key: str = ROW_ID,
    first: int = 5,
    null_label: str = "nan",
) -> DataFrame:
    """Distinct non-null values and the first few values, in order of appearance by `key`."""
    names = require_columns(df, columns or categorical_columns(df))
    require_columns(df, [key])
    entries = [
        F.struct(F.lit(i).alias("item"), col(c).cast("string").alias("value"), col(key).alias("at"))
        for i, c in enumerate(names)
    ]
    # Read twice below, so written: the distinct values are far fewer than the rows.
    seen = materialise(
        df.select(F.inline(F.array(*entries)))
        .groupBy("item", "value")
        .agg(F.min("at").alias("at"))
    )
    # Spark limits every group to `first` rows before the shuffle of this window.
    order = Window.partitionBy("item").orderBy("at")
    samples = (
        seen.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= first)
        .groupBy("item")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("place", F.coalesce("value", F.lit(null_label)).alias("value"))
                )
            ).alias("places")
        )
        .select("item", F.array_join(F.col("places.value"), ", ").alias("values"))
    )
    sizes = seen.groupBy("item").agg(F.count("value").alias("distinct"))
    return sizes.join(samples, "item").select(
        F.element_at(F.array(*[F.lit(c) for c in names]), F.col("item") + 1).alias("column"),
        "distinct",
        "values",
    )


def iqr_fences(q1: float, q3: float) -> tuple[float, float]:
    spread = q3 - q1
    return q1 - FENCE * spread, q3 + FENCE * spread


def _count_outliers(
    df: DataFrame, tests: dict[str, tuple[Column, dict[str, Column]]], digits: int | None,
    labels: Sequence[str],
) -> DataFrame:
    entries = []
    for c, (is_outlier, extra) in tests.items():
        found, n = F.count_if(is_outlier), F.count(col(c))
        entries.append(
            (c, {"n": n, "outliers": found, "pct": percent(found, n, digits), **extra})
        )
    report = per_column(df, entries)
    return report.withColumn("severity", bands.outlier_band(F.col("pct"), labels))


def outlier_report(
    df: DataFrame,
    method: str = "iqr",
    k: float = 3.0,
    columns: Sequence[str] | None = None,
    digits: int | None = 2,
    labels: Sequence[str] = bands.OUTLIER_LABELS,
    exact: bool = True,
) -> DataFrame:
    """Outliers per numeric column by the IQR fences or by |x - mean| > k population sd.

    Columns without values are left out. The band follows the shown percent.
    """
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method: {method}")
    names = require_numeric(df, columns or numeric_columns(df))
    df = nan_to_null(df.select(*[col(c) for c in names]))
    tests: dict[str, tuple[Column, dict[str, Column]]] = {}
    if method == "iqr":
        for c, (q1, q3) in quantiles(df, names, [0.25, 0.75], exact=exact).items():
            if q1 is not None:
                low, high = iqr_fences(q1, q3)
                tests[c] = ((double(col(c)) < low) | (double(col(c)) > high), {})
    elif names:
        fits = [f(double(col(c))) for c in names for f in (F.avg, F.stddev_pop)]
        row = df.agg(*fits).first()
        for i, c in enumerate(names):
            mean, sd = row[2 * i], row[2 * i + 1]
            if mean is not None:
                tests[c] = (F.abs(double(col(c)) - mean) > k * (sd or 1.0), {})
    shown = "IQR" if method == "iqr" else f"Z-score {k:g}"
    if not tests:
        return df.sparkSession.createDataFrame(
            [],
            "column string, n bigint, outliers bigint, pct double, severity string, method string",
        )
    return _count_outliers(df, tests, digits, labels).withColumn("method", F.lit(shown))


def outlier_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    digits: int | None = 1,
    labels: Sequence[str] = bands.OUTLIER_LABELS,
    exact: bool = True,
) -> DataFrame:
    """The IQR report with one decimal, plus the quartiles and the fences."""
    names = require_numeric(df, columns or numeric_columns(df))
    df = nan_to_null(df.select(*[col(c) for c in names]))
    tests = {}
    for c, (q1, q3) in quantiles(df, names, [0.25, 0.75], exact=exact).items():
        if q1 is not None:
            low, high = iqr_fences(q1, q3)
            bounds = {"q1": q1, "q3": q3, "lower": low, "upper": high}
            tests[c] = (
                (double(col(c)) < low) | (double(col(c)) > high),
                {name: F.lit(float(v)) for name, v in bounds.items()},
            )
    if not tests:
        return df.sparkSession.createDataFrame(
            [],
            "column string, n bigint, outliers bigint, pct double, q1 double, q3 double, "
            "lower double, upper double, severity string",
        )
    return _count_outliers(df, tests, digits, labels)

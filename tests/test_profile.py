import pytest
from pyspark.sql import functions as F

import rowmill as rm


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_numeric_stats_of_ties(ties):
    r = rm.numeric_stats(ties).first()
    assert (r["count"], r["min"], r["max"], r["range"]) == (8, 1.0, 10.0, 9.0)
    assert r["sd"] == pytest.approx(3.155918, abs=1e-6)
    assert r["skewness"] == pytest.approx(0.648714, abs=1e-6)
    assert r["kurtosis"] == pytest.approx(-0.759225, abs=1e-6)
    assert (r["q1"], r["median"], r["q3"], r["iqr"]) == (2.0, 3.75, 7.0, 5.0)


def test_numeric_stats_equal_pandas(spark, messy):
    got = by_column(rm.numeric_stats(spark.createDataFrame(messy)))
    for c in messy:
        s = messy[c]
        expected = {
            "mean": s.mean(), "q1": s.quantile(0.25), "median": s.median(), "q3": s.quantile(0.75),
            "min": s.min(), "max": s.max(), "variance": s.var(), "sd": s.std(),
            "cv": s.std() / s.mean() if s.mean() else 0, "skewness": s.skew(),
            "kurtosis": s.kurtosis(), "count": s.count(), "sum": s.sum(),
        }
        for metric, value in expected.items():
            assert got[c][metric] == pytest.approx(value, rel=1e-9, abs=1e-9), (c, metric)


def test_numeric_stats_of_degenerate_columns(frame):
    got = by_column(
        rm.numeric_stats(frame([(5.0, None, 1)], "one double, none double, whole int"))
    )
    assert got["one"]["sd"] is None and got["one"]["skewness"] is None
    assert got["one"]["mean"] == 5.0
    assert got["none"]["count"] == 0 and got["none"]["mean"] is None and got["none"]["sum"] == 0.0
    assert got["whole"]["median"] == 1.0


def test_zero_mean_has_no_variation_coefficient(frame):
    assert rm.numeric_stats(frame([(-1.0,), (1.0,)], "x double")).first()["cv"] == 0.0


def test_nan_counts_as_missing(frame):
    df = frame([(1.0,), (float("nan"),), (None,)], "x double")
    assert rm.missing_report(df).first()["nulls"] == 2
    assert rm.numeric_stats(df).first()["mean"] == 1.0
    assert by_column(rm.column_report(df))["x"]["distinct"] == 1


def test_empty_table_has_reports_without_errors(frame):
    df = frame([], "x double, c string")
    r = rm.overview_shape(df).first()
    assert (r["rows"], r["columns"], r["nulls"], r["null_pct"]) == (0, 2, 0, 0.0)
    assert by_column(rm.missing_report(df))["x"]["pct"] == 0.0
    assert by_column(rm.column_report(df)).keys() == {"x", "c"}
    assert rm.outlier_report(df).count() == 0
    assert rm.histogram(df, "x").count() == 0
    assert rm.category_shares(df).first()["reason"] == "fewer than 2 values"


@pytest.mark.parametrize(
    "nulls,severity",
    [(0, "trivial"), (9, "trivial"), (10, "manageable"), (50, "sophisticated"), (150, "harmful"),
     (1000, "harmful")],
)
def test_missing_severity(spark, nulls, severity):
    df = spark.range(1000).select(F.when(F.col("id") >= nulls, F.col("id")).alias("x"))
    r = rm.missing_report(df).first()
    assert (r["nulls"], r["severity"]) == (nulls, severity)


def test_null_counts_lists_affected_columns_first(frame):
    df = frame([(None, None, 1), (None, 2, 1), (3, 3, 1)], "a int, b int, c int")
    assert [(r["column"], r["nulls"], r["pct"]) for r in rm.null_counts(df).collect()] == [
        ("a", 2, 66.7), ("b", 1, 33.3),
    ]


def test_column_report_leaves_nested_columns_uncounted(frame):
    df = frame([("a", [1], True), ("a", [2], None)], "t string, v array<int>, b boolean")
    got = by_column(rm.column_report(df))
    assert (got["t"]["class"], got["t"]["dtype"], got["t"]["distinct"]) == ("cat", "object", 1)
    assert (got["v"]["distinct"], got["v"]["nulls"]) == (None, 0)
    assert (got["b"]["dtype"], got["b"]["distinct"], got["b"]["nulls"]) == ("bool", 1, 1)
    assert rm.numeric_columns(df) == [] and rm.categorical_columns(df) == ["t"]


def test_long_text_is_compared_whole(frame):
    head = "x" * 20_000
    df = frame([(head + "a",), (head + "b",), (head + "a",)], "t string")
    assert rm.distinct_count(df, "t") == 2
    assert rm.distinct_count(df, "t", exact=False) == 2


def test_null_competes_for_the_mode(frame):
    df = frame([(None,), (None,), ("a",), ("b",)], "c string")
    r = rm.categorical_stats(df).first()
    assert (r["distinct"], r["rows"], r["mode"], r["mode_count"], r["mode_share"]) == (
        2, 4, "nan", 2, 0.5,
    )
    tie = rm.categorical_stats(frame([(None,), ("b",), ("a",)], "c string")).first()
    assert tie["mode"] == "a"


def test_outlier_reports(frame):
    values = [float(v) for v in range(1, 20)] + [1000.0]
    df = frame([(v, None) for v in values], "x double, empty double")
    r = rm.outlier_report(df).collect()
    assert [(o["column"], o["outliers"], o["pct"], o["severity"]) for o in r] == [
        ("x", 1, 5.0, "high")
    ]
    z = rm.outlier_report(df, "zscore", k=3.0).first()
    assert (z["outliers"], z["method"]) == (1, "Z-score 3")
    s = rm.outlier_summary(df).first()
    assert (s["q1"], s["q3"], s["lower"], s["upper"]) == (5.75, 15.25, -8.5, 29.5)
    constant = frame([(1.0,), (1.0,)], "x double")
    assert rm.outlier_report(constant, "zscore").first()["severity"] == "none"


def test_encoding_status_follows_appearance(frame):
    df = frame([(3, "c"), (1, "b"), (2, None), (4, "b")], "_row_id long, c string")
    r = rm.encoding_status(df).first()
    assert (r["distinct"], r["values"]) == (2, "b, nan, c")


def test_status_and_summary(frame):
    df = frame([(1, None, "a"), (2, 2.0, None)], "_row_id long, x double, c string")
    r = rm.table_status(df, 4).first()
    assert tuple(r) == (2, 2, 2, 1, 4)
    r = rm.run_summary(df, df.filter("x is not null").drop("c"), 2).first()
    assert tuple(r) == (2, 1, 2, 1, 0, 2)


def test_default_picks(table):
    picks = rm.default_picks(table("lineitem"))
    assert len(picks["numeric"]) == 3 and len(picks["box"]) == 6
    assert picks["categorical"] == ["l_returnflag", "l_linestatus"]


def test_odd_column_names(frame):
    df = frame([(1.0, "u"), (2.0, "v")], "`a.b c` double, `q``t` string")
    assert rm.numeric_stats(df).first()["column"] == "a.b c"
    assert {r["column"] for r in rm.column_report(df).collect()} == {"a.b c", "q`t"}
    scaled = rm.Scale("a.b c", "minmax").run(df)
    assert scaled.columns == ["_a.b c", "q`t", "a.b c_scaled"]

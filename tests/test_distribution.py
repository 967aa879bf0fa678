import math

import numpy as np
import pytest

import rowmill as rm
from rowmill.operators.distribution import default_bins


def bars(df):
    return [tuple(r) for r in df.orderBy("column", "bin").collect()]


def test_number_of_bins():
    assert [default_bins(n) for n in (1, 99, 121, 399, 10_000)] == [10, 10, 11, 19, 30]


def test_histogram_equals_numpy(spark, messy):
    df = spark.createDataFrame(messy)
    got = rm.histogram(df, ["a", "b"], bins=13)
    for c in ("a", "b"):
        counts, edges = np.histogram(messy[c].dropna(), 13)
        rows = got.filter(f"column = '{c}'").orderBy("bin").collect()
        assert [r["n"] for r in rows] == list(counts)
        np.testing.assert_allclose([r["low"] for r in rows] + [rows[-1]["high"]], edges)
    assert got.groupBy().sum("n").first()[0] == messy[["a", "b"]].count().sum()


def test_density_has_area_one(spark, messy):
    df = rm.histogram(spark.createDataFrame(messy), ["a", "b"], density=True)
    for c in ("a", "b"):
        rows = df.filter(f"column = '{c}'").collect()
        assert sum(r["density"] * (r["high"] - r["low"]) for r in rows) == pytest.approx(1)


def test_constant_column_has_one_bin(frame):
    df = frame([(3.0,), (3.0,), (None,)], "x double")
    assert bars(rm.histogram(df, "x")) == [("x", 0, 3.0, 3.0, 2)]
    assert rm.kde(df, "x").count() == 0
    with pytest.raises(ValueError, match="infinite"):
        rm.histogram(frame([(1.0,), (float("inf"),)], "x double"), "x")


def test_empty_bins_stay(frame):
    got = bars(rm.histogram(frame([(0.0,), (10.0,)], "x double"), "x", bins=5))
    assert [r[4] for r in got] == [1, 0, 0, 0, 1]


def test_kde_equals_formula(spark, messy):
    curve = rm.kde(spark.createDataFrame(messy).repartition(5), "b").orderBy("point").collect()
    x = messy["b"].dropna().to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    u = (grid[:, None] - x) / h
    expected = np.exp(-u * u / 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    np.testing.assert_allclose([r["x"] for r in curve], grid, atol=1e-12)
    np.testing.assert_allclose([r["density"] for r in curve], expected, rtol=1e-12)


def test_box(frame):
    df = frame([(float(v),) for v in range(1, 20)] + [(1000.0,), (None,)], "x double")
    r = rm.box_stats(df).first()
    assert (r["n"], r["q1"], r["median"], r["q3"]) == (20, 5.75, 10.5, 15.25)
    assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (1.0, 19.0, 1)
    assert [r["value"] for r in rm.box_outliers(df, "x").collect()] == [1000.0]


def test_figure_choice(frame):
    df = frame([(1.0,), (2.0,)], "x double")
    assert rm.distribution(df, "x").keys() == {"histogram"}
    assert rm.distribution(df, "x", "hist_density").keys() == {"histogram", "kde"}
    assert rm.distribution(df, "x", "box").keys() == {"box", "outliers"}
    with pytest.raises(ValueError):
        rm.distribution(df, "x", "pie")


def test_category_shares(frame):
    rows = [("a", str(i), "one", None) for i in range(15)] + [("b", "15", "one", None)]
    df = frame(rows, "two string, many string, single string, d date")
    got = [tuple(r) for r in rm.category_shares(df, ["two", "many", "single", "d"], 15).collect()]
    assert sorted(got, key=str) == sorted(
        [
            ("two", "a", 15, 15 / 16, 2, None),
            ("two", "b", 1, 1 / 16, 2, None),
            ("many", None, None, None, 16, "too many values"),
            ("single", None, None, None, 1, "fewer than 2 values"),
            ("d", None, None, None, None, "datetime"),
        ],
        key=str,
    )
    fifteen = rm.category_shares(df.filter("two = 'a'"), ["many"], 15)
    assert fifteen.count() == 15
    assert rm.category_shares(df, ["many"]).count() == 16


def test_scatter(frame):
    rows = [(0.0, 0.0, "u"), (10.0, 10.0, "v"), (10.0, 10.0, "u"), (None, 1.0, "u"),
            (1.0, 1.0, None)]
    df = frame(rows, "x double, y double, g string")
    s = rm.scatter(df, "x", "y", "g", bins=2)
    assert s.points.count() == 3 and s.reason is None
    cells = {(r["bin_x"], r["bin_y"], r["colour"]): r["n"] for r in s.cells.collect()}
    assert cells == {(0, 0, "u"): 1, (1, 1, "v"): 1, (1, 1, "u"): 1}
    assert [r["n"] for r in s.marginal_x.orderBy("bin").collect()] == [1, 2]
    assert rm.scatter(df, "x", "y").points.count() == 4
    empty = rm.scatter(df.filter("x is null"), "x", "y")
    assert empty.reason == "no complete rows" and empty.cells.count() == 0


def test_points_of_a_cell_are_bounded(spark):
    df = spark.range(3000).selectExpr("id", "cast(id % 2 AS double) AS x", "cast(id % 3 AS double) AS y")
    s = rm.scatter(df.repartition(5), "x", "y", bins=4, per_cell=7, key="id")
    assert s.points.groupBy("x", "y").count().collect() and s.points.count() == 6 * 7
    assert s.cells.agg({"n": "sum"}).first()[0] == 3000
    assert rm.scatter(df, "x", "y", per_cell=None).points.count() == 3000


def test_layout_does_not_matter(spark, table):
    df = table("events").selectExpr("event_id", "value", "event_type")
    results = []
    for parts in (1, 7):
        again = df.repartition(parts)
        results.append(
            [
                rm.numeric_stats(again, ["value"], digits=6).collect(),
                bars(rm.histogram(again, "value")),
                rm.normality(again, ["value"], "event_id", sample_size=300).collect(),
                sorted(rm.category_shares(again, ["event_type"]).collect()),
            ]
        )
    assert results[0] == results[1]


def test_kde_between_far_values(frame):
    """Points far from every value have no density; beside a value the curve is that of its kernels."""
    df = frame([(0.0,), (0.0,), (0.1,), (1e9,)] * 50, "x double")
    curve = rm.kde(df, "x", points=50).orderBy("point").collect()
    x = np.array([0.0, 0.0, 0.1, 1e9] * 50)
    h = x.std(ddof=1) * len(x) ** -0.2
    u = (np.linspace(0, 1e9, 50)[:, None] - x) / h
    expected = np.exp(-u * u / 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    np.testing.assert_allclose([r["density"] for r in curve], expected, rtol=1e-9, atol=1e-17 * expected.max())


def test_kde_error_bound(spark):
    """Heavy tails, so that grid points in gaps, cells at the edge of reach and dense cells all occur."""
    x = np.random.default_rng(5).standard_t(1.5, 3000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = np.array([r["density"] for r in rm.kde(df, "x").orderBy("point").collect()])
    h = x.std(ddof=1) * len(x) ** -0.2
    u = (np.linspace(x.min(), x.max(), 200)[:, None] - x) / h
    peak = 1 / (h * math.sqrt(2 * math.pi))
    expected = np.exp(-u * u / 2).sum(axis=1) / len(x) * peak
    assert np.abs(got - expected).max() < 1e-14 * peak

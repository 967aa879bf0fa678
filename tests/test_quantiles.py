import pytest
from pyspark.sql import functions as F

import rowmill as rm
from rowmill.operators import quantiles as module

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_interpolation(ties):
    found = rm.quantiles(ties, ["s"], [0.01, 0.25, 0.5, 0.75, 0.99])["s"]
    assert found == pytest.approx([1.07, 2.0, 3.75, 7.0, 9.79])


def test_many_columns_equal_pandas(spark, messy):
    df = spark.createDataFrame(messy).repartition(5)
    found = rm.quantiles(df, list(messy), PROBS)
    expected = messy.quantile(PROBS)
    for c in messy:
        assert found[c] == pytest.approx(list(expected[c]), abs=1e-12)


def test_large_column_is_bracketed(spark):
    """Most values fall on gaps, and the order statistics are those of the whole column."""
    n = 200_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"))
    known = module.outlines(df, ["x"])
    ranges = module._brackets(known["x"], PROBS, module.HALF_WIDTHS[0])
    assert len(ranges) > 3 and sum(high - low for low, high in ranges) < 0.1 * n
    expected = [p * (n - 1) for p in PROBS]
    assert rm.quantiles(df, ["x"], PROBS)["x"] == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("misses", [1, 2])
def test_brackets_that_miss_are_widened(spark, messy, monkeypatch, misses):
    """Also both times, so that the whole range is the last resort."""
    real, seen = module._brackets, []

    def misled(outline, probs, width, dropped=0):
        seen.append(width)
        found = real(outline, probs, width, dropped)
        wrong = width in module.HALF_WIDTHS[:misses]
        return [(low + 1e6, high + 1e6) for low, high in found] if wrong else found

    monkeypatch.setattr(module, "_brackets", misled)
    found = rm.quantiles(spark.createDataFrame(messy), ["b", "c"], PROBS)
    assert set(seen) == set(module.HALF_WIDTHS)
    for c in ("b", "c"):
        assert found[c] == pytest.approx(list(messy[c].quantile(PROBS)), abs=1e-12)


def test_outline_of_a_larger_table_serves_what_is_left(spark, messy):
    """Rows are gone at one end, at the other, or at random; all results stay exact."""
    df = spark.createDataFrame(messy)
    known = module.outlines(df, ["b"])
    for condition in ("b > -0.5", "b < 0.5", "a % 3 = 0", "b > 1e9"):
        left = df.filter(condition)
        kept = left.toPandas()["b"].dropna()
        got = rm.quantiles(left, ["b"], [0.25, 0.75], known=known, dropped=len(messy) - len(kept))["b"]
        assert got == ([None, None] if kept.empty else pytest.approx(list(kept.quantile([0.25, 0.75]))))


def test_drops_in_turn_scan_once_per_column(spark, messy, monkeypatch):
    df = spark.createDataFrame(messy[["a", "b", "c"]])
    calls = []
    real = module._counted
    monkeypatch.setattr(module, "_counted", lambda *args: calls.append(1) or real(*args))
    monkeypatch.setattr(module, "outlines", lambda *args: pytest.fail("a second outline"))
    got = rm.TreatOutliers(method="iqr_drop").run(df).toPandas()
    left = messy[["a", "b", "c"]]
    for c in left:
        q1, q3 = left[c].quantile([0.25, 0.75])
        left = left[left[c].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, left.values))
    assert len(calls) == 3


def test_infinite_values_have_ranks(frame):
    df = frame([(float("inf"),), (1.0,), (float("-inf"),), (float("nan"),), (2.0,)], "x double")
    assert rm.quantiles(df, ["x"], [0.0, 1 / 3, 1.0])["x"] == pytest.approx([float("-inf"), 1.0, float("inf")])


def test_column_without_values(frame):
    df = frame([(None, 1.0), (None, 3.0)], "x double, y double")
    assert rm.quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [2.0]}


def test_sketch_mode_is_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    assert rm.quantiles(df, ["x"], [0.5], exact=False)["x"][0] == pytest.approx(5000, abs=10)


def test_text_column_is_refused(frame):
    with pytest.raises(ValueError, match="not numeric"):
        rm.quantiles(frame([("a",)], "t string"), ["t"], [0.5])

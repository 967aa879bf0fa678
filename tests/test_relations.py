import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import rowmill as rm
from rowmill.functions.columns import nan_to_null
from rowmill.operators import ranks as ranks_module
from rowmill.operators.kendall import discordant_weights
from rowmill.operators.ranks import attach_by_value, placed_values


def wide(matrix, value, names):
    rows = matrix.toPandas().pivot(index="col_a", columns="col_b", values=value)
    return rows.loc[names, names]


def assert_same(got, expected):
    pd.testing.assert_frame_equal(got, expected, check_names=False, atol=1e-9, rtol=1e-9)


def tau_b(x, y):
    both = x.notna() & y.notna()
    x, y = x[both].to_numpy(), y[both].to_numpy()
    sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    scale = np.sqrt((sx**2).sum() * (sy**2).sum())
    return (sx * sy).sum() / scale if scale else np.nan


def test_known_values(pairs):
    r = wide(rm.correlation(pairs), "r", ["x", "y"])
    assert r.loc["x", "y"] == pytest.approx(0.804668, abs=1e-6)
    r = wide(rm.correlation(pairs, method="spearman"), "r", ["x", "y"])
    assert r.loc["x", "y"] == pytest.approx(0.333333, abs=1e-6)
    r = wide(rm.covariance(pairs), "covariance", ["x", "y"])
    assert r.loc["x", "y"] == pytest.approx(1.916667, abs=1e-6)


def test_pearson_and_covariance_equal_pandas(spark, messy):
    df = spark.createDataFrame(messy)
    assert_same(wide(rm.correlation(df), "r", list(messy)), messy.corr())
    assert_same(wide(rm.covariance(df), "covariance", list(messy)), messy.cov())


def test_spearman_equals_pandas(spark, messy):
    df = spark.createDataFrame(messy).repartition(3)
    got = wide(rm.correlation(df, method="spearman"), "r", list(messy))
    assert_same(got, messy.corr("spearman"))


def test_kendall_equals_brute_force(spark, messy):
    names = ["a", "b", "c", "k"]
    df = spark.createDataFrame(messy[names])
    got = wide(rm.correlation(df, method="kendall"), "r", names)
    expected = pd.DataFrame(
        {i: {j: tau_b(messy[i], messy[j]) for j in names} for i in names}
    )
    assert_same(got, expected)


def test_discordant_weights_equal_brute_force(frame):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for pair, (size, spread) in enumerate([(1, 1), (2, 3), (17, 3), (60, 3), (60, 100), (90, 5)]):
        x, y = rng.integers(0, spread, size), rng.integers(0, spread, size)
        w = rng.integers(1, 5, size)
        less = x[:, None] < x[None, :]
        more = y[:, None] > y[None, :]
        expected[pair] = float((np.outer(w, w) * (less & more)).sum())
        rows += [(pair, int(a), int(b), int(n)) for a, b, n in zip(x, y, w)]
    table = frame(rows, "pair int, x bigint, y bigint, n bigint")
    assert discordant_weights(table, 7) == expected


def test_constant_columns_have_no_correlation(frame):
    df = frame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "x double, y double")
    for method in ("pearson", "spearman", "kendall"):
        r = wide(rm.correlation(df, method=method), "r", ["x", "y"])
        assert np.isnan(r.loc["x", "y"]) and np.isnan(r.loc["x", "x"]) and r.loc["y", "y"] == 1.0


def test_average_ranks_equal_pandas(spark, messy):
    messy = messy.copy()
    messy.loc[:2, ["b", "c"]] = None
    df = spark.createDataFrame(messy.reset_index())
    ranks = rm.average_ranks(df.repartition(6), ["b", "c"]).toPandas()
    expected = messy[["b", "c"]].rank()
    order = ["b", "c"]
    assert_same(
        ranks.sort_values(order).reset_index(drop=True),
        expected.sort_values(order).reset_index(drop=True),
    )


def test_places_of_hot_and_rare_values_lie_in_slices(spark, monkeypatch):
    monkeypatch.setattr(ranks_module, "SLICE", 200, raising=False)
    monkeypatch.setattr(ranks_module, "HOT_SHARE", 20)
    rng = np.random.default_rng(5)
    n = 3000
    hot = np.where(rng.random(n) < 0.9, 1.0, rng.integers(-3, 60, n))
    frame = pd.DataFrame({"hot": hot, "rare": rng.normal(size=n).round(2), "key": np.arange(float(n))})
    frame.loc[::5, "rare"] = 0.0
    frame.loc[::10, ["hot", "rare"]] = -0.0
    frame.loc[::13, "hot"] = None
    names = list(frame)
    placed = placed_values(nan_to_null(spark.createDataFrame(frame)).repartition(3), names, [0])
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 200
    got = placed.toPandas().sort_values("__r2").reset_index(drop=True)
    expected, known = frame.rank(), frame[frame["hot"].notna()].rank()
    for i, c in enumerate(names):
        for own, wanted in ((f"__r{i}", expected[c]), (f"__d{i}", frame[c].rank(method="dense") - 1)):
            np.testing.assert_array_equal(got[own].astype(float), wanted)
        np.testing.assert_array_equal(got.loc[known.index, f"__r{i}_0"].astype(float), known[c])


def test_look_up_spreads_rows_of_hot_and_of_rare_values(spark, monkeypatch):
    monkeypatch.setattr(ranks_module, "HOT_SHARE", 20)
    n = 4000
    long = spark.range(0, n, 1, 4).selectExpr(
        "id AS __row", "0 AS item",
        "CASE WHEN id % 4 > 0 THEN 0.0D WHEN id % 8 = 0 THEN -1.0D * (id % 80) ELSE id END AS value",
    )
    places = long.groupBy("item", (F.col("value") + 0.0).alias("value")).agg(F.count("*").alias("n"))
    places = places.withColumn("__d", F.col("value") * 2)
    found = ranks_module._looked_up(long, places, ["__d"], n, 20)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    # The hot ones lie as they did, in four parts; the others in 20.
    assert sum(sizes) == n and max(sizes) <= 3100 / 4 + 50 and len(sizes) > 15
    expected = {r["__row"]: r["value"] * 2 for r in long.collect()}
    assert {r["__row"]: r["__d"] for r in found.collect()} == expected


def test_rows_are_written_in_small_files(spark, monkeypatch):
    monkeypatch.setattr(ranks_module, "SLICE", 500)
    written = []
    write = ranks_module.materialise
    monkeypatch.setattr(ranks_module, "materialise", lambda *a: written.append(write(*a)) or written[-1])
    df = spark.range(0, 1000, 1, 1).selectExpr("id % 7 * 1.0D AS a", "id * 1.0D AS b")
    assert rm.average_ranks(df, ["a", "b"]).count() == 1000
    sizes = written[0].groupBy(F.input_file_name()).count().collect()
    assert {r["count"] for r in sizes} == {250}


def test_attach_keeps_rows_with_hot_and_missing_keys(spark):
    keys = ["hot"] * 700 + [None] * 200 + [f"k{i}" for i in range(100)] + ["absent"]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    counts = [("hot", 700_000, 7)] + [(f"k{i}", 1, i) for i in range(100)]
    lookup = spark.createDataFrame(counts, "value string, n long, code int")
    got = attach_by_value(rows.repartition(5), lookup, "k", "value", "n", ["code"], 700_100)
    codes = dict((v, c) for v, _, c in counts)
    assert {(r["i"], r["code"]) for r in got.collect()} == {
        (i, codes.get(k)) for i, k in enumerate(keys)
    }


def test_mean_abs_correlation(spark, messy, frame):
    names = ["a", "b", "c"]
    got = rm.mean_abs_correlation(spark.createDataFrame(messy), names, digits=9).first()[0]
    assert got == pytest.approx(messy[names].corr().abs().mean().mean(), abs=1e-9)
    assert rm.mean_abs_correlation(frame([(1.0,)], "x double")).first()[0] == 0.0


def test_column_limits(frame):
    df = frame([tuple(float(i) for i in range(11))], ", ".join(f"c{i} double" for i in range(11)))
    with pytest.raises(ValueError, match="at most 10"):
        rm.correlation(df)
    with pytest.raises(ValueError, match="at least two"):
        rm.covariance(df, ["c1"])
    assert rm.covariance(df, max_columns=None).count() == 121
    with pytest.raises(ValueError, match="unknown correlation"):
        rm.correlation(df, ["c1", "c2"], "other")

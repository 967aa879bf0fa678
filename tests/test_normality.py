import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

import rowmill as rm
from rowmill.functions.scalars import inverse_normal
from rowmill.operators import normality
from rowmill.operators.normality import LAST_WEIGHT, NEXT_WEIGHT, p_value

PUBLISHED = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]


def test_published_example(frame):
    df = frame([(i, float(v)) for i, v in enumerate(PUBLISHED)], "id int, x double")
    r = rm.normality(df, ["x"], "id").first()
    assert (r["n"], r["w"], r["p"], r["closeness"], r["normal"]) == (
        11, 0.7888, 0.0067, "not normal", "no",
    )


def weights(n):
    """By definition, value by value."""
    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    u, a = 1 / math.sqrt(n), np.empty(n)
    last = m[-1] / math.sqrt(m @ m) + np.polyval(LAST_WEIGHT[::-1], u)
    if n > 5:
        second = m[-2] / math.sqrt(m @ m) + np.polyval(NEXT_WEIGHT[::-1], u)
        a[:] = m / math.sqrt((m @ m - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2))
        a[-2], a[1] = second, -second
    else:
        a[:] = m / math.sqrt((m @ m - 2 * m[-1] ** 2) / (1 - 2 * last**2))
    a[-1], a[0] = last, -last
    return a


def shapiro_wilk(values):
    x = np.sort(values.astype(float))
    w = float(weights(len(x)) @ x) ** 2 / float((x - x.mean()) @ (x - x.mean()))
    return min(w, 1.0), p_value(min(w, 1.0), len(x))


@pytest.mark.parametrize("n", [3, 4, 5, 6, 7, 12, 200, 6000])
def test_sums_equal_the_definition(spark, monkeypatch, n):
    monkeypatch.setattr(normality, "PART", 50)
    rng = np.random.default_rng(n)
    columns = {"bell": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float), "far": 1e6 + rng.random(n)}
    columns["ties"][:3] = 0, 1, 2
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(zip(*columns.values()))], "id int, bell double, ties double, far double")
    got = {r["column"]: r for r in rm.normality(df.repartition(5), list(columns), "id", digits=None).collect()}
    for c, x in columns.items():
        w, p = shapiro_wilk(x)
        assert got[c]["n"] == n and got[c]["w"] == pytest.approx(w, abs=1e-8) and got[c]["p"] == pytest.approx(p, abs=1e-6)


def test_inverse_normal(frame):
    ps = [1e-15, 1e-9, 1e-5, 0.02, 0.074, 0.076, 0.3, 0.5, 0.7, 0.93, 0.99999]
    got = frame([(p,) for p in ps], "p double").select(inverse_normal(F.col("p")).alias("z")).collect()
    assert [r.z for r in got] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=1e-12, abs=1e-14)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 11, 12, 50, 5000])
def test_weights_are_antisymmetric_and_normed(n):
    a = weights(n)
    np.testing.assert_allclose(a, -a[::-1], atol=1e-12)
    assert a @ a == pytest.approx(1, abs=1e-9)


def test_three_values():
    w, p = shapiro_wilk(np.array([1.0, 2.0, 3.0]))
    assert w == pytest.approx(1.0) and p == pytest.approx(1.0)
    assert p_value(0.75, 3) == pytest.approx(0.0)


def test_short_and_constant_columns_are_left_out(frame):
    df = frame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, None, 5.0)], "id int, short double, same double")
    assert rm.normality(df, ["short", "same"], "id").count() == 0


def test_shapes_are_told_apart(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b)) for i, (a, b) in
            enumerate(zip(rng.normal(size=2000), rng.exponential(size=2000)))]
    df = spark.createDataFrame(rows, "id int, bell double, skewed double")
    got = {r["column"]: r for r in rm.normality(df, key="id", columns=["bell", "skewed"]).collect()}
    assert got["bell"]["normal"] == "yes" and got["bell"]["closeness"] == "very close"
    assert got["skewed"]["normal"] == "no"


def test_sample_is_bounded_seeded_and_complete(spark):
    df = spark.range(40_000).select(
        "id", F.sin("id").alias("x"), F.when(F.col("id") % 4000 == 0, F.col("id")).alias("few")
    )
    one = rm.normality(df.repartition(9), ["x", "few"], "id", digits=None, sample_size=5000).collect()
    two = rm.normality(df.coalesce(1), ["x", "few"], "id", digits=None, sample_size=5000).collect()
    assert {r["column"]: r["n"] for r in one} == {"x": 5000, "few": 10}
    for a, b in zip(sorted(one), sorted(two)):
        assert a.w == pytest.approx(b.w, rel=1e-9) and a.p == pytest.approx(b.p, rel=1e-6)


def test_sample_with_one_key_for_all_rows(spark):
    df = spark.range(9000).selectExpr("0 AS k", "cast(id AS double) AS x")
    got = rm.normality(df.repartition(4), ["x"], "k", digits=None, sample_size=100).first()
    assert (got.n, got.w) == (100, pytest.approx(shapiro_wilk(np.arange(100))[0]))

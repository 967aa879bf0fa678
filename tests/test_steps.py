import datetime

import numpy as np
import pandas as pd
import pytest

import rowmill as rm


def column(df, name, by="id"):
    return [r[name] for r in df.orderBy(by).collect()]


@pytest.fixture
def gaps(frame):
    rows = [(1, 1.0, 5, "b"), (2, None, 5, None), (3, 4.0, None, "a"), (4, 4.0, 8, "b"),
            (5, 1.0, None, None)]
    return frame(rows, "id int, x double, w int, c string")


# Imputation


@pytest.mark.parametrize(
    "strategy,value", [("mean", 2.5), ("median", 2.5), ("mode", 1.0), ("constant", -1.0)]
)
def test_fill_numeric(gaps, strategy, value):
    out = rm.Impute("x", numeric=strategy, number=-1).run(gaps)
    assert column(out, "x") == [1.0, value, 4.0, 4.0, 1.0]
    assert column(out, "c") == ["b", None, "a", "b", None]


def test_fill_integer_column(gaps):
    mean = rm.Impute("w", numeric="mean").run(gaps)
    assert dict(mean.dtypes)["w"] == "double" and column(mean, "w") == [5, 5, 6, 8, 6]
    mode = rm.Impute("w", numeric="mode").run(gaps)
    assert dict(mode.dtypes)["w"] == "int" and column(mode, "w") == [5, 5, 5, 8, 5]
    half = rm.Impute("w", numeric="constant", number=0.5).run(gaps)
    assert dict(half.dtypes)["w"] == "double"


def test_fill_text(gaps):
    assert column(rm.Impute("c").run(gaps), "c") == ["b", "b", "a", "b", "b"]
    unknown = rm.Impute("c", other="constant", text="").run(gaps)
    assert column(unknown, "c") == ["b", "unknown", "a", "b", "unknown"]


def test_drop_rows_and_columns(gaps):
    assert column(rm.Impute("c", other="drop_rows").run(gaps), "id") == [1, 3, 4]
    assert rm.Impute("c", other="drop_col").run(gaps).columns == ["id", "x", "w"]


def test_all_columns_see_rows_dropped_before(gaps):
    out = rm.Impute(numeric="drop_rows", other="mode").run(gaps)
    assert column(out, "id") == [1, 4] and column(out, "c") == ["b", "b"]
    filled = rm.Impute().run(gaps)
    assert rm.columns_with_nulls(filled) == []


def test_columns_without_gaps_are_skipped(gaps):
    assert rm.Impute("id", numeric="drop_col").fit(gaps) == []


def test_column_without_values_stays_empty(frame):
    df = frame([(None, None), (None, None)], "x double, c string")
    for strategy in ("mean", "median", "mode"):
        step = rm.Impute(numeric=strategy)
        assert step.run(df).filter("x is null and c is null").count() == 2
        assert "nothing filled" in step.fit(df)[0].detail


def test_other_types_take_mode_or_typed_constant(frame):
    day = datetime.datetime(2024, 5, 1, 12, 30)
    df = frame([(1, day, True), (2, None, None)], "id int, t timestamp_ntz, b boolean")
    assert column(rm.Impute(other="mode").run(df), "t") == [day, day]
    fixed = rm.Impute("t", other="constant", moment="2020-01-01").run(df)
    assert column(fixed, "t")[1] == datetime.datetime(2020, 1, 1)
    with pytest.raises(ValueError, match="not a"):
        rm.Impute("t", other="constant", moment="soon").run(df)
    with pytest.raises(ValueError, match="is needed"):
        rm.Impute("t", other="constant").run(df)


def test_impute_validation():
    with pytest.raises(ValueError):
        rm.Impute(numeric="other")
    with pytest.raises(ValueError):
        rm.Impute(other="mean")
    with pytest.raises(ValueError):
        rm.Impute(number="many")


# Outliers


def pandas_treatment(s, method, k):
    q = s.quantile
    iqr = q(0.75) - q(0.25)
    low, high = q(0.25) - 1.5 * iqr, q(0.75) + 1.5 * iqr
    if method == "iqr_clip":
        return s.clip(low, high)
    if method == "iqr_drop":
        return s[(s >= low) & (s <= high)]
    if method == "zscore_clip":
        return s.clip(s.mean() - k * s.std(), s.mean() + k * s.std())
    if method == "zscore_drop":
        return s[(s - s.mean()).abs() <= k * s.std()]
    return s.clip(q(0.01), q(0.99))


@pytest.mark.parametrize(
    "method", ["iqr_clip", "iqr_drop", "zscore_clip", "zscore_drop", "cap_pct"]
)
def test_treatments_equal_pandas(spark, method):
    rng = np.random.default_rng(5)
    s = pd.Series(rng.standard_t(2, 500))
    s[::9] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"id": range(500), "x": s}))
    got = rm.TreatOutliers("x", method, k=2.0).run(df).orderBy("id").toPandas()
    expected = pandas_treatment(s, method, 2.0)
    assert list(got["id"]) == list(expected.index)
    np.testing.assert_allclose(got["x"].to_numpy(float), expected.to_numpy(), atol=1e-12)


def test_sequential_drop_refits_and_joint_does_not(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_t(2, 800)
    frame = pd.DataFrame({"id": range(800), "x": x, "y": np.exp(x / 3)})
    df = spark.createDataFrame(frame)
    seq = rm.TreatOutliers(method="iqr_drop", columns=["x", "y"]).run(df)
    joint = rm.TreatOutliers(method="iqr_drop", columns=["x", "y"], order="joint").run(df)
    first = frame[frame.index.isin(pandas_treatment(frame["x"], "iqr_drop", 3).index)]
    expected = pandas_treatment(first["y"], "iqr_drop", 3).index
    assert column(seq, "id") == list(expected)
    both = set(pandas_treatment(frame["x"], "iqr_drop", 3).index)
    both &= set(pandas_treatment(frame["y"], "iqr_drop", 3).index)
    assert set(column(joint, "id")) == both
    assert set(column(seq, "id")) != both


def test_clip_again_with_the_same_bounds_changes_nothing(spark, messy):
    df = spark.createDataFrame(messy.reset_index())
    step = rm.TreatOutliers("b", "cap_pct")
    actions = step.fit(df)
    once = rm.apply_actions(df, actions)
    twice = rm.apply_actions(once, actions)
    assert column(once, "b", "index") == column(twice, "b", "index")


def test_too_few_values(frame):
    df = frame([(1, 5.0), (2, None)], "id int, x double")
    assert column(rm.TreatOutliers("x", "zscore_clip").run(df), "x") == [5.0, None]
    with pytest.raises(rm.StepRefused, match="too few values"):
        rm.TreatOutliers("x", "zscore_drop").run(df)


# Encoding


@pytest.fixture
def labels(frame):
    rows = [(1, "b"), (2, None), (3, "a"), (4, "b"), (5, "ñ"), (6, "B")]
    return frame(rows, "id int, c string")


def test_label_codes_follow_text_order(labels):
    assert column(rm.LabelEncode().run(labels), "c") == [2, None, 1, 2, 3, 0]
    assert column(rm.LabelEncode("c", null_label="nan").run(labels), "c") == [2, 3, 1, 2, 4, 0]


def test_label_with_many_values(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i:04d}" for i in rng.integers(0, 300, 2000)]
    words[:900] = ["hot"] * 900
    words[5] = None
    df = spark.createDataFrame(list(enumerate(words)), "id int, c string").repartition(6)
    got = column(rm.LabelEncode("c").run(df), "c")
    order = {w: i for i, w in enumerate(sorted({w for w in words if w}))}
    assert got == [order.get(w) for w in words]


def test_onehot_names_that_differ_by_case(labels):
    out = rm.OneHotEncode("c").run(labels)
    assert len({n.lower() for n in out.columns}) == len(out.columns)
    assert [r["c_b.1_encoded"] for r in out.orderBy("id").collect()] == [1, 0, 0, 1, 0, 0]
    assert [r["c_B_encoded"] for r in out.orderBy("id").collect()] == [0, 0, 0, 0, 0, 1]


def test_onehot(labels):
    out = rm.OneHotEncode("c").run(labels)
    assert out.columns == [
        "id", "c", "c_B_encoded", "c_a_encoded", "c_b.1_encoded", "c_ñ_encoded",
    ]
    sums = [sum(r[2:]) for r in out.orderBy("id").collect()]
    assert sums == [1, 0, 1, 1, 1, 1]
    with pytest.raises(rm.StepRefused, match="more than 2"):
        rm.OneHotEncode("c", max_levels=2).run(labels)


@pytest.mark.parametrize("padding", [0, 40])
def test_ordinal(labels, padding):
    codes = {"a": 10, "b": 20, **{f"p{i}": i for i in range(padding)}}
    out = rm.OrdinalEncode(codes, "c").run(labels)
    assert out.columns == ["id", "c", "c_encoded"]
    assert column(out, "c_encoded") == [20, None, 10, 20, None, None]


def test_binary(frame):
    df = frame([(3, "a", "p"), (1, None, "q"), (2, "b", "r")], "_row_id long, c string, d string")
    step = rm.BinaryEncode()
    assert column(step.run(df), "c", "_row_id") == [None, 0, 1]
    assert column(rm.BinaryEncode("c", by="value").run(df), "c", "_row_id") == [None, 1, 0]
    assert "skipped" in step.fit(df)[1].detail
    assert column(step.run(df), "d", "_row_id") == ["q", "r", "p"]


# Scaling


def test_scalers_equal_formulas(spark, messy):
    df = spark.createDataFrame(messy.reset_index())
    b = messy["b"]
    iqr = b.quantile(0.75) - b.quantile(0.25)
    expected = {
        "standard": (b - b.mean()) / b.std(ddof=0),
        "minmax": (b - b.min()) / (b.max() - b.min()),
        "robust": (b - b.median()) / iqr,
        "log": np.log1p(b.clip(lower=0)),
        "sqrt": np.sqrt(b.clip(lower=0)),
    }
    for method, values in expected.items():
        out = rm.Scale("b", method).run(df).orderBy("index").toPandas()
        np.testing.assert_allclose(out["b_scaled"].to_numpy(float), values, atol=1e-12)


def test_constant_scales_to_zero(frame):
    df = frame([(1, 7.0), (2, 7.0), (3, None)], "id int, x double")
    for method in ("standard", "minmax", "robust"):
        assert column(rm.Scale("x", method).run(df), "x_scaled") == [0.0, 0.0, None]


def test_source_is_hidden_and_used_again(frame):
    df = frame([(1.0, 2.0, "t"), (4.0, 8.0, "u")], "x double, _y double, c string")
    once = rm.Scale("x", "minmax").run(df)
    assert once.columns == ["_x", "_y", "c", "x_scaled"]
    again = rm.Scale("x", "sqrt").run(once)
    assert again.columns == once.columns
    assert [r["x_scaled"] for r in again.orderBy("_x").collect()] == [1.0, 2.0]
    every = rm.Scale(method="minmax").run(once)
    assert every.columns == ["_x", "__y", "c", "x_scaled", "_y_scaled"]
    for name in ("_x", "x_scaled"):
        with pytest.raises(rm.StepRefused):
            rm.Scale(name).run(once)
    assert rm.raw_stats(once).count() == 2 and rm.scaled_stats(once).first()["max"] == 1.0


def test_infinite_values_stop_the_whole_batch(frame):
    df = frame([(1.0, float("inf")), (2.0, 3.0)], "x double, y double")
    for method in ("standard", "minmax", "robust"):
        with pytest.raises(rm.StepRefused, match="infinite"):
            rm.Scale(method=method).run(df)
    assert rm.Scale(method="log").run(df).columns == ["_x", "_y", "x_scaled", "y_scaled"]
    with pytest.raises(rm.StepRefused, match="no numeric"):
        rm.Scale().run(df.selectExpr("cast(x as string) as x"))


# Column selection


def test_selection(frame):
    df = frame([(1, 2, 3, 4)], "_row_id long, a int, _b int, c int")
    assert rm.KeepColumns(["c", "a"]).run(df).columns == ["c", "a", "_row_id"]
    assert rm.DropTemporary().run(df).columns == ["_row_id", "a", "c"]
    assert rm.DropTemporary().fit(df.drop("_b")) == []
    assert rm.DropColumns(["a", "zz"]).run(df).columns == ["_row_id", "_b", "c"]
    assert rm.suggested_columns(df) == ["a", "c"] and rm.hidden_columns(df) == ["_b"]
    with pytest.raises(rm.StepRefused):
        rm.KeepColumns([]).run(df)
    with pytest.raises(ValueError, match="no such column"):
        rm.KeepColumns(["q"]).run(df)


# Types


def values(df):
    return [r[0] for r in df.collect()]


def test_text_to_number(frame):
    df = frame([(" 1,5 ",), ("2.5",), ("nan",), ("",), (None,), ("-3e2",)], "x string")
    out = rm.Retype("x", "float64").run(df)
    assert values(out) == [1.5, 2.5, None, None, None, -300.0]
    with pytest.raises(rm.StepRefused, match="2 values"):
        rm.Retype("x", "float64", strict_tokens=True).run(df)


def test_refusal_names_at_most_three_values(frame):
    df = frame([(v,) for v in ("1", "x", "y", "z", "x", "w", "1d")], "x string")
    with pytest.raises(rm.StepRefused, match="6 values.*example 1d, w, x$"):
        rm.Retype("x", "float64").run(df)
    seen = frame([(i, v) for i, v in enumerate("zyxzw")], "_row_id int, x string")
    with pytest.raises(rm.StepRefused, match="example z, y, x$"):
        rm.Retype("x", "int64").run(seen)


def test_near_integers(frame):
    df = frame([(100000.5,)], "x double")
    with pytest.raises(rm.StepRefused, match="whole"):
        rm.Retype("x", "int64").run(df)
    assert values(rm.Retype("x", "int64", rtol=1e-5).run(df)) == [100000]
    halves = frame([(2.0,), (3.0000000001,), (None,)], "x double")
    assert values(rm.Retype("x", "int64").run(halves)) == [2, 3, None]
    with pytest.raises(rm.StepRefused):
        rm.Retype("x", "int64").run(frame([(1e30,)], "x double"))


def test_dates(frame):
    df = frame([("2024-01-01",), ("01/02/2024",), ("2024-03-05 06:07:08",), (None,)], "d string")
    assert values(rm.Retype("d", "datetime64[ns]", mixed=True).run(df)) == [
        datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2),
        datetime.datetime(2024, 3, 5, 6, 7, 8), None,
    ]
    # A column has one format.
    with pytest.raises(rm.StepRefused, match="2 values, not a date by yyyy-MM-dd"):
        rm.Retype("d", "datetime64[ns]").run(df)
    month_first = rm.Retype("d", "datetime64[ns]", formats=["MM/dd/yyyy"])
    with pytest.raises(rm.StepRefused, match="13/02/2024"):
        month_first.run(frame([("13/02/2024",)], "d string"))
    day_first = rm.Retype("d", "datetime64[ns]", formats=["dd/MM/yyyy"])
    assert values(day_first.run(frame([("13/02/2024",)], "d string"))) == [
        datetime.datetime(2024, 2, 13)
    ]


def test_the_format_of_all_values_is_found(frame):
    df = frame([("01/02/2024",), ("13/02/2024",), (None,), (" 03/04/2024 ",)], "d string")
    assert values(rm.Retype("d", "datetime64[ns]").run(df)) == [
        datetime.datetime(2024, 2, 1), datetime.datetime(2024, 2, 13), None, datetime.datetime(2024, 4, 3),
    ]
    with pytest.raises(rm.StepRefused, match="02/13/2024"):
        rm.Retype("d", "datetime64[ns]").run(frame([("13/02/2024",), ("14/02/2024",), ("02/13/2024",)], "d string"))
    either = frame([("01/02/2024",)], "d string")
    for day_first, month, detail in ((False, 1, "MM/dd/yyyy, dd/MM/yyyy would"), (True, 2, "dd/MM/yyyy, MM/dd/yyyy would")):
        step = rm.Retype("d", "datetime64[ns]", day_first=day_first)
        assert detail in step.fit(either)[0].detail
        assert values(step.run(either))[0].month == month
    assert values(rm.Retype("d", "datetime64[ns]").run(frame([(None,)], "d string"))) == [None]


def test_dates_do_not_depend_on_the_session_zone(spark, frame):
    df = frame([("2024-03-10 02:30:00",)], "d string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = values(rm.Retype("d", "datetime64[ns]").run(df))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out == [datetime.datetime(2024, 3, 10, 2, 30)]


def test_numbers_are_epoch_nanoseconds(frame):
    df = frame([(86_400_000_000_000,), (1_500,)], "n long")
    assert values(rm.Retype("n", "datetime64[ns]").run(df)) == [
        datetime.datetime(1970, 1, 2), datetime.datetime(1970, 1, 1, 0, 0, 0, 1),
    ]


def test_same_type_changes_nothing(frame):
    assert rm.Retype("x", "float64").fit(frame([(1.0,)], "x double")) == []
    assert values(rm.Retype("x", "object").run(frame([(12,)], "x int"))) == ["12"]
    with pytest.raises(ValueError, match="unsupported"):
        rm.Retype("x", "decimal")


def test_realign(frame):
    prior = frame([(1, "a"), (2, "b"), (3, None)], "_row_id int, x string")
    now = prior.filter("_row_id > 1").selectExpr("_row_id", "'z' as x")
    assert column(rm.realign(now, prior, "x", "_row_id"), "x", "_row_id") == ["b", None]


def test_whole_numbers_keep_all_their_digits(spark):
    texts = spark.sql("select * from values ('9007199254740993'), ('-7'), ('12,0'), (null) t(x)")
    got = [r.x for r in rm.Retype("x", "int64").run(texts).collect()]
    assert got == [9007199254740993, -7, 12, None]
    decimals = spark.sql("select cast('9007199254740993.00' as decimal(20, 2)) x")
    assert rm.Retype("x", "int64").run(decimals).first().x == 9007199254740993
    with pytest.raises(rm.StepRefused):
        rm.Retype("x", "int64").run(spark.sql("select cast('1.50' as decimal(20, 2)) x"))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-01 10:30", "2024-01-01 10:30:00"),
        ("2024-01-01T10:30:00Z", "2024-01-01 10:30:00"),
        ("2024-01-01T10:30:00+02:00", "2024-01-01 08:30:00"),
        ("20240105", "2024-01-05 00:00:00"),
        ("Jan 5 2024", "2024-01-05 00:00:00"),
        ("02/03/2024", "2024-02-03 00:00:00"),
    ],
)
def test_common_dates(spark, text, expected):
    df = rm.Retype("x", "datetime64[ns]").run(spark.createDataFrame([(text,)], "x string"))
    assert str(df.first().x) == expected


def test_day_first(spark):
    dates = spark.createDataFrame([("13/02/2024",)], "x string")
    for day_first in (False, True):
        found = rm.Retype("x", "datetime64[ns]", day_first=day_first).run(dates).first().x
        assert str(found) == "2024-02-13 00:00:00"


def test_imputation_leaves_nested_columns(spark):
    df = spark.sql("select * from values (1.0D, array(1)), (null, null) t(x, y)")
    assert [(r.x, r.y) for r in rm.Impute().run(df).orderBy("y").collect()] == [(1.0, None), (1.0, [1])]


def test_realign_refuses_repeated_keys(spark):
    now = spark.createDataFrame([(1, "a")], "k int, x string")
    before = spark.createDataFrame([(1, "b"), (1, "c")], "k int, x string")
    with pytest.raises(rm.StepRefused):
        rm.realign(now, before, "x", "k")


def test_replay_after_restore(spark):
    df = spark.createDataFrame([("1,5",), ("2",)], "x string")
    p = rm.Pipeline(df)
    p.apply(rm.Retype("x", "float64"))
    assert rm.replay(df, p.actions).columns == ["x"]
    p.restore("x")
    again = rm.replay(df, p.actions)
    assert again.schema == p.current.schema
    assert sorted(r.x for r in again.collect()) == ["1,5", "2"]


def test_instants_of_a_repeated_hour_and_nan(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.sql("select timestamp_seconds(s) t from values (1729987200 + 1800), (1729990800 + 1800) v(s)")
        assert rm.column_report(df).first().distinct == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    values = spark.sql("select * from values (double('NaN')), (1.0D) v(x)")
    assert rm.categorical_stats(values, ["x"]).first().distinct == 1

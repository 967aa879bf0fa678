import pytest

import rowmill as rm


@pytest.fixture
def source(frame):
    rows = [(1, "1,5", 3.0, "a"), (2, "2,5", None, "b"), (3, "9,5", float("nan"), "a"),
            (4, "4,0", 5.0, None)]
    return frame(rows, "id int, t string, x double, c string")


def ids(df):
    return [r["id"] for r in df.orderBy("id").collect()]


def test_steps_are_applied_in_order_and_logged(source):
    p = rm.Pipeline(source, "demo")
    p.apply(rm.Impute("x", numeric="drop_rows")).apply(rm.Impute("c"))
    p.apply(rm.Scale("x", "minmax")).apply(rm.KeepColumns(["id", "c", "x_scaled"]))
    assert p.current.columns == ["id", "c", "x_scaled"]
    assert [tuple(r) for r in p.current.orderBy("id").collect()] == [(1, "a", 0.0), (4, "a", 1.0)]
    log = [r.asDict() for r in p.log().orderBy("step_no").collect()]
    assert [l["op"] for l in log] == ["load", "impute", "impute", "scale", "keep"]
    assert (log[1]["rows_before"], log[1]["rows_after"]) == (4, 2)
    assert log[2]["rows_before"] is None
    assert tuple(p.summary().first()) == (4, 2, 4, 3, 0, 5)
    assert tuple(p.status().first()) == (2, 3, 0, 1, 5)


def test_restore_follows_dropped_rows(source):
    p = rm.Pipeline(source)
    p.apply(rm.Retype("t", "float64"))
    assert p.retyped == {"t": "object"} and dict(p.current.dtypes)["t"] == "double"
    p.apply(rm.TreatOutliers("t", "cap_pct")).apply(rm.Impute("x", numeric="drop_rows"))
    p.restore("t")
    assert p.current.columns == source.columns
    assert [r["t"] for r in p.current.orderBy("id").collect()] == ["1,5", "4,0"]
    assert p.retyped == {}
    assert "Join" not in p.current._jdf.queryExecution().optimizedPlan().toString()


def test_restore_goes_back_to_the_first_type(source):
    p = rm.Pipeline(source)
    p.apply(rm.Retype("t", "float64")).apply(rm.Retype("t", "object"))
    assert p.retyped == {}
    p.apply(rm.Retype("id", "float64")).apply(rm.Retype("id", "object"))
    assert p.retyped == {"id": "int64"}
    p.apply(rm.KeepColumns(["id", "c"])).restore("id")
    assert dict(p.current.dtypes) == {"id": "int", "c": "string"}
    before = p.current.columns
    assert p.restore("c").restore("nowhere").current.columns == before


def test_a_refused_step_changes_nothing(source):
    p = rm.Pipeline(source)
    with pytest.raises(rm.StepRefused):
        p.apply(rm.Retype("c", "int64"))
    assert p.current.columns == source.columns and p.retyped == {} and p.actions == []
    assert [r["op"] for r in p.log().orderBy("step_no").collect()] == ["load", "refused"]


def test_a_failing_change_leaves_everything_as_it_was(source):
    class Broken(rm.Retype):
        def fit(self, df):
            def fail(target):
                raise RuntimeError("no")

            return [rm.Action("retype", self.column, "", fail)]

    p = rm.Pipeline(source)
    with pytest.raises(RuntimeError):
        p.apply(Broken("t", "float64"))
    assert p.retyped == {} and p.current.columns == source.columns and p.log().count() == 1
    assert p.restore("t").log().count() == 1


def test_reset(source):
    p = rm.Pipeline(source)
    p.apply(rm.Retype("t", "float64")).apply(rm.Impute("c", other="drop_rows")).reset()
    assert ids(p.current) == [1, 2, 3, 4] and p.current.columns == source.columns
    assert p.retyped == {} and p.log().count() == 1


def test_consecutive_steps_share_one_scan(table):
    p = rm.Pipeline(table("orders"), count_rows=False)
    p.apply(rm.TreatOutliers("o_totalprice", "cap_pct")).apply(rm.Scale("o_totalprice", "robust"))
    p.apply(rm.LabelEncode("o_orderstatus")).apply(rm.KeepColumns(["o_totalprice_scaled"]))
    plan = p.current._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    assert "ReadSchema: struct<o_totalprice:double>" in plan


def test_fitted_steps_apply_to_a_stream(spark, table, tmp_path):
    batch = table("events").select("event_id", "event_type", "value")
    p = rm.Pipeline(batch, count_rows=False)
    p.apply(rm.TreatOutliers("value", "iqr_drop")).apply(rm.LabelEncode("event_type"))
    p.apply(rm.Scale("value", "standard"))
    folder = str(tmp_path / "in")
    batch.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(batch.schema).parquet(folder)
    query = (
        rm.replay(stream, p.actions)
        .writeStream.format("memory").queryName("replayed").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.awaitTermination(120)
    order = "event_id"
    assert spark.table("replayed").orderBy(order).collect() == p.current.orderBy(order).collect()

"""The registered queries: every operator on the given tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import rowmill as rm
from rowmill.operators.retype import invalid_samples
from rowmill.functions.scalars import to_numeric_flexible
from rowmill.plans.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value",
        "replace(cast(value AS string), '.', ',') AS value_text",
        "cast(cast(ts AS date) AS string) AS day_text",
        "cast(user_id AS string) AS user_text",
        "props",
    )


def lineitem_net(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        *LINE_NUMBERS,
        "l_extendedprice * (1 - l_discount) AS net",
        "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END AS qty_null",
    )


def six_digits(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# Reports


@query
def overview_shape(spark, sf):
    return rm.overview_shape(events_dirty(spark, sf))


@query
def table_status(spark, sf):
    return rm.table_status(events_dirty(spark, sf), 1)


@query
def run_summary(spark, sf):
    p = rm.Pipeline(events_dirty(spark, sf), "events", count_rows=False)
    p.apply(rm.Impute("event_type", other="drop_rows")).apply(rm.DropColumns(["props"]))
    return p.summary()


@query
def null_counts(spark, sf):
    return rm.null_counts(events_dirty(spark, sf))


@query
def missing_report(spark, sf):
    return rm.missing_report(events_dirty(spark, sf))


@query
def column_report(spark, sf):
    return rm.column_report(events_dirty(spark, sf))


@query
def column_report_documents(spark, sf):
    return rm.column_report(table(spark, sf, "documents"))


@query
def numeric_stats(spark, sf):
    return rm.numeric_stats(table(spark, sf, "lineitem"), LINE_NUMBERS, digits=3)


@query
def numeric_stats_gaps(spark, sf):
    return rm.numeric_stats(events_dirty(spark, sf), ["value", "user_id"], digits=3)


@query
def describe_numeric(spark, sf):
    return rm.describe_numeric(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query
def quantiles(spark, sf):
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = rm.quantiles(table(spark, sf, "lineitem"), LINE_NUMBERS, probs)
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(probs, values)]
    return six_digits(spark.createDataFrame(rows, "column string, p double, value double"), "value")


@query
def categorical_stats(spark, sf):
    return rm.categorical_stats(
        events_dirty(spark, sf), ["event_type", "day_text", "user_text"], digits=6
    )


@query
def value_counts(spark, sf):
    return rm.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query
def category_shares(spark, sf):
    shares = rm.category_shares(events_dirty(spark, sf), ["event_type", "user_text"], 15)
    return six_digits(shares, "share")


@query
def category_shares_part(spark, sf):
    return six_digits(rm.category_shares(table(spark, sf, "part"), ["p_brand", "p_type"]), "share")


@query
def category_shares_dates(spark, sf):
    """Times have no shares, and all values of a text column have one."""
    return six_digits(rm.category_shares(events_dirty(spark, sf), ["ts", "day_text"]), "share")


@query
def default_picks(spark, sf):
    """The columns that exploration begins with, described, beside how many a selection covers."""
    df = table(spark, sf, "lineitem")
    picks = rm.default_picks(df)
    report = rm.column_report(df.select(*picks["numeric"], *picks["categorical"]))
    covered = rm.selection_counts(df, picks["numeric"])
    return report.withColumns({f"selected_{k}": F.lit(n).cast("long") for k, n in covered.items()})


@query
def encoding_status(spark, sf):
    return rm.encoding_status(events_dirty(spark, sf), ["event_type", "user_text"], key="event_id")


@query
def raw_stats(spark, sf):
    return rm.raw_stats(table(spark, sf, "orders").select("o_custkey", "o_totalprice"))


# Outliers


@query
def outlier_report_iqr(spark, sf):
    return rm.outlier_report(events_dirty(spark, sf), "iqr", columns=["value", "user_id"])


@query
def outlier_report_z(spark, sf):
    return rm.outlier_report(table(spark, sf, "documents"), "zscore", columns=["n_chars"])


@query
def outlier_summary(spark, sf):
    return six_digits(
        rm.outlier_summary(table(spark, sf, "documents"), ["n_chars"]), "q1", "q3", "lower", "upper"
    )


def _treated(spark, sf, method, **options):
    df = events_dirty(spark, sf).select("event_id", "value")
    return six_digits(rm.TreatOutliers("value", method, **options).run(df), "value")


@query
def outlier_iqr_clip(spark, sf):
    return _treated(spark, sf, "iqr_clip")


@query
def outlier_iqr_drop(spark, sf):
    return _treated(spark, sf, "iqr_drop")


@query
def outlier_z_clip(spark, sf):
    return _treated(spark, sf, "zscore_clip", k=2.0)


@query
def outlier_z_drop(spark, sf):
    return _treated(spark, sf, "zscore_drop", k=2.0)


@query
def outlier_cap_pct(spark, sf):
    return _treated(spark, sf, "cap_pct")


def _two_columns(spark, sf):
    return events_dirty(spark, sf).selectExpr("event_id", "value", "value * value AS squared")


@query
def outlier_iqr_drop_seq(spark, sf):
    step = rm.TreatOutliers(method="iqr_drop", columns=["value", "squared"])
    return six_digits(step.run(_two_columns(spark, sf)), "value", "squared")


@query
def outlier_iqr_drop_joint(spark, sf):
    step = rm.TreatOutliers(method="iqr_drop", columns=["value", "squared"], order="joint")
    return six_digits(step.run(_two_columns(spark, sf)), "value", "squared")


# Imputation


def _imputed(spark, sf, step):
    df = events_dirty(spark, sf).select("event_id", "event_type", "value")
    return six_digits(step.run(df), "value")


@query
def impute_mean(spark, sf):
    return _imputed(spark, sf, rm.Impute("value", numeric="mean"))


@query
def impute_median(spark, sf):
    return _imputed(spark, sf, rm.Impute("value", numeric="median"))


@query
def impute_mode(spark, sf):
    return _imputed(spark, sf, rm.Impute(numeric="mode", other="mode"))


@query
def impute_constant(spark, sf):
    return _imputed(spark, sf, rm.Impute(numeric="constant", other="constant", number=-1.5))


@query
def impute_drop_rows(spark, sf):
    return _imputed(spark, sf, rm.Impute("value", numeric="drop_rows"))


@query
def impute_drop_col(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "event_type", "value")
    return rm.Impute("value", numeric="drop_col").run(df)


@query
def impute_all(spark, sf):
    """Rows without a type go first, so the mean is that of the remaining rows."""
    return _imputed(spark, sf, rm.Impute(numeric="mean", other="drop_rows"))


# Encoding


@query
def encode_label(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return rm.LabelEncode().run(df)


@query
def encode_label_wide(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "user_text")
    return rm.LabelEncode("user_text").run(df)


@query
def encode_label_null(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "event_type")
    return rm.LabelEncode("event_type", null_label="nan").run(df)


@query
def encode_onehot(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "event_type")
    return rm.OneHotEncode("event_type").run(df)


@query
def encode_ordinal(spark, sf):
    codes = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return rm.OrdinalEncode(codes, "o_orderpriority").run(df)


@query
def encode_binary(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", "l_returnflag")
    return rm.BinaryEncode(by="value").run(df)


@query
def encode_binary_first_seen(spark, sf):
    df = table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS outcome"
    )
    return rm.BinaryEncode("outcome", key="event_id").run(df)


# Scaling


def _scaled(spark, sf, method):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return six_digits(rm.Scale("c_acctbal", method).run(df), "c_acctbal_scaled")


@query
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query
def scale_log(spark, sf):
    return _scaled(spark, sf, "log")


@query
def scale_sqrt(spark, sf):
    return _scaled(spark, sf, "sqrt")


@query
def scale_infinite_refused(spark, sf):
    """A column with infinities is refused by name, and the table stays as it is."""
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_acctbal",
        "CASE WHEN c_custkey % 50 = 0 THEN cast('Infinity' AS double) ELSE c_acctbal END AS balance",
    )
    p = rm.Pipeline(df, "customer", count_rows=False)
    try:
        p.apply(rm.Scale(method="minmax", columns=["c_acctbal", "balance"]))
        refused = None
    except rm.StepRefused as error:
        refused = str(error)
    return p.current.withColumn("refused", F.lit(refused).cast("string"))


@query
def keep_suggested(spark, sf):
    """Keeping the suggested columns leaves out those that scaling hid; the hidden ones are counted."""
    df = rm.Scale(method="sqrt", columns=["o_totalprice", "o_custkey"]).run(_orders(spark, sf))
    kept = rm.KeepColumns(rm.suggested_columns(df)).run(df)
    hidden = F.lit(len(rm.hidden_columns(df))).cast("long").alias("hidden")
    return six_digits(kept, "o_totalprice_scaled", "o_custkey_scaled").select("*", hidden)


@query
def scaled_stats(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    return rm.scaled_stats(rm.Scale("o_totalprice", "minmax").run(df), digits=6)


# Relations


@query
def covariance(spark, sf):
    return rm.covariance(lineitem_net(spark, sf), digits=3)


@query
def corr_pearson(spark, sf):
    return rm.correlation(lineitem_net(spark, sf), digits=6)


@query
def corr_spearman(spark, sf):
    return rm.correlation(lineitem_net(spark, sf), method="spearman", digits=6)


@query
def corr_kendall(spark, sf):
    return rm.correlation(
        table(spark, sf, "customer"), ["c_nationkey", "c_acctbal"], "kendall", digits=6
    )


@query
def corr_kendall_gaps(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_nationkey", "c_acctbal", "c_custkey * 7919 % 1000 AS mixed",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey END AS gappy",
    )
    return rm.correlation(df, ["c_nationkey", "c_acctbal", "mixed", "gappy"], "kendall", digits=6)


@query
def mean_abs_corr(spark, sf):
    return rm.mean_abs_correlation(lineitem_net(spark, sf), digits=6)


@query
def average_ranks(spark, sf):
    return rm.average_ranks(lineitem_net(spark, sf), ["l_extendedprice", "qty_null"])


# Distributions


@query
def histogram(spark, sf):
    bars = rm.histogram(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    return six_digits(bars, "low", "high")


@query
def density_histogram(spark, sf):
    bars = rm.histogram(events_dirty(spark, sf), "value", density=True)
    return six_digits(bars, "low", "high").withColumn("density", F.round("density", 9))


@query
def numeric_distribution(spark, sf):
    return six_digits(rm.numeric_distribution(table(spark, sf, "lineitem"), LINE_NUMBERS),
                      "low", "high")


@query
def kde(spark, sf):
    curve = rm.kde(events_dirty(spark, sf), "value")
    return six_digits(curve, "x").withColumn("density", F.round("density", 9))


@query
def figure_density(spark, sf):
    """The tables of a histogram with its density curve, in one: heights at the bins' starts and at the points."""
    found = rm.distribution(events_dirty(spark, sf), "value", "hist_density")
    bars = found["histogram"].select(F.lit("bar").alias("part"), "bin", "low", "density")
    curve = found["kde"].select(F.lit("curve"), "point", "x", "density")
    long = bars.union(curve).toDF("part", "place", "x", "height")
    return six_digits(long, "x").withColumn("height", F.round("height", 9))


@query
def figure_box(spark, sf):
    """The tables of a box figure: the box beside each value outside the fences."""
    found = rm.distribution(events_dirty(spark, sf), "value", "box")
    box = found["box"].select("q1", "median", "q3").first().asDict()
    return six_digits(found["outliers"].withColumns({k: F.lit(v) for k, v in box.items()}), *box)


@query
def box_stats(spark, sf):
    return six_digits(
        rm.box_stats(events_dirty(spark, sf), ["value", "user_id"]),
        "mean", "q1", "median", "q3", "whisker_low", "whisker_high",
    )


@query
def box_outliers(spark, sf):
    return rm.box_outliers(events_dirty(spark, sf), "value")


@query
def scatter_cells(spark, sf):
    return rm.scatter(events_dirty(spark, sf), "user_id", "value", "event_type", bins=20).cells


@query
def scatter_points(spark, sf):
    """A sampling operator: up to five points of each cell and colour, by a hash of the key."""
    df = events_dirty(spark, sf)
    return rm.scatter(df, "user_id", "value", "event_type", bins=20, per_cell=5, key="event_id").points


@query
def scatter_margin(spark, sf):
    found = rm.scatter(events_dirty(spark, sf), "user_id", "value", "event_type", bins=20)
    return six_digits(found.marginal_y, "low", "high")


# Typing and columns


@query
def retype_float_comma(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "value_text")
    return rm.Retype("value_text", "float64").run(df)


@query
def retype_int(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "user_text")
    return rm.Retype("user_text", "int64").run(df)


@query
def retype_datetime(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "day_text")
    return rm.Retype("day_text", "datetime64[ns]").run(df)


@query
def retype_datetime_day_first(spark, sf):
    df = table(spark, sf, "events").selectExpr("event_id", "date_format(ts, 'dd/MM/yyyy') AS day_text")
    return rm.Retype("day_text", "datetime64[ns]").run(df)


@query
def retype_text(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "user_id")
    return rm.Retype("user_id", "object").run(df)


@query
def retype_refused(spark, sf):
    """The examples of a refusal, in text order as the table has no row id."""
    df = events_dirty(spark, sf).select("event_type")
    bad = F.col("event_type").isNotNull() & to_numeric_flexible(
        F.col("event_type"), df.schema["event_type"].dataType
    ).isNull()
    try:
        rm.Retype("event_type", "int64").run(df)
    except rm.StepRefused:
        return spark.createDataFrame(
            [(s,) for s in invalid_samples(df, "event_type", bad)], "sample string"
        )
    return spark.createDataFrame([], "sample string")


@query
def restore_column(spark, sf):
    """Retype, drop rows, restore: the surviving rows have their text back."""
    p = rm.Pipeline(events_dirty(spark, sf).select("event_id", "value", "value_text"), "events",
                    count_rows=False)
    p.apply(rm.Retype("value_text", "float64")).apply(rm.Impute("value", numeric="drop_rows"))
    return p.restore("value_text").current


@query
def restore_by_key(spark, sf):
    prior = events_dirty(spark, sf).select("event_id", "value", "value_text")
    now = prior.filter("value > 10").withColumn("value_text", F.lit("changed"))
    return rm.realign(now, prior, "value_text", "event_id")


@query
def keep_columns(spark, sf):
    return rm.KeepColumns(["user_id", "event_id"]).run(events_dirty(spark, sf))


@query
def drop_columns(spark, sf):
    return rm.DropColumns(["props", "absent", "ts"]).run(events_dirty(spark, sf))


@query
def drop_temporary(spark, sf):
    df = rm.Scale("c_acctbal", "sqrt").run(table(spark, sf, "customer"))
    return six_digits(rm.DropTemporary().run(df), "c_acctbal_scaled")


@query
def preview(spark, sf):
    df = events_dirty(spark, sf).select("event_id", "event_type", "user_id", "day_text")
    return rm.preview_rows(df, key="event_id")


# Normality


@query
def normality(spark, sf):
    return rm.normality(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"], "c_custkey")


@query
def normality_supplier(spark, sf):
    return rm.normality(table(spark, sf, "supplier"), ["s_acctbal", "s_nationkey"], "s_suppkey")


@query
def normality_events(spark, sf):
    return rm.normality(events_dirty(spark, sf), ["value"], "event_id")


@query
def normality_sample(spark, sf):
    """A sampling operator: 500 values, by a hash of the key."""
    return rm.normality(events_dirty(spark, sf), ["value"], "event_id", sample_size=500)


# Files


def _text_copy(df: DataFrame, separator: str, header: bool = True, encoding: str = "UTF-8") -> str:
    path = f"{shared_folder(df.sparkSession)}/rowmill/text-{uuid.uuid4().hex}"
    df.write.csv(path, sep=separator, header=header, encoding=encoding)
    return path


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query
def csv_round_trip(spark, sf):
    return rm.read_delimited(spark, _text_copy(_orders(spark, sf), ";")).df


@query
def csv_custom_separator(spark, sf):
    return rm.read_delimited(spark, _text_copy(_orders(spark, sf), "::"), "::").df


@query
def csv_regex_separator(spark, sf):
    path = _text_copy(_orders(spark, sf), "|")
    return rm.read_delimited(spark, path, r"[|]", regex_separator=True).df


@query
def csv_headerless(spark, sf):
    path = _text_copy(_orders(spark, sf), ",", header=False)
    return rm.read_delimited(spark, path, "comma", header=False).df


@query
def csv_latin1_fallback(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat('señal ', o_orderpriority) AS note"
    )
    path = _text_copy(df, "\t", encoding="ISO-8859-1")
    return rm.read_delimited(spark, path, "tab", encoding="utf-8").df


@query
def csv_load_record(spark, sf):
    loaded = rm.read_delimited(spark, _text_copy(_orders(spark, sf), ";"))
    return loaded.record().drop("path")


@query
def csv_quoted_breaks(spark, sf):
    path = f"{shared_folder(spark)}/rowmill/text-{uuid.uuid4().hex}"
    table(spark, sf, "documents").select("doc_id", "source", "text").write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return rm.read_delimited(spark, path, ",").df


@query
def csv_mixed_encodings(spark, sf):
    """UTF-8 and latin1 files in one folder, found by a glob."""
    path = f"{shared_folder(spark)}/rowmill/text-{uuid.uuid4().hex}"
    df = table(spark, sf, "orders").selectExpr("o_orderkey", "concat('señal ', o_orderpriority) AS note")
    for rest, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        part = df.where(F.col("o_orderkey") % 2 == rest)
        part.write.csv(path, sep=";", header=True, encoding=encoding, mode="append")
    return rm.read_delimited(spark, f"{path}/part-*.csv").df


@query
def csv_ragged(spark, sf):
    """Rows that lack their last field; the first row of the first file has all."""
    path = f"{shared_folder(spark)}/rowmill/text-{uuid.uuid4().hex}"
    short = F.expr("o_orderkey % 3 = 0")
    fields = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    lines = F.when(short, F.concat_ws(";", *fields[:2])).otherwise(F.concat_ws(";", *fields))
    table(spark, sf, "orders").orderBy(short, "o_orderkey").select(lines.alias("value")).write.text(path)
    return rm.read_delimited(spark, path, header=False).df


@query
def csv_control_character(spark, sf):
    df = table(spark, sf, "orders").selectExpr("o_orderkey", "concat(o_orderstatus, chr(1), o_orderpriority) AS note")
    return rm.read_delimited(spark, _text_copy(df, "|"), "[|]", regex_separator=True).df


@query
def csv_by_name(spark, sf):
    """Files of one folder whose columns come in different orders."""
    path = f"{shared_folder(spark)}/rowmill/text-{uuid.uuid4().hex}"
    df = _orders(spark, sf)
    for rest, names in ((0, df.columns), (1, df.columns[::-1])):
        df.where(F.col("o_orderkey") % 2 == rest).select(*names).write.csv(path, sep=";", header=True, mode="append")
    found = rm.read_delimited(spark, path).df
    return found.select(*df.columns)


@query
def csv_written(spark, sf):
    path = f"{shared_folder(spark)}/rowmill/text-{uuid.uuid4().hex}"
    rm.write_csv(_orders(spark, sf), path)
    return rm.read_delimited(spark, path, "comma").df


# The pipeline of steps


@query
def pipeline_log(spark, sf):
    """Rows before and after the steps that drop some, counted by one job."""
    p = rm.Pipeline(events_dirty(spark, sf), "events")
    p.apply(rm.Impute("event_type", other="drop_rows")).apply(rm.DropColumns(["props"]))
    p.apply(rm.Impute("value", numeric="drop_rows"))
    return p.log().where("rows_before IS NOT NULL").select("step_no", "column", "rows_before", "rows_after")


@query
def pipeline_reset(spark, sf):
    p = rm.Pipeline(events_dirty(spark, sf), "events")
    p.apply(rm.Impute("event_type", other="drop_rows")).apply(rm.DropColumns(["props"]))
    return p.reset().status()

"""Categorical encoding."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import (
    ENCODED_SUFFIX,
    ROW_ID,
    categorical_columns,
    col,
    replace_columns,
    require_columns,
)
from rowmill.operators.ranks import attach_by_value, running_weight
from rowmill.plans.step import ALL, Action, Step, StepRefused, replacing, unchanged
from rowmill.plans.storage import materialise

METHODS = ("label", "onehot", "ordinal", "binary")

# Codes given by hand are literals of the plan.
ORDINAL_CODES = 500_000

# Up to this many codes are compared in place instead of joined.
INLINE_CODES = 32


def _scope(df: DataFrame, column: str) -> list[str]:
    if column == ALL:
        return categorical_columns(df)
    return require_columns(df, [column])


def _case(x: Column, codes: Mapping[str, int]) -> Column:
    value = F.lit(None).cast("bigint")
    for text, code in codes.items():
        value = F.when(x == F.lit(text), F.lit(code).cast("bigint")).otherwise(value)
    return value


def label_codes(
    df: DataFrame, column: str, null_label: str | None = None
) -> tuple[DataFrame, int, int]:
    """(value, n, code) with codes 0.. in text order; plus its row count and the rows it covers."""
    counts = materialise(
        df.select(_labelled(col(column), null_label).alias("value"))
        .filter("value is not null")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"), F.lit(1).cast("bigint").alias("one"))
    )
    levels, rows = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    codes = running_weight(counts, [], "value", ["one"])
    return codes.select("value", "n", F.col("before_one").alias("code")), levels, rows


def _labelled(x: Column, null_label: str | None) -> Column:
    x = x.cast("string")
    return x if null_label is None else F.coalesce(x, F.lit(null_label))


@dataclass(frozen=True)
class LabelEncode(Step):
    """Replace text by codes 0.. in text order.

    NULL stays NULL, unless `null_label` names the text it counts as.
    """

    column: str = ALL
    null_label: str | None = None

    def fit(self, df: DataFrame) -> list[Action]:
        return [self._fit_column(df, c) for c in _scope(df, self.column)]

    def _fit_column(self, df: DataFrame, c: str) -> Action:
        codes, levels, rows = label_codes(df, c, self.null_label)
        detail = f"label: {levels} codes"
        if levels <= INLINE_CODES:
            table = {r["value"]: r["code"] for r in codes.collect()}
            value = _case(_labelled(col(c), self.null_label), table)
            return Action("encode", c, detail, replacing({c: value}))
        codes = materialise(codes)

        def apply(target: DataFrame) -> DataFrame:
            keyed = target.withColumn("__key", _labelled(col(c), self.null_label))
            joined = attach_by_value(keyed, codes, "__key", "value", "n", ["code"], rows)
            return joined.select(
                *[F.col("code").alias(c) if n == c else col(n) for n in target.columns]
            )

        return Action("encode", c, detail, apply)


@dataclass(frozen=True)
class OneHotEncode(Step):
    """Append a 0/1 column {column}_{value}_encoded per value, in text order; NULL gives all 0."""

    column: str = ALL
    max_levels: int = 1000

    def fit(self, df: DataFrame) -> list[Action]:
        actions = []
        for c in _scope(df, self.column):
            levels = (
                df.select(col(c).cast("string").alias("value"))
                .filter("value is not null")
                .distinct()
                .limit(self.max_levels + 1)
                .collect()
            )
            if len(levels) > self.max_levels:
                raise StepRefused(f"one-hot on {c}: more than {self.max_levels} values")
            values = sorted((r["value"] for r in levels), key=lambda v: v.encode("utf-8"))
            x, new = col(c).cast("string"), {}
            taken = {n.lower() for n in df.columns if not n.lower().startswith(f"{c}_".lower())}
            for v in values:
                name, again = f"{c}_{v}{ENCODED_SUFFIX}", 0
                # Names that differ by case alone would be one column.
                while name.lower() in taken:
                    again += 1
                    name = f"{c}_{v}.{again}{ENCODED_SUFFIX}"
                taken.add(name.lower())
                new[name] = x.eqNullSafe(F.lit(v)).cast("bigint")
            actions.append(Action("encode", c, f"one-hot: {len(values)} columns", replacing(new)))
        return actions


@dataclass(frozen=True)
class OrdinalEncode(Step):
    """Append {column}_encoded with the number `codes` gives each value; others become NULL."""

    codes: Mapping[str, int]
    column: str = ALL

    def fit(self, df: DataFrame) -> list[Action]:
        if len(self.codes) > ORDINAL_CODES:
            raise StepRefused(f"at most {ORDINAL_CODES} ordinal codes")
        detail = f"ordinal: {len(self.codes)} codes"
        return [
            Action("encode", c, detail, self._appending(df, c)) for c in _scope(df, self.column)
        ]

    def _appending(self, df: DataFrame, c: str) -> Callable[[DataFrame], DataFrame]:
        name = f"{c}{ENCODED_SUFFIX}"
        if len(self.codes) <= INLINE_CODES:
            return replacing({name: _case(col(c).cast("string"), self.codes)})
        table = df.sparkSession.createDataFrame(
            list(self.codes.items()), "__value string, __code bigint"
        )

        def apply(target: DataFrame) -> DataFrame:
            match = col(c).cast("string") == F.col("__value")
            joined = target.join(F.broadcast(table), match, "left")
            kept = replace_columns(joined, {name: F.col("__code")})
            return kept.drop("__value", "__code")

        return apply


@dataclass(frozen=True)
class BinaryEncode(Step):
    """Replace a column of exactly two distinct values by 0 and 1; others are logged and kept.

    Codes follow the first appearance by `key`, or the text order with by="value".
    """

    column: str = ALL
    by: str = "first_seen"
    key: str = ROW_ID

    def __post_init__(self) -> None:
        if self.by not in ("first_seen", "value"):
            raise ValueError(f"unknown order of codes: {self.by}")

    def fit(self, df: DataFrame) -> list[Action]:
        names = _scope(df, self.column)
        if not names:
            return []
        if self.by == "first_seen":
            require_columns(df, [self.key])
        text = {c: col(c).cast("string") for c in names}
        ends = df.agg(*[f(text[c]) for c in names for f in (F.min, F.max)]).first()
        pairs = {c: (ends[2 * i], ends[2 * i + 1]) for i, c in enumerate(names)}
        exprs = []
        for c, (low, high) in pairs.items():
            x = text[c]
            exprs.append(F.count_if((x != F.lit(low)) & (x != F.lit(high))))
            at = col(self.key) if self.by == "first_seen" else F.lit(0)
            exprs += [F.min(F.when(x == F.lit(v), at)) for v in (low, high)]
        row = df.agg(*exprs).first()
        actions = []
        for i, (c, (low, high)) in enumerate(pairs.items()):
            others, first_low, first_high = row[3 * i : 3 * i + 3]
            if low is None or low == high or others:
                actions.append(
                    Action("encode", c, "binary: needs exactly 2 values, skipped", unchanged)
                )
                continue
            order = [low, high]
            if self.by == "first_seen" and first_high < first_low:
                order = [high, low]
            codes = {v: n for n, v in enumerate(order)}
            actions.append(
                Action("encode", c, f"binary: {codes}", replacing({c: _case(text[c], codes)}))
            )
        return actions

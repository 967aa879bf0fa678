"""Imputation of missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import (
    col,
    is_atomic,
    is_fractional,
    is_numeric,
    require_columns,
)
from rowmill.functions.scalars import double
from rowmill.operators.profile import columns_with_nulls
from rowmill.operators.quantiles import quantiles
from rowmill.operators.ranks import count_values
from rowmill.plans.step import ALL, Action, Step, dropping, keeping, replacing, unchanged

NUMERIC_STRATEGIES = ("mean", "median", "mode", "constant", "drop_rows", "drop_col")
OTHER_STRATEGIES = ("mode", "constant", "drop_rows", "drop_col")


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column, the smallest on ties; None without values.

    Values that are neither numbers nor text come back as text.
    """
    by_type: dict[str, list[str]] = {}
    for c in columns:
        data_type = df.schema[c].dataType
        if is_fractional(data_type):
            kind = "double"
        else:
            kind = "bigint" if is_numeric(data_type) else "string"
        by_type.setdefault(kind, []).append(c)
    found: dict[str, object] = {c: None for c in columns}
    for kind, names in by_type.items():
        cast = df.select(*[col(c).cast(kind).alias(c) for c in names])
        best = (
            count_values(cast, names)
            .filter("value is not null")
            .groupBy("item")
            .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
        )
        for row in best.collect():
            found[names[row["item"]]] = row["value"]
    return found


@dataclass(frozen=True)
class Impute(Step):
    """Fill or remove missing values in one column, or in all columns that have some.

    `numeric` is the strategy of numeric columns, `other` that of all others. Columns without
    missing values are skipped. A mean or median makes an integer column double.
    """

    column: str = ALL
    numeric: str = "mean"
    other: str = "mode"
    number: float = 0.0
    text: str = "unknown"
    moment: str | None = None
    exact: bool = True

    def __post_init__(self) -> None:
        if self.numeric not in NUMERIC_STRATEGIES:
            raise ValueError(f"unknown strategy for numeric columns: {self.numeric}")
        if self.other not in OTHER_STRATEGIES:
            raise ValueError(f"unknown strategy for other columns: {self.other}")
        float(self.number)

    def _strategy(self, df: DataFrame, c: str) -> str:
        return self.numeric if is_numeric(df.schema[c].dataType) else self.other

    def fit(self, df: DataFrame) -> list[Action]:
        if self.column != ALL:
            require_columns(df, [self.column])
            scope = [self.column]
        else:
            scope = [f.name for f in df.schema if is_atomic(f.dataType)]
        lacking = set(columns_with_nulls(df))
        names = [c for c in scope if c in lacking]
        actions: list[Action] = []
        pending: list[str] = []
        rows_dropped = False
        for c in names:
            if self._strategy(df, c) != "drop_rows":
                pending.append(c)
                continue
            # Removing rows changes what later columns see, so earlier fits come first.
            actions += self._fit_columns(df, pending, rows_dropped)
            pending = []
            if rows_dropped and not columns_with_nulls(df.select(col(c))):
                continue
            keep = keeping(col(c).isNotNull())
            actions.append(Action("impute", c, "drop_rows", keep, drops_rows=True))
            df, rows_dropped = keep(df), True
        return actions + self._fit_columns(df, pending, rows_dropped)

    def _fit_columns(self, df: DataFrame, names: list[str], recheck: bool) -> list[Action]:
        if names and recheck:
            lacking = set(columns_with_nulls(df.select(*[col(c) for c in names])))
            names = [c for c in names if c in lacking]
        by_strategy: dict[str, list[str]] = {}
        for c in names:
            by_strategy.setdefault(self._strategy(df, c), []).append(c)
        values: dict[str, object] = {}
        if cols := by_strategy.get("mean"):
            row = df.agg(*[F.avg(double(col(c))) for c in cols]).first()
            values.update(zip(cols, row))
        if cols := by_strategy.get("median"):
            found = quantiles(df, cols, [0.5], exact=self.exact)
            values.update({c: found[c][0] for c in cols})
        if cols := by_strategy.get("mode"):
            values.update(modes(df, cols))
        for c in by_strategy.get("constant", []):
            values[c] = self._constant(df.schema[c].dataType, df)
        return [self._action(df, c, values) for c in names]

    def _constant(self, data_type: T.DataType, df: DataFrame) -> object:
        if is_numeric(data_type):
            return float(self.number)
        if isinstance(data_type, T.StringType):
            return self.text or "unknown"
        if self.moment is None:
            raise ValueError(f"a constant for {data_type.simpleString()} columns is needed")
        typed = F.lit(self.moment).try_cast(data_type)
        if df.sparkSession.range(1).select(typed.isNull()).first()[0]:
            raise ValueError(f"not a {data_type.simpleString()}: {self.moment}")
        return self.moment

    def _action(self, df: DataFrame, c: str, values: dict[str, object]) -> Action:
        strategy = self._strategy(df, c)
        if strategy == "drop_col":
            return Action("impute", c, "drop_col", dropping([c]))
        value = values[c]
        if value is None:
            return Action("impute", c, f"{strategy}: no values, nothing filled", unchanged)
        filled = _filled(col(c), df.schema[c].dataType, strategy, value)
        return Action("impute", c, f"{strategy}: {value}", replacing({c: filled}))


def _filled(x: Column, data_type: T.DataType, strategy: str, value: object) -> Column:
    if is_numeric(data_type) and not is_fractional(data_type):
        if strategy == "mode" or (strategy == "constant" and float(value).is_integer()):
            return F.coalesce(x, F.lit(int(value)).cast(data_type))
        return F.coalesce(double(x), F.lit(float(value)))
    if is_fractional(data_type):
        return F.coalesce(double(x), F.lit(float(value)))
    return F.coalesce(x, F.lit(value).cast(data_type))

"""Scaling of numeric columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import (
    HIDDEN_SOURCE,
    SCALED_SUFFIX,
    col,
    hidden_sources,
    numeric_columns,
    require_numeric,
)
from rowmill.functions.scalars import double, floor_at_zero
from rowmill.operators.quantiles import Outline, outline_expressions, quantiles
from rowmill.plans.step import ALL, Action, Step, StepRefused

METHODS = ("standard", "minmax", "robust", "log", "sqrt")
_FITTED = ("standard", "minmax", "robust")


@dataclass(frozen=True)
class Scale(Step):
    """Write {x}_scaled and hide the source as _x; scaling again starts from the hidden source.

    standard: (x - mean) / population sd. minmax: to [0, 1]. robust: (x - median) / IQR. log and
    sqrt: log1p and square root of x floored at 0. A spread of 0 counts as 1. The first three
    refuse infinite values, and then no column is changed.
    """

    column: str = ALL
    method: str = "standard"
    columns: Sequence[str] | None = None
    exact: bool = True

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"unknown scaling: {self.method}")

    def fit(self, df: DataFrame) -> list[Action]:
        hidden = hidden_sources(df)
        sources = {c: hidden.get(c, c) for c in self._bases(df, hidden)}
        if not sources:
            raise StepRefused("no numeric columns to scale")
        require_numeric(df, sources.values())
        taken = [f"_{c}" for c, s in sources.items() if c == s and f"_{c}" in df.columns]
        if taken:
            raise StepRefused(f"the hidden source needs a free name: {', '.join(taken)}")
        fitted = self._fit_affine(df, list(sources.values())) if self.method in _FITTED else {}
        return [
            Action("scale", c, self._detail(fitted.get(s)), self._scaling(c, s, fitted.get(s)))
            for c, s in sources.items()
        ]

    def _bases(self, df: DataFrame, hidden: dict[str, str]) -> list[str]:
        names_of = {present: base for base, present in hidden.items()}
        if self.columns is None and self.column == ALL:
            return [
                names_of.get(c, c)
                for c in numeric_columns(df)
                if not c.endswith(SCALED_SUFFIX)
            ]
        names = list(self.columns) if self.columns is not None else [self.column]
        for c in names:
            if c in names_of or c.endswith(SCALED_SUFFIX):
                raise StepRefused(f"{c} belongs to a column that is already scaled")
        return names

    def _fit_affine(self, df: DataFrame, sources: list[str]) -> dict[str, tuple | None]:
        """(shift, spread) per column; None where it has no values."""
        exprs = []
        for s in sources:
            x = double(col(s))
            outline = outline_expressions(s)
            if self.method != "robust" or not self.exact:
                outline[3] = F.lit(None)
            exprs += [
                F.count_if(F.abs(x) == F.lit(float("inf"))), *outline, F.avg(x), F.stddev_pop(x),
            ]
        row = df.agg(*exprs).first()
        stats = {s: row[7 * i : 7 * i + 7] for i, s in enumerate(sources)}
        bad = [s for s, found in stats.items() if found[0]]
        if bad:
            raise StepRefused(f"infinite values in {', '.join(bad)}")
        if self.method == "robust":
            known = {s: Outline(*found[1:5]) for s, found in stats.items()}
            quartiles = quantiles(df, sources, [0.25, 0.5, 0.75], exact=self.exact, known=known)
        fitted: dict[str, tuple | None] = {}
        for s, (_, n, low, high, _, mean, sd) in stats.items():
            if not n:
                fitted[s] = None
            elif self.method == "standard":
                fitted[s] = (mean, 1.0 if low == high else sd)
            elif self.method == "minmax":
                fitted[s] = (low, (high - low) or 1.0)
            else:
                q1, median, q3 = quartiles[s]
                fitted[s] = (median, (q3 - q1) or 1.0)
        return fitted

    def _detail(self, fitted: tuple | None) -> str:
        if self.method not in _FITTED:
            return self.method
        return f"{self.method}: no values" if fitted is None else (
            f"{self.method}: shift {fitted[0]}, spread {fitted[1]}"
        )

    def _expression(self, x: Column, fitted: tuple | None) -> Column:
        if self.method == "log":
            return F.log1p(floor_at_zero(x))
        if self.method == "sqrt":
            return F.sqrt(floor_at_zero(x))
        if fitted is None:
            return F.lit(None).cast("double")
        shift, spread = fitted
        return (x - F.lit(float(shift))) / F.lit(float(spread))

    def _scaling(
        self, base: str, source: str, fitted: tuple | None
    ) -> Callable[[DataFrame], DataFrame]:
        scaled_name = f"{base}{SCALED_SUFFIX}"
        hidden_name = source if source != base else f"_{base}"

        def apply(df: DataFrame) -> DataFrame:
            scaled = self._expression(double(col(source)), fitted).alias(scaled_name)
            kept = []
            for c in df.columns:
                if c == source:
                    kept.append(col(c).alias(hidden_name, metadata={HIDDEN_SOURCE: base}))
                else:
                    kept.append(scaled if c == scaled_name else col(c))
            if scaled_name not in df.columns:
                kept.append(scaled)
            return df.select(*kept)

        return apply

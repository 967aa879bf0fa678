"""Outlier treatment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, nan_to_null, numeric_columns, require_numeric
from rowmill.functions.scalars import clip, double
from rowmill.operators.profile import iqr_fences
from rowmill.operators.quantiles import Outline, outline_expressions, quantiles
from rowmill.plans.step import ALL, Action, Step, StepRefused, keeping, replacing, unchanged

METHODS = ("iqr_clip", "iqr_drop", "zscore_clip", "zscore_drop", "cap_pct")


@dataclass(frozen=True)
class TreatOutliers(Step):
    """Clip or drop outliers of one numeric column or of all.

    iqr_* uses the 1.5 IQR fences, zscore_* mean and `k` sample standard deviations, cap_pct the
    1st and 99th percentile. Dropping also removes rows without a value. With order="sequential"
    every column is fitted on the rows the earlier ones left; "joint" fits all on the input.
    """

    column: str = ALL
    method: str = "iqr_clip"
    k: float = 3.0
    order: str = "sequential"
    columns: Sequence[str] | None = None
    exact: bool = True

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"unknown outlier treatment: {self.method}")
        if self.order not in ("sequential", "joint"):
            raise ValueError(f"unknown order: {self.order}")

    def fit(self, df: DataFrame) -> list[Action]:
        if self.columns is not None:
            names = [c for c in self.columns if c in df.columns]
        else:
            names = numeric_columns(df) if self.column == ALL else [self.column]
        require_numeric(df, names)
        if not self.method.endswith("_drop"):
            # A clip leaves the other columns alone, so one fit serves all.
            return [self._clip(c, b) for c, b in self._bounds(df, names).items()]
        if self.order == "joint":
            return [self._drop(c, b) for c, b in self._bounds(df, names).items()]
        return self._drops_in_turn(df, names)

    def _drops_in_turn(self, df: DataFrame, names: Sequence[str]) -> list[Action]:
        """Each column's drop, fitted on the rows that the earlier ones leave.

        Quartiles of later columns are bracketed from one pass over the whole input, by as many ranks more as
        rows may be gone by then, so each column costs one pass of counting.
        """
        outlined = self.method == "iqr_drop" and self.exact and len(names) > 1
        known, rows = {}, 0
        if outlined:
            exprs = [e for c in names for e in outline_expressions(c)]
            rows, *row = nan_to_null(df.select(*[col(c) for c in names])).agg(F.count(F.lit(1)), *exprs).first()
            known = {c: Outline(*row[4 * i : 4 * i + 4]) for i, c in enumerate(names)}
        actions, dropped = [], 0
        for c in names:
            if outlined:
                found = quantiles(df, [c], [0.25, 0.75], known=known, dropped=dropped)
                bounds = self._range(*found[c])
            else:
                bounds = self._bounds(df, [c])[c]
            action = self._drop(c, bounds)
            df = action.apply(df)
            actions.append(action)
            if outlined:
                dropped += rows - known[c].n + known[c].outside(*bounds)
        return actions

    def _bounds(self, df: DataFrame, names: Sequence[str]) -> dict[str, tuple | None]:
        """(low, high), or (mean, distance) for zscore_drop; None where they are undefined."""
        if not names:
            return {}
        if self.method.startswith("zscore"):
            exprs = [f(double(col(c))) for c in names for f in (F.avg, F.stddev_samp)]
            row = df.agg(*exprs).first()
            bounds: dict[str, tuple | None] = {}
            for i, c in enumerate(names):
                mean, sd = row[2 * i], row[2 * i + 1]
                if sd is None:
                    bounds[c] = None
                elif self.method == "zscore_drop":
                    bounds[c] = (mean, self.k * sd)
                else:
                    bounds[c] = (mean - self.k * sd, mean + self.k * sd)
            return bounds
        probs = [0.01, 0.99] if self.method == "cap_pct" else [0.25, 0.75]
        found = quantiles(df, names, probs, exact=self.exact)
        return {c: self._range(*found[c]) for c in names}

    def _range(self, low: float | None, high: float | None) -> tuple | None:
        if low is None:
            return None
        return (low, high) if self.method == "cap_pct" else iqr_fences(low, high)

    def _clip(self, c: str, bounds: tuple | None) -> Action:
        if bounds is None:
            return Action("outliers", c, f"{self.method}: too few values", unchanged)
        low, high = bounds
        detail = f"{self.method}: [{low}, {high}]"
        return Action("outliers", c, detail, replacing({c: clip(double(col(c)), low, high)}))

    def _drop(self, c: str, bounds: tuple | None) -> Action:
        if bounds is None:
            raise StepRefused(f"{self.method} on {c}: too few values, every row would go")
        a, b = bounds
        x = double(col(c))
        keep: Column = F.abs(x - a) <= b if self.method == "zscore_drop" else x.between(a, b)
        return Action("outliers", c, f"{self.method}: {a}, {b}", keeping(keep), drops_rows=True)

"""Cleaning steps: fit once, apply anywhere.

`fit` runs a few aggregations and returns actions that hold plain numbers or a written code table.
Applying them is lazy: projections, filters and, for wide encodings only, a join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from rowmill.functions.columns import existing, nan_to_null, replace_columns

ALL = "_all_"


class StepRefused(ValueError):
    """The step cannot be applied to this table; nothing was changed."""


@dataclass(frozen=True)
class Action:
    """One fitted change with the line it leaves in the log."""

    op: str
    column: str | None
    detail: str
    apply: Callable[[DataFrame], DataFrame] = field(repr=False)
    drops_rows: bool = False


class Step:
    """A parameterised change of a table."""

    def fit(self, df: DataFrame) -> list[Action]:
        raise NotImplementedError

    def run(self, df: DataFrame) -> DataFrame:
        """Fit and apply in one go."""
        df = nan_to_null(df)
        return apply_actions(df, self.fit(df))


def apply_actions(df: DataFrame, actions: Sequence[Action]) -> DataFrame:
    for action in actions:
        df = action.apply(df)
    return df


def unchanged(df: DataFrame) -> DataFrame:
    return df


def replacing(changes: dict[str, Column]) -> Callable[[DataFrame], DataFrame]:
    """Apply a set of column expressions as one projection."""

    def apply(df: DataFrame) -> DataFrame:
        return replace_columns(df, changes)

    return apply


def keeping(condition: Column) -> Callable[[DataFrame], DataFrame]:
    """Keep the rows for which the condition is true; NULL drops the row."""

    def apply(df: DataFrame) -> DataFrame:
        return df.filter(condition)

    return apply


def dropping(names: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    def apply(df: DataFrame) -> DataFrame:
        return df.drop(*existing(df, names))

    return apply

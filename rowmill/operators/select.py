"""Column selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rowmill.functions.columns import (
    col,
    existing,
    hidden_columns,
    is_internal,
    require_columns,
    visible_columns,
)
from rowmill.plans.step import Action, Step, StepRefused, dropping


@dataclass(frozen=True)
class KeepColumns(Step):
    """Keep only the given columns, in the given order; at least one."""

    columns: Sequence[str]

    def fit(self, df: DataFrame) -> list[Action]:
        names = require_columns(df, dict.fromkeys(self.columns))
        if not names:
            raise StepRefused("at least one column must be kept")
        gone = len(visible_columns(df)) - len(names)

        def apply(target: DataFrame) -> DataFrame:
            internal = [c for c in target.columns if is_internal(c) and c not in names]
            return target.select(*[col(c) for c in [*names, *internal]])

        return [Action("keep", None, f"kept {len(names)}, dropped {gone}", apply)]


@dataclass(frozen=True)
class DropTemporary(Step):
    """Remove the columns whose name starts with '_'."""

    def fit(self, df: DataFrame) -> list[Action]:
        names = hidden_columns(df)
        if not names:
            return []
        return [Action("drop_temporary", None, f"dropped {len(names)}", dropping(names))]


@dataclass(frozen=True)
class DropColumns(Step):
    """Remove the given columns; names that are absent are ignored."""

    columns: Sequence[str]

    def fit(self, df: DataFrame) -> list[Action]:
        names = existing(df, self.columns)
        if not names:
            return []
        return [Action("drop", None, f"dropped {', '.join(names)}", dropping(names))]


def realign(current: DataFrame, prior: DataFrame, column: str, key: str) -> DataFrame:
    """Put the values of an earlier table back into one column, matched on the row key.

    Rows that were dropped since stay dropped. A pipeline restores without this join, as it carries
    the prior values along; use it where only a saved table is at hand. A key that `prior` holds twice
    is refused, as it would multiply rows.
    """
    require_columns(current, [column, key])
    require_columns(prior, [column, key])
    old = prior.where(col(key).isNotNull()).select(col(key), col(column).alias("__old"))
    twice = old.groupBy(col(key)).count().where("count > 1").first()
    if twice is not None:
        raise StepRefused(f"{key}: {twice[0]} is the key of {twice[1]} rows of the prior table")
    joined = current.join(old, key, "left")
    return joined.select(
        *[col("__old").alias(column) if c == column else col(c) for c in current.columns]
    )

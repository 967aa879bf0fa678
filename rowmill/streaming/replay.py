"""Fitted steps on rows that arrive later.

There is no operator of its own here: a fitted action is a projection or a filter with plain
numbers, so it applies to a streaming DataFrame as it does to a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rowmill.functions.columns import PRIOR_PREFIX, nan_to_null
from rowmill.plans.step import Action, apply_actions


def replay(df: DataFrame, actions: Sequence[Action]) -> DataFrame:
    """Apply fitted changes to other rows of the same schema, batch or streaming."""
    out = apply_actions(nan_to_null(df), actions)
    return out.drop(*[c for c in out.columns if c.startswith(PRIOR_PREFIX)])

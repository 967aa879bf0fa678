"""An ordered, logged sequence of cleaning steps over one table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rowmill.functions.columns import (
    PRIOR_PREFIX,
    col,
    dtype_name,
    nan_to_null,
    replace_columns,
)
from rowmill.operators.profile import run_summary, table_status
from rowmill.operators.retype import Retype
from rowmill.plans.step import Action, Step, StepRefused


@dataclass(frozen=True)
class LogLine:
    op: str
    column: str | None
    detail: str
    rows_before: int | None = None
    rows_after: int | None = None
    counts: bool = False


def _keeping(column: str) -> Action:
    def keep(df: DataFrame) -> DataFrame:
        return df.withColumn(PRIOR_PREFIX + column, col(column))

    return Action("keep", column, "values from before the retype", keep)


def _restoring(column: str) -> Action:
    def restore(df: DataFrame) -> DataFrame:
        prior = PRIOR_PREFIX + column
        return replace_columns(df, {column: col(prior)}).drop(prior)

    return Action("restore", column, "values from before the retype", restore)


class Pipeline:
    """The current table as a lazy plan over the source, with the steps that led to it.

    A step is fitted when it is applied. It changes the table as a whole or, on an error, not at
    all. NaN counts as missing from the start. `count_rows=False` saves the counting jobs of steps
    that drop rows.
    """

    def __init__(self, source: DataFrame, label: str = "table", count_rows: bool = True) -> None:
        self.source = nan_to_null(source)
        self.label = label
        self._count_rows = count_rows
        self._start(f"loaded {label}")

    def _start(self, detail: str) -> None:
        self._plan = self.source
        self._lines = [LogLine("load", None, detail)]
        self._priors: dict[str, str] = {}
        self._actions: list[Action] = []

    @property
    def current(self) -> DataFrame:
        return self._visible(self._plan)

    @property
    def retyped(self) -> dict[str, str]:
        """Columns whose type was changed by hand -> the type they had."""
        return dict(self._priors)

    @property
    def actions(self) -> list[Action]:
        """The fitted changes since the source; rowmill.replay applies them to other rows."""
        return list(self._actions)

    @staticmethod
    def _visible(plan: DataFrame) -> DataFrame:
        return plan.drop(*[c for c in plan.columns if c.startswith(PRIOR_PREFIX)])

    def apply(self, step: Step) -> Pipeline:
        try:
            actions = step.fit(self.current)
        except StepRefused as refused:
            self._lines.append(LogLine("refused", getattr(step, "column", None), str(refused)))
            raise
        plan, priors, kept = self._plan, dict(self._priors), []
        if isinstance(step, Retype) and actions and step.column not in priors:
            # Carry the values from before the first retype along, so that restoring is no join.
            priors[step.column] = dtype_name(plan.schema[step.column].dataType)
            keep = _keeping(step.column)
            plan, kept = keep.apply(plan), [keep]
        lines = []
        for action in actions:
            plan = action.apply(plan)
            lines.append(LogLine(action.op, action.column, action.detail, counts=action.drops_rows and self._count_rows))
        # Nothing of the pipeline changes before the whole step has worked.
        self._plan, self._priors = plan, priors
        self._lines += lines
        self._actions += kept + actions
        if isinstance(step, Retype):
            self._forget_if_back(step.column)
        return self

    def _forget_if_back(self, column: str) -> None:
        if column in self._priors:
            if dtype_name(self._plan.schema[column].dataType) == self._priors[column]:
                self._forget(column)

    def _forget(self, column: str) -> None:
        self._plan = self._plan.drop(PRIOR_PREFIX + column)
        del self._priors[column]

    def restore(self, column: str) -> Pipeline:
        """Undo the retypes of a column on the rows that are left, and later edits of it too."""
        if column not in self._priors or column not in self._plan.columns:
            return self
        action = _restoring(column)
        self._plan = action.apply(self._plan)
        del self._priors[column]
        self._actions.append(action)
        self._lines.append(LogLine(action.op, column, action.detail))
        return self

    def reset(self) -> Pipeline:
        """Back to the source; the log starts anew."""
        self._start("reset to the original")
        return self

    def _counted(self) -> list[LogLine]:
        """The lines with the rows before and after the steps that drop some.

        One job over the fitted changes counts for all of them: each is observed on both sides.
        """
        waiting = [k for k, l in enumerate(self._lines) if l.counts and l.rows_before is None]
        if waiting:
            plan, seen = self.source, []
            for action in self._actions:
                if not (action.drops_rows and self._count_rows):
                    plan = action.apply(plan)
                    continue
                sides = Observation(), Observation()
                plan = action.apply(plan.observe(sides[0], F.count(F.lit(1)).alias("n")))
                plan = plan.observe(sides[1], F.count(F.lit(1)).alias("n"))
                seen.append(sides)
            plan.select(F.lit(1)).write.format("noop").mode("overwrite").save()
            found = [[side.get["n"] for side in sides] for sides in seen]
            of_lines = [k for k, l in enumerate(self._lines) if l.counts]
            for k, (before, after) in zip(of_lines, found):
                self._lines[k] = replace(self._lines[k], rows_before=before, rows_after=after)
        return self._lines

    def log(self) -> DataFrame:
        """The steps so far. Rows are counted here, by one job for all steps that drop some."""
        lines = self._counted()
        rows = [
            (i, l.op, l.column, l.detail, l.rows_before, l.rows_after)
            for i, l in enumerate(lines)
        ]
        return self.source.sparkSession.createDataFrame(
            rows,
            "step_no int, op string, column string, detail string, rows_before bigint, "
            "rows_after bigint",
        )

    def status(self) -> DataFrame:
        return table_status(self.current, len(self._lines))

    def summary(self) -> DataFrame:
        return run_summary(self.source, self.current, len(self._lines))

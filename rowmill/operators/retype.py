"""Conversion of a column to one of the four user-visible types."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import ROW_ID, col, dtype_name, require_columns
from rowmill.functions.scalars import (
    DATETIME_FORMATS,
    exact_integer,
    format_bits,
    integer_like,
    numeric_null_token,
    to_datetime,
    to_numeric_flexible,
)
from rowmill.plans.step import Action, Step, StepRefused, replacing

TARGETS = ("int64", "float64", "object", "datetime64[ns]")

SAMPLES = 3


def invalid_samples(df: DataFrame, column: str, invalid: Column) -> list[str]:
    """Up to three distinct offending values, in order of appearance where rows have an id."""
    bad = df.filter(invalid)
    value = col(column).cast("string").alias("value")
    if ROW_ID in df.columns:
        seen = bad.groupBy(value).agg(F.min(col(ROW_ID)).alias("at")).orderBy("at")
    else:
        seen = bad.select(value).distinct().orderBy("value")
    return [r["value"] for r in seen.limit(SAMPLES).collect()]


@dataclass(frozen=True)
class Retype(Step):
    """Convert a column to int64, float64, object (text) or datetime64[ns].

    The step is refused, with examples, when a value does not fit. Text numbers may use a decimal
    comma. Null tokens in text are valid missing values, or offending ones with
    `strict_tokens=True`. An int64 value may differ from a whole number by `atol` plus `rtol`
    times its size. Text becomes a timestamp by the one of `formats` that fits all values; if several
    do, the first of them counts (with `day_first` the first with the day before the month), and
    the log names the others. `mixed=True` lets every value choose. Numbers are nanoseconds since 1970.
    """

    column: str
    target: str
    formats: Sequence[str] = tuple(DATETIME_FORMATS)
    rtol: float = 0.0
    atol: float = 1e-8
    strict_tokens: bool = False
    day_first: bool = False
    mixed: bool = False

    def __post_init__(self) -> None:
        if self.target not in TARGETS:
            raise ValueError(f"unsupported type: {self.target}")

    def fit(self, df: DataFrame) -> list[Action]:
        require_columns(df, [self.column])
        data_type = df.schema[self.column].dataType
        before = dtype_name(data_type)
        if before == self.target:
            return []
        detail = f"{before} -> {self.target}"
        if self.target == "datetime64[ns]" and isinstance(data_type, T.StringType) and not self.mixed:
            fmt, others = self._one_format(df)
            converted = self._moment(df, [fmt])
            detail += f" by {fmt}" + (f", {', '.join(others)} would fit as well" if others else "")
        else:
            converted = self._checked(df)
        return [Action("retype", self.column, detail, replacing({self.column: converted}))]

    def _checked(self, df: DataFrame) -> Column:
        x, data_type = col(self.column), df.schema[self.column].dataType
        if self.target == "object":
            return x.cast("string")
        if self.target == "datetime64[ns]":
            moment = self._moment(df, self._formats())
            self._refuse_invalid(df, x.isNotNull() & moment.isNull(), "not a date")
            return moment
        number = to_numeric_flexible(x, data_type)
        invalid = x.isNotNull() & number.isNull()
        if not self.strict_tokens:
            invalid = invalid & ~numeric_null_token(x, data_type)
        exact = exact_integer(x, data_type)
        whole = F.coalesce(exact, F.rint(number).try_cast("bigint"))
        fractional = exact.isNull() & (~integer_like(number, self.rtol, self.atol) | whole.isNull())
        if self.target == "float64":
            self._refuse_invalid(df, invalid, "not a number")
            return number
        bad, uneven = df.agg(
            F.count_if(invalid), F.count_if(number.isNotNull() & fractional)
        ).first()
        if bad:
            self._refuse(df, invalid, bad, "not a number")
        if uneven:
            self._refuse(df, number.isNotNull() & fractional, uneven, "not a whole number")
        return whole

    def _formats(self) -> list[str]:
        """The formats to try, those with the day before the month first if wanted."""
        formats = list(dict.fromkeys(self.formats))
        return sorted(formats, key=lambda f: not 0 <= f.find("d") < f.find("M")) if self.day_first else formats

    def _moment(self, df: DataFrame, formats: Sequence[str]) -> Column:
        return to_datetime(col(self.column), df.schema[self.column].dataType, formats)

    def _one_format(self, df: DataFrame) -> tuple[str, list[str]]:
        """The format that fits all values, and others that would.

        Every value has the set of formats it fits, as bits; few sets differ, so counts of sets are all
        that is collected. Their intersection decides.
        """
        formats = self._formats()
        if len(formats) > 62:
            raise ValueError("at most 62 formats can be told apart")
        bits = format_bits(F.trim(col(self.column)), formats).alias("bits")
        sets = df.where(col(self.column).isNotNull()).select(bits).groupBy("bits").count().collect()
        every = (1 << len(formats)) - 1
        for row in sets:
            every &= row.bits
        fits = [f for k, f in enumerate(formats) if every >> k & 1]
        if fits:
            return fits[0], fits[1:] if sets else []
        counts = [sum(r["count"] for r in sets if r.bits >> k & 1) for k in range(len(formats))]
        best = counts.index(max(counts))
        moment = self._moment(df, [formats[best]])
        reason = f"not a date by {formats[best]}, which fits most" if counts[best] else "not a date"
        self._refuse(df, col(self.column).isNotNull() & moment.isNull(), sum(r["count"] for r in sets) - counts[best], reason)

    def _refuse_invalid(self, df: DataFrame, invalid: Column, reason: str) -> None:
        bad = df.agg(F.count_if(invalid)).first()[0]
        if bad:
            self._refuse(df, invalid, bad, reason)

    def _refuse(self, df: DataFrame, invalid: Column, bad: int, reason: str) -> None:
        examples = ", ".join(invalid_samples(df, self.column, invalid))
        raise StepRefused(f"{self.column}: {bad} values, {reason}, for example {examples}")

"""Writing and looking at tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import ROW_ID, col, nan_to_null, require_columns, visible_columns

PREVIEW_ROWS = 8


def write_csv(df: DataFrame, path: str, single_file: bool = False, separator: str = ",") -> None:
    """Write with a header line and without the row id, as a folder of part files.

    `single_file` sends the whole table through one task: for tables one machine can hold.
    """
    out = df.select(*[col(c) for c in visible_columns(df)])
    if single_file:
        out = out.coalesce(1)
    out.write.csv(path, sep=separator, header=True, escape='"', emptyValue="", nullValue="")


@dataclass(frozen=True)
class Preview:
    rows: DataFrame
    shown: int
    total: int
    columns: int


def preview_rows(df: DataFrame, n: int = PREVIEW_ROWS, key: str | None = None) -> DataFrame:
    """The first n rows as text, in key order, with NaN for missing values."""
    if key is None and ROW_ID in df.columns:
        key = ROW_ID
    first = df
    if key is not None:
        require_columns(df, [key])
        first = df.orderBy(col(key))
    first = nan_to_null(first.limit(n))
    return first.select(
        *[F.coalesce(col(c).cast("string"), F.lit("NaN")).alias(c) for c in visible_columns(df)]
    )


def preview(df: DataFrame, n: int = PREVIEW_ROWS, key: str | None = None) -> Preview:
    """preview_rows with the counts of its footer."""
    total = df.count()
    return Preview(preview_rows(df, n, key), min(n, total), total, len(visible_columns(df)))

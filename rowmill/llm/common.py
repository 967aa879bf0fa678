"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Words of the benchmark and licence operators, after lower-casing: digits, a-z, anything not ASCII.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; NULL is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text: lower-cased and split at WORD_GAP, so neither case nor punctuation counts."""
    return F.array_remove(F.split(lower_ascii(text), WORD_GAP, -1), "")


def row_key(*columns: str) -> list[Column]:
    """128 bits that name a row by content; equal rows share them, and no part is NULL."""
    return [
        F.xxhash64(*columns).alias("_k1"),
        F.xxhash64(F.lit(1), *reversed(columns)).alias("_k2"),
    ]


def with_columns(df: DataFrame, row: str, columns: dict[str, Column]) -> DataFrame:
    """The fields of struct `row` and new columns, which replace fields of the same name."""
    taken = {c.lower() for c in columns}
    kept = [
        F.col(row).getField(f).alias(f) for f in df.schema[row].dataType.names if f.lower() not in taken
    ]
    return df.select(*kept, *[c.alias(n) for n, c in columns.items()])

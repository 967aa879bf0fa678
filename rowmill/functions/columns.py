"""Column references, column classes and schema-only selections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_ID = "_row_id"

# Marks the column that a scaling step hid: its value is the name the column had before.
HIDDEN_SOURCE = "rowmill.hidden_source_of"

# Columns that carry the values from before a retype, see plans.pipeline.
PRIOR_PREFIX = "__prior__"

SCALED_SUFFIX = "_scaled"
ENCODED_SUFFIX = "_encoded"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a column by its literal name, whatever characters it holds."""
    return F.col(quoted(name))


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType) and not isinstance(data_type, T.DecimalType)


def is_fractional(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def is_datetime(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampNTZType, T.TimestampType, T.DateType))


def is_atomic(data_type: T.DataType) -> bool:
    return not isinstance(
        data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)
    )


def is_internal(name: str) -> bool:
    return name == ROW_ID or name.startswith(PRIOR_PREFIX)


def visible_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not is_internal(c)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType) and not is_internal(f.name)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and not is_internal(f.name)
    ]


def column_class(data_type: T.DataType) -> str:
    """'num' for numbers, 'cat' for everything else: the label shown in column reports."""
    return "num" if is_numeric(data_type) else "cat"


def dtype_name(data_type: T.DataType) -> str:
    """One of int64, float64, object, datetime64[ns]; other types keep their Spark name."""
    if is_fractional(data_type):
        return "float64"
    if is_numeric(data_type):
        return "int64"
    if isinstance(data_type, T.StringType):
        return "object"
    if is_datetime(data_type):
        return "datetime64[ns]"
    if isinstance(data_type, T.BooleanType):
        return "bool"
    return data_type.simpleString()


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [n for n in names if n in present]


def require_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    names = list(names)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return names


def require_numeric(df: DataFrame, names: Iterable[str]) -> list[str]:
    names = require_columns(df, names)
    bad = [n for n in names if not is_numeric(df.schema[n].dataType)]
    if bad:
        raise ValueError(f"not numeric: {', '.join(bad)}")
    return names


def is_temporary(name: str) -> bool:
    return name.startswith("_") and not is_internal(name)


def suggested_columns(df: DataFrame) -> list[str]:
    """Columns worth keeping: every visible one whose name does not start with '_'."""
    return [c for c in visible_columns(df) if not is_temporary(c)]


def hidden_columns(df: DataFrame) -> list[str]:
    return [c for c in visible_columns(df) if is_temporary(c)]


def scaled_columns(df: DataFrame) -> list[str]:
    return [c for c in numeric_columns(df) if c.endswith(SCALED_SUFFIX)]


def raw_columns(df: DataFrame) -> list[str]:
    return [c for c in numeric_columns(df) if not c.endswith(SCALED_SUFFIX)]


def default_picks(df: DataFrame) -> dict[str, list[str]]:
    """Columns preselected for exploration, encoding views and box plots."""
    numeric, categorical = numeric_columns(df), categorical_columns(df)
    return {"numeric": numeric[:3], "categorical": categorical[:3], "box": numeric[:6]}


def hidden_sources(df: DataFrame) -> dict[str, str]:
    """Original name -> present name of the columns hidden by scaling."""
    return {
        f.metadata[HIDDEN_SOURCE]: f.name for f in df.schema if HIDDEN_SOURCE in (f.metadata or {})
    }


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: NaN becomes NULL in every float and double column."""
    floats = {f.name for f in df.schema if is_fractional(f.dataType)}
    if not floats:
        return df
    return df.select(
        *[
            F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name, metadata=f.metadata or {})
            if f.name in floats
            else col(f.name)
            for f in df.schema
        ]
    )


def replace_columns(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace columns in place and append new ones, as one projection."""
    kept = [
        changes[f.name].alias(f.name, metadata=f.metadata or {})
        if f.name in changes
        else col(f.name)
        for f in df.schema
    ]
    added = [e.alias(c) for c, e in changes.items() if c not in df.columns]
    return df.select(*kept, *added)

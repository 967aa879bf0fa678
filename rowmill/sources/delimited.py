"""Delimited text files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import ROW_ID, col
from rowmill.functions.scalars import parse_integer, parse_number
from rowmill.plans.storage import materialise
from rowmill.sources.records import FILE, PLACE, Records, field_count

# Choices of the separator menu; the last one stands for a text of one's own.
SEPARATORS = {"comma": ",", "semicolon": ";", "tab": "\t", "custom": "|"}
DEFAULT_SEPARATOR = ";"

# Text read as a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Encodings Spark can read, by the names users give them.
ENCODINGS = {
    "utf-8": "UTF-8", "utf8": "UTF-8", "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1", "iso8859-1": "ISO-8859-1", "ascii": "US-ASCII",
    "us-ascii": "US-ASCII", "utf-16": "UTF-16", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE",
    "utf-32": "UTF-32",
}
FALLBACK = "latin1"

# Line ends of these take more than one byte, so Spark cannot cut their files into lines.
WIDE_CHARSETS = ("UTF-16", "UTF-16LE", "UTF-16BE", "UTF-32")

# Different first lines that the files of one table may have.
HEADERS = 1000

_SURPLUS, _AT = "__surplus", "__at"


@dataclass(frozen=True)
class Loaded:
    """A table read from text, with the options that were in effect."""

    df: DataFrame
    path: str
    separator: str
    header: bool
    encoding: str

    def record(self) -> DataFrame:
        """One row: resolved options, rows and columns."""
        names = [c for c in self.df.columns if c != ROW_ID]
        return self.df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(self.path).alias("path"),
            F.lit(self.separator).alias("separator"),
            F.lit("infer" if self.header else "none").alias("header"),
            F.lit(self.encoding).alias("encoding"),
            "rows",
            F.lit(len(names)).cast("long").alias("columns"),
        )

    def log_lines(self) -> list[str]:
        """The two lines a fresh log starts with."""
        row = self.record().first()
        header = "inferred" if self.header else "none"
        return [
            f"loaded {self.path} ({row['rows']} rows x {row['columns']} columns)",
            f"separator {self.separator!r} | header {header} | encoding {self.encoding}",
        ]


def resolve_separator(choice: str | None, custom: str | None = None) -> str:
    """A menu choice or a literal separator; an empty custom text means '|'."""
    if not choice:
        return DEFAULT_SEPARATOR
    if choice == "custom":
        return custom or SEPARATORS["custom"]
    return SEPARATORS.get(choice, choice)


def encodings_to_try(encoding: str | None) -> list[str]:
    """The wanted encoding, utf-8 and latin1, without names that Spark cannot read."""
    wanted = (encoding or "utf-8").lower().replace("_", "-")
    names = dict.fromkeys([wanted, "utf-8", FALLBACK])
    return [n for n in names if n in ENCODINGS]


def _unique_names(names: Sequence[str | None]) -> list[str]:
    """Header names made usable: empty ones are numbered, repeated ones get .1, .2, ...

    Names that differ by case alone count as repeated, as Spark would not tell them apart.
    """
    taken: set[str] = set()
    out = []
    for i, name in enumerate(names):
        name = name if name else f"Unnamed: {i}"
        candidate, again = name, 0
        while candidate.lower() in taken:
            again += 1
            candidate = f"{name}.{again}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def _integer(text: Column) -> Column:
    return parse_integer(text)


def _real(text: Column) -> Column:
    return parse_number(F.trim(text))


def _truth(text: Column) -> Column:
    # Spark itself would also take yes, t and 1.
    return F.when(F.lower(text).isin("true", "false"), text.try_cast("boolean"))


def _type_tests(names: Sequence[str]) -> list[Column]:
    tests = []
    for c in names:
        x = col(c)
        tests += [
            F.coalesce(F.bool_and(x.isNull() | _integer(x).isNotNull()), F.lit(True)),
            F.coalesce(F.bool_and(x.isNull() | _real(x).isNotNull()), F.lit(True)),
            F.coalesce(F.bool_and(F.coalesce(_truth(x).isNotNull(), F.lit(False))), F.lit(False)),
            F.count(x),
        ]
    return tests


def _typed(text: DataFrame, names: Sequence[str], found: Sequence) -> list[Column]:
    """A column is int64, float64, bool (without gaps) or text, the first that fits all values."""
    out = []
    for i, c in enumerate(names):
        whole, real, truth, n = found[4 * i : 4 * i + 4]
        x = col(c)
        if not n:
            out.append(F.lit(None).cast("double").alias(c))
        elif whole:
            out.append(_integer(x).alias(c))
        elif real:
            out.append(_real(x).alias(c))
        elif truth:
            out.append(_truth(x).alias(c))
        else:
            out.append(x.alias(c))
    return out


def infer_types(df: DataFrame) -> DataFrame:
    """Give text columns the type all their values fit, in one pass over the table."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    typed = dict(zip(names, _typed(df, names, df.agg(*_type_tests(names)).first())))
    return df.select(*[typed.get(c, col(c)) for c in df.columns])


def _without_tokens(x: Column) -> Column:
    return F.when(~x.isin(NULL_TOKENS), x)


def _with_fields(rows: DataFrame, separator: str, width: int) -> tuple[DataFrame, list[Column]]:
    """rows, parsed once by the rules of quoted text, and the fields of their records."""
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    # A quoted carriage return or line feed stays as it is.
    options = {"sep": separator, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    # A column of its own, so that no field parses the record again.
    rows = rows.withColumn("__parsed", F.from_csv("value", schema.simpleString(), options))
    return rows, [F.col("__parsed")[f"f{i}"] for i in range(width)]


def _head_fields(spark: SparkSession, heads: Sequence[str], separator: str, regex: bool) -> list[list[str | None]]:
    """The fields of first records, split as all others are."""
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "i int, value string")
    if regex:
        rows = rows.select("i", F.split("value", separator, -1).alias("fields"))
    else:
        width = rows.agg(F.max(field_count(F.col("value"), separator))).first()[0]
        own = field_count(F.col("value"), separator)
        rows, fields = _with_fields(rows, separator, width)
        rows = rows.select("i", F.slice(F.array(*fields), F.lit(1), own).alias("fields"))
    return [r.fields for r in rows.orderBy("i").collect()]


def _orders(names: list[list[str]], files: list[str]) -> list[list[int]]:
    """Where each header's file has the columns of the first one."""
    out = []
    for own, file in zip(names, files):
        if sorted(own) != sorted(names[0]):
            raise ValueError(f"the columns of {file} differ from those of {files[0]}: {own}, not {names[0]}")
        out.append([own.index(n) for n in names[0]])
    return out


def _wide_fields(
    spark: SparkSession, path: str | Sequence[str], separator: str, header: bool, charset: str
) -> tuple[DataFrame, list[str | None]]:
    """Rows of files whose line ends take more than a byte, which Spark reads whole; and the first line."""
    row = spark.read.csv(path, sep=separator, encoding=charset, header=False, inferSchema=False, multiLine=True).first()
    first = list(row) if row is not None else []
    fields = [T.StructField(f"__{i}", T.StringType()) for i in range(len(first))]
    text = spark.read.csv(
        path, schema=T.StructType([*fields, T.StructField(_SURPLUS, T.StringType())]), sep=separator,
        encoding=charset, header=header, enforceSchema=True, mode="PERMISSIVE", multiLine=True, escape='"',
    )
    return text.withColumn(_SURPLUS, F.col(_SURPLUS).isNotNull()), first


def _narrow_fields(
    spark: SparkSession, path: str | Sequence[str], separator: str, header: bool, encodings: list[str], regex: bool
) -> tuple[DataFrame, list[str | None], str]:
    """Rows of all other files, in reading order by __at; the first line; the encodings in use."""
    records = Records(spark, path, None if regex else separator, {n: ENCODINGS[n] for n in encodings})
    heads = records.heads(None if regex else separator, HEADERS + 1 if header else 1)
    if not heads:
        raise ValueError(f"no columns to read in {path}")
    if len(heads) > HEADERS:
        raise ValueError(f"more than {HEADERS} different first lines in {path}")
    fields = _head_fields(spark, [h for h, _ in heads], separator, regex)
    first, width = fields[0], len(fields[0])
    rows, value = records.rows, F.col("value")
    if regex:
        split = F.split(value, separator, -1)
        own, count = [F.get(split, i) for i in range(width)], F.size(split)
    else:
        (rows, own), count = _with_fields(rows, separator, width), field_count(value, separator)
    if header:
        orders = _orders([_unique_names(f) for f in fields], [f for _, f in heads])
        distinct = sorted(set(map(tuple, orders)))
        if len(distinct) > 1:
            names = {i: o for i, o in enumerate(distinct)}
            kinds = [(h, distinct.index(tuple(o))) for (h, _), o in zip(heads, orders)]
            rows = rows.join(_header_kinds(spark, records, kinds), FILE)
            own = [_by_kind([own[o[k]] for o in names.values()]) for k in range(width)]
        rows = rows.where(~records.is_first())
    at = F.struct(FILE, *PLACE).alias(_AT)
    text = rows.select(*[c.alias(f"__{i}") for i, c in enumerate(own)], (count > width).alias(_SURPLUS), at)
    return text, first, ", ".join(records.encodings())


def _header_kinds(spark: SparkSession, records: Records, kinds: list[tuple[str, int]]) -> DataFrame:
    """Each file and the number of its order of columns; the lists of both are short."""
    known = spark.createDataFrame(kinds, "value string, __kind int")
    first = records.rows.where(records.is_first()).select(FILE, "value")
    return materialise(first.join(F.broadcast(known), "value").select(FILE, "__kind"))


def _by_kind(columns: list[Column]) -> Column:
    return F.element_at(F.array(*columns), F.col("__kind") + 1)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    separator: str = DEFAULT_SEPARATOR,
    header: bool = True,
    encoding: str | None = "utf-8",
    regex_separator: bool = False,
    multiline: bool = True,
    infer: bool = True,
    row_id: bool = False,
) -> Loaded:
    """Read one file, a folder or a list of files of delimited text.

    Every file is read in the first encoding that all its bytes are valid in: the wanted one, utf-8,
    latin1. A row with more fields than the first one is an error, also if they are empty; a shorter one
    is filled with NULL. Files whose columns come in another order are read by name, other columns
    are an error. Without a header the columns are called "0", "1", ... Quoted fields may hold line breaks
    (a regular expression as separator knows no quotes); an open quote at the end of a file is an error. All
    this takes many tasks per file, but for UTF-16 and UTF-32, which are read by one each and alone.
    With `row_id` the table is written once with an id per row in reading order. `multiline` has no effect
    any more.
    """
    separator = resolve_separator(separator)
    tried = encodings_to_try(encoding)
    if ENCODINGS[tried[0]] in WIDE_CHARSETS:
        name = tried[0]
        if regex_separator:
            raise ValueError(f"a regular expression cannot separate {name}")
        text, first = _wide_fields(spark, path, separator, header, ENCODINGS[name])
        if not first:
            raise ValueError(f"no columns to read in {path}")
    else:
        text, first, name = _narrow_fields(spark, path, separator, header, tried, regex_separator)
    names = _unique_names(first) if header else [str(i) for i in range(len(first))]
    kept = [c for c in (_SURPLUS, _AT) if c in text.columns]
    cleaned = text.select(*[_without_tokens(F.col(f"__{i}")).alias(n) for i, n in enumerate(names)], *kept)
    # One pass answers both questions: are there longer rows, and which types fit.
    too_long, *found = cleaned.agg(F.count_if(F.col(_SURPLUS)), *(_type_tests(names) if infer else [])).first()
    if too_long:
        raise ValueError(f"{too_long} rows have more than {len(names)} fields")
    columns = _typed(cleaned, names, found) if infer else [col(n) for n in names]
    if row_id and _AT in kept:
        df = with_row_id(cleaned.select(*columns, _AT).orderBy(_AT)).drop(_AT)
    else:
        df = cleaned.select(*columns)
        df = with_row_id(df) if row_id else df
    shown = path if isinstance(path, str) else ", ".join(path)
    return Loaded(df, shown, separator, header, name)


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give every row an identity: a key column of its own, or an id in reading order.

    The id is assigned once and written, since a plan that recomputes it could number rows anew.
    """
    if key is not None:
        return df.withColumn(ROW_ID, col(key))
    return materialise(df.withColumn(ROW_ID, F.monotonically_increasing_id()))

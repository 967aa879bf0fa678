"""Shapes of date formats and guards before casts, against the casts and parsers themselves."""

import pytest
from pyspark.sql import functions as F

from rowmill.functions import scalars

TEXTS = [
    "1", "-1", "+1.5", "1e5", "1E-3", ".5", "5.", "1d", "1f", "0x1F", "nan", "NaN", "inf", "-Infinity", "+inf", "",
    " 7 ", "\t8", "1 2", "--1", "e", "1_000", "١", "infinit", "9223372036854775808", "1.0", "-", None,
]


def test_guards_lose_no_number(frame):
    df = frame([(t,) for t in TEXTS], "t string")
    plain = df.select("t", F.col("t").try_cast("double").alias("x"), F.col("t").try_cast("bigint").alias("n"))
    odd = {"1d", "1f", "0x1F", "nan", "NaN"}
    rows = plain.select("*", scalars.parse_number(F.col("t")).alias("y"), scalars.parse_integer(F.col("t")).alias("m")).collect()
    for r in rows:
        assert r.m == r.n, r
        assert (r.y is None) if r.t in odd else r.y == r.x, r


@pytest.mark.parametrize("fmt, text", [
    ("yyyy-MM-dd'T'HH:mm:ssXXX", "2024-01-01T10:30:00+02:00"), ("MMM d, yyyy", "Jan 5, 2024"), ("d MMM yyyy", "15 Dec 2024"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", "2024-01-01 10:30:00.123456"), ("yyyyMMdd", "20240131"), ("dd.MM.yyyy", "31.01.2024"),
    ("d MMMM yyyy", "1 January 2024"),
])
def test_shapes(frame, fmt, text):
    row = frame([(text,)], "t string").select(
        F.col("t").rlike(scalars.format_shape(fmt)).alias("own"), scalars.format_bits(F.col("t"), ["yyyy", fmt]).alias("bits"),
    ).first()
    assert row.own and row.bits == 2

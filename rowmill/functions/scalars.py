"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import col, is_fractional, is_numeric

# Text that stands for a missing number.
NUMERIC_NULL_TEXT = ["", "None", "nan", "NaN"]

# Formats tried, in order, when text becomes a timestamp.
DATETIME_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd/MM/yyyy",
    "MM-dd-yyyy",
    "dd-MM-yyyy",
    "dd.MM.yyyy",
    "yyyyMMdd",
    "MMM d yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
]


def double(x: Column) -> Column:
    return x.cast("double")


def clip(x: Column, low: float, high: float) -> Column:
    # greatest and least skip NULL, so an unguarded clip would fill missing values.
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def floor_at_zero(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def rounded(x: Column, digits: int | None) -> Column:
    """Half-even rounding for display; digits=None leaves the value alone."""
    return x if digits is None else F.bround(x, digits)


def percent(part: Column, whole: Column, digits: int | None) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    share = F.coalesce(F.try_divide(F.lit(100.0) * part, whole.cast("double")), F.lit(0.0))
    return rounded(share, digits)


def integer_like(x: Column, rtol: float, atol: float) -> Column:
    nearest = F.rint(x)
    return F.abs(x - nearest) <= F.lit(atol) + F.lit(rtol) * F.abs(nearest)


def parse_number(text: Column) -> Column:
    """Strict number parsing: NULL unless the whole text is a number or an infinity."""
    # Spark itself also accepts type suffixes such as '1d' and '1f', hexadecimal and NaN. A cast that
    # fails raises inside, so only text of the right characters is tried.
    number = text.try_cast("double")
    infinite = F.lower(F.ltrim(text, F.lit("+-"))).isin("inf", "infinity")
    return F.when(made_of(text, "0123456789+-.eE"), number).when(infinite, number)


def made_of(text: Column, characters: str) -> Column:
    """Whether a text holds these characters and blanks alone."""
    return F.translate(text, characters + " \t\r\n", "") == ""


def parse_integer(text: Column) -> Column:
    """A whole number written as one, as bigint; NULL otherwise."""
    return F.when(made_of(text, "0123456789+-"), text.try_cast("bigint"))


def number_text(x: Column) -> Column:
    """Text prepared for number parsing: trimmed, decimal comma turned into a point."""
    return F.replace(F.trim(x), F.lit(","), F.lit("."))


def to_numeric_flexible(x: Column, data_type: T.DataType) -> Column:
    """Any column as double; text may use a decimal comma, null tokens become NULL."""
    if isinstance(data_type, T.StringType):
        text = number_text(x)
        return F.when(~text.isin(NUMERIC_NULL_TEXT), parse_number(text))
    if is_fractional(data_type):
        return F.when(~F.isnan(x), double(x))
    if is_numeric(data_type) or isinstance(data_type, (T.BooleanType, T.DecimalType)):
        return double(x)
    return F.lit(None).cast("double")


def exact_integer(x: Column, data_type: T.DataType) -> Column:
    """A whole number as bigint without a detour over double; NULL where x is not written as one."""
    if isinstance(data_type, T.StringType):
        return parse_integer(number_text(x))
    if isinstance(data_type, T.DecimalType):
        return F.when(x == F.floor(x), x.try_cast("bigint"))
    if is_numeric(data_type) and not is_fractional(data_type):
        return x.cast("bigint")
    return F.lit(None).cast("bigint")


def numeric_null_token(x: Column, data_type: T.DataType) -> Column:
    """True where text stands for a missing number."""
    if isinstance(data_type, T.StringType):
        return number_text(x).isin(NUMERIC_NULL_TEXT)
    if is_fractional(data_type):
        return F.isnan(x)
    return F.lit(False)


def _ntz_from_micros(micros: Column) -> Column:
    # Built from an interval, so the session time zone cannot shift it.
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


SAMPLE_SEED = 42


def key_hash(key: str, seed: int = SAMPLE_SEED) -> Column:
    """60 bits of a digest of a column as text; other engines compute the same."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


# What the letters of a format stand for, by how often they are repeated; any other letter for anything.
_DIGITS = "yMdHhmsS"


def format_shape(fmt: str) -> str:
    """A pattern that every text of a date format has."""
    out = []
    for quoted, letters, other in re.findall(r"'([^']*)'|(([A-Za-z])\3*|[^A-Za-z'])", fmt):
        n = len(letters)
        if quoted or not letters[:1].isalpha():
            out.append(re.escape(quoted or letters))
        elif other == "M" and n > 2:
            out.append("[A-Za-z]{3}" if n == 3 else "[A-Za-z]+")
        elif other in _DIGITS:
            out.append(f"[0-9]{{{n}}}" if n > 1 else "[0-9]{1,2}")
        else:
            out.append(".+")
    return "^" + "".join(out) + "$"


def parse_moment(text: Column, fmt: str) -> Column:
    """Trimmed text as a timestamp by one format, NULL if it does not fit; text with an offset (X) in UTC."""
    if "X" in fmt:
        return F.try_to_timestamp(text, F.lit(fmt))
    return F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} xx"))


def format_bits(text: Column, formats: Sequence[str]) -> Column:
    """The set of formats a trimmed text fits, one bit each; a parser only runs where the shape is right."""
    by_shape: dict[str, list[int]] = {}
    for k, fmt in enumerate(formats):
        by_shape.setdefault(format_shape(fmt), []).append(k)
    bits = F.lit(0).cast("long")
    for shape, fits in by_shape.items():
        own = F.lit(0).cast("long")
        for k in fits:
            own = own.bitwiseOR(F.when(parse_moment(text, formats[k]).isNotNull(), F.lit(1 << k).cast("long")).otherwise(0))
        bits = bits.bitwiseOR(F.when(text.rlike(shape), own).otherwise(0))
    return bits


def to_datetime(x: Column, data_type: T.DataType, formats: Sequence[str]) -> Column:
    """Timestamp without zone; text by the first of its formats, numbers as epoch ns.

    One format is one parse per value; with several, a text is parsed by the first that it fits.
    """
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return x.cast("timestamp_ntz")
    if isinstance(data_type, T.StringType):
        text = F.trim(x)
        parsed = parse_moment(text, formats[0]) if len(formats) == 1 else F.coalesce(
            *[F.when(text.rlike(format_shape(f)), parse_moment(text, f)) for f in formats]
        )
        return _ntz_from_micros(F.unix_micros(parsed))
    if is_fractional(data_type):
        return _ntz_from_micros(F.floor(x / 1000.0))
    if is_numeric(data_type):
        return _ntz_from_micros(F.floor(x / F.lit(1000)))
    return F.lit(None).cast("timestamp_ntz")


# A published rational approximation of the inverse normal distribution (AS 241), numerators and
# denominators in a centre, a middle and a far part, lowest power first.
INVERSE_NORMAL = [
    (
        [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
         45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
        [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867,
         39307.895800092710610, 28729.085735721942674, 5226.4952788528545610],
    ),
    (
        [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4],
        [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
         0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9],
    ),
    (
        [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
         0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
        [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15],
    ),
]


def _ratio(part: tuple[list[float], list[float]], x: Column) -> Column:
    sums = []
    for coefficients in part:
        value = F.lit(coefficients[-1])
        for c in coefficients[-2::-1]:
            value = value * x + F.lit(c)
        sums.append(value)
    return sums[0] / sums[1]


def inverse_normal(p: Column) -> Column:
    """The value below which a normal variable lies with probability p, 0 < p < 1."""
    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, _ratio(INVERSE_NORMAL[1], r - 1.6)).otherwise(_ratio(INVERSE_NORMAL[2], r - 5))
    centre = q * _ratio(INVERSE_NORMAL[0], 0.180625 - q * q)
    return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * tail)


def corrected_skewness(skew: Column, n: Column, sd: Column) -> Column:
    """Bias-corrected skewness from the population value; 0 for a constant column."""
    n = double(n)
    value = skew * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n >= 3, F.when(sd == 0, F.lit(0.0)).otherwise(value))


def corrected_kurtosis(kurt: Column, n: Column, sd: Column) -> Column:
    """Bias-corrected excess kurtosis from the population value; 0 for a constant column."""
    n = double(n)
    value = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * kurt + 6)
    return F.when(n >= 4, F.when(sd == 0, F.lit(0.0)).otherwise(value))

"""Tests on single cells. Each returns a boolean Column that is never null.

The answers follow Python and pandas where Spark differs: Unicode white space is
stripped, NaN is missing, and a number must be written as a plain number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value.
PLACEHOLDERS = ("n/a", "unknown", "null", "-", "none", "")

# The characters Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Plain decimal numbers and infinities. Keeps out the type suffixes
# (1d, 1f) and hexadecimal floats that a Spark cast would take.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"

# Local part, at sign, domain, dot, ending; no white space or second at sign.
EMAIL_PATTERN = (
    r"^[^@\s\p{Z}\x1c-\x1f\x85]+@[^@\s\p{Z}\x1c-\x1f\x85]+"
    r"\.[^@\s\p{Z}\x1c-\x1f\x85]+\n?\z"
)


def dtype_of(df: DataFrame, name: str) -> T.DataType | None:
    """The type of a column, or None where the table lacks it."""
    return df.schema[name].dataType if name in df.columns else None


def column(name: str) -> Column:
    """A reference by exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def sql_text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_text(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_fraction(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def number(name: str, dtype: T.DataType) -> Column:
    """The cell as a double; null where it is missing, NaN or not a number."""
    c = column(name)
    if is_text(dtype):
        return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))
    if is_fraction(dtype):
        return F.when(~F.isnan(c), c.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(instant(c, dtype)).cast("double")
    return F.lit(None).cast("double")


def instant(c: Column, dtype: T.DataType) -> Column:
    """A date or time as a timestamp, reading one without a zone as UTC.

    A text is read in the session's zone, which should be UTC; one that is no date is null.
    """
    if is_text(dtype):
        return c.try_cast("timestamp")
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz")))
    return c


def latest(name: str, dtype: T.DataType) -> Column:
    """The aggregate that finds a column's last instant; finish with :func:`latest_instant`."""
    return F.max(instant(column(name), dtype) if is_text(dtype) else column(name))


def latest_instant(aggregated: str, dtype: T.DataType) -> Column:
    """What :func:`latest` found, as a timestamp."""
    found = column(aggregated)
    return found if is_text(dtype) else instant(found, dtype)


def missing(name: str, dtype: T.DataType | None) -> Column:
    """Null, NaN, blank or a placeholder. A column the table lacks is all missing."""
    if dtype is None:
        return F.lit(True)
    c = column(name)
    if is_text(dtype):
        return c.isNull() | F.lower(stripped(c)).isin(*PLACEHOLDERS)
    if is_fraction(dtype):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def not_numeric(name: str, dtype: T.DataType) -> Column:
    return number(name, dtype).isNull()


def not_text(name: str, dtype: T.DataType) -> Column:
    """Blank or null text; every cell of a column that holds no text."""
    if not is_text(dtype):
        return F.lit(True)
    return F.coalesce(F.length(stripped(column(name))) == 0, F.lit(True))


def not_email(name: str, dtype: T.DataType) -> Column:
    if not is_text(dtype):
        return F.lit(True)
    return ~F.coalesce(column(name).rlike(EMAIL_PATTERN), F.lit(False))


def out_of_range(
    name: str, dtype: T.DataType, low: float | None = None, high: float | None = None
) -> Column:
    """Below ``low``, above ``high`` (both inclusive bounds, both optional) or no number."""
    value = number(name, dtype)
    outside = value.isNull()
    if low is not None:
        outside = outside | (value < F.lit(float(low)))
    if high is not None:
        outside = outside | (value > F.lit(float(high)))
    return F.coalesce(outside, F.lit(True))


def not_in_set(name: str, allowed: Iterable) -> Column:
    """Outside a small set of literals; null is outside unless the set names it."""
    wanted = list(allowed)
    values = [v for v in wanted if v is not None]
    inside = column(name).isin(values) if values else F.lit(False)
    return ~F.coalesce(inside, F.lit(None in wanted))

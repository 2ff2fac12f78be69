"""Conversions of dirty text that stay fast when most of it is dirty."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["safe_cast", "safe_int", "safe_to_date"]

# What the patterns let through is a superset of what a cast accepts: casts trim white space and
# control characters, read decimals with any digits, and doubles also as NaN, Infinity, with a
# type suffix or in hexadecimal; times may lack the date.
_BLANK = r"[\p{javaWhitespace}\p{Cntrl}\x7F-\x9F]*"
_WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
_DECIMAL = rf"^{_BLANK}[+-]?[\p{{Nd}}.][\p{{Nd}}.eE+-]*{_BLANK}$"
_DOUBLE = rf"(?i)^{_BLANK}[+-]?(?:[0-9.][0-9a-fpx.+-]*|nan|inf|infinity){_BLANK}$"
_DATE = rf"(?s)^{_BLANK}[+-]?[0-9]{{4,7}}(?:[-T\p{{javaWhitespace}}].*)?{_BLANK}$"
_TIME = rf"^{_BLANK}[+T-]?[0-9]"
_GUARDS = {
    T.ByteType: _WHOLE, T.ShortType: _WHOLE, T.IntegerType: _WHOLE, T.LongType: _WHOLE,
    T.DecimalType: _DECIMAL, T.FloatType: _DOUBLE, T.DoubleType: _DOUBLE, T.DateType: _DATE,
    T.TimestampType: _TIME, T.TimestampNTZType: _TIME,
}


def safe_cast(col: Column | str, to: str, source: T.DataType | None = None) -> Column:
    """``try_cast`` that looks at text before converting it.

    A failing ``try_cast`` costs an exception per row, some fifty times the price of the
    conversion. Text that cannot be a value of the type is turned away by a pattern first; what
    passes is still tried, so out-of-range numbers and impossible dates become NULL. Give the
    ``source`` type when it is known: only text is checked.
    """
    col = F.col(col) if isinstance(col, str) else col
    target = T.DataType.fromDDL(to)
    guard = _GUARDS.get(type(target))
    if guard is None or (source is not None and not isinstance(source, T.StringType)):
        return col.try_cast(to)
    return F.when(col.rlike(guard), col.try_cast(to))


def safe_int(col: Column | str) -> Column:
    return safe_cast(col, "int", T.StringType())


def safe_to_date(col: Column | str, fmt: str) -> Column:
    """Date of text in a format of digits and separators, NULL for anything else."""
    col = F.col(col) if isinstance(col, str) else col
    shape = "^" + re.sub(r"[A-Za-z]", "[0-9]", re.escape(fmt).replace(r"\-", "-")) + "$"
    return F.when(col.rlike(shape), F.try_to_date(col, fmt))

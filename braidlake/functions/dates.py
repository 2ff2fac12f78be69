"""Month arithmetic, validity stamps and cleaning of raw date and time text."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column
from pyspark.sql import functions as F

from braidlake.functions import fixed
from braidlake.functions.casts import safe_int, safe_to_date

__all__ = [
    "add_months", "clean_date", "clean_time", "cohort_age", "date_key", "month_of", "month_range",
    "month_start", "months_apart", "time_key",
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_of(day: dt.date | str) -> dt.date:
    """First day of the month, on the driver: run dates become literals so scans can prune."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return day.replace(day=1)


def add_months(month: dt.date | str, n: int) -> dt.date:
    month = month_of(month)
    whole = month.year * 12 + month.month - 1 + n
    return dt.date(whole // 12, whole % 12 + 1, 1)


def month_range(first: dt.date | str, last: dt.date | str) -> list[dt.date]:
    out, month = [], month_of(first)
    while month <= month_of(last):
        out.append(month)
        month = add_months(month, 1)
    return out


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col), "MM")


def months_apart(later: Column | str, earlier: Column | str) -> Column:
    """Whole months between two dates, truncated toward zero."""
    return F.months_between(_c(later), _c(earlier)).cast("int")


def cohort_age(month: Column | str, first: Column | str) -> Column:
    """1 in the month of the first event, 2 in the next; 0 before it or without one."""
    month, start = _c(month), month_start(first)
    return F.when(month >= start, months_apart(month, start) + 1).otherwise(F.lit(0))


def clean_date(col: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Date of raw text; placeholders and unreadable text become NULL."""
    col = _c(col)
    return F.when(~col.isin(*fixed.BLANK_DATES), safe_to_date(col, fmt))


def clean_time(col: Column | str) -> Column:
    """``HHmmss`` text as ``HH:mm:ss``; the placeholder becomes NULL."""
    col = _c(col)
    return F.when(
        ~col.isin(*fixed.BLANK_TIMES),
        F.regexp_replace(col, r"(\d{2})(\d{2})(\d{2})", "$1:$2:$3"),
    )


def date_key(col: Column | str) -> Column:
    """Integer calendar key of raw ``yyyyMMdd`` text, -1 when absent or a placeholder."""
    col = _c(col)
    key = F.when(~col.isin(*fixed.BLANK_DATES), safe_int(col))
    return F.coalesce(key, F.lit(-1))


def time_key(col: Column | str) -> Column:
    """Integer ``HHmm`` key of raw ``HHmmss`` text, -1 when absent or a placeholder."""
    col = _c(col)
    key = F.when(~col.isin(*fixed.BLANK_TIMES), safe_int(F.substring(col, 1, 4)))
    return F.coalesce(key, F.lit(-1))

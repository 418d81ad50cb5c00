"""Date and clock column functions.

All are plain column expressions: they stay inside whole-stage codegen and
work unchanged on streaming DataFrames.  Text input goes through the
``try_`` parsers, so junk, ``24:00`` or a missing date give null instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hotbeat.fixed import RAW_TS_PATTERN, SHIFT_BOUNDS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, pattern: str = RAW_TS_PATTERN) -> Column:
    """Text ``MM/dd/yyyy hh:mm:ss a`` -> DATE (null when unparsable)."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(pattern)))


def format_clock(c) -> Column:
    """24-h clock integer (``5`` = 00:05, ``930`` = 09:30) -> ``HH:mm``.

    Values outside 0..2359 or with minutes >= 60 give null.
    """
    v = _c(c).try_cast("int")
    ok = (v >= 0) & (v <= 2359) & (v % 100 < 60)
    s = F.lpad(v.cast("string"), 4, "0")
    return F.when(ok, F.concat(F.substring(s, 1, 2), F.lit(":"), F.substring(s, 3, 2)))


def occurred_at(date_col, clock_col) -> Column:
    """D3: DATE + ``HH:mm`` -> TIMESTAMP; null when either part is missing/bad."""
    txt = F.concat(F.date_format(_c(date_col), "yyyy-MM-dd"), F.lit(" "), _c(clock_col))
    return F.try_to_timestamp(txt, F.lit("yyyy-MM-dd HH:mm"))


def hour_of(ts) -> Column:
    """D4."""
    return F.hour(_c(ts))


def time_slot(hour, bounds=SHIFT_BOUNDS) -> Column:
    """Shift number 1..len(bounds)+1; null hour -> null."""
    h = _c(hour)
    expr = None
    for i, b in enumerate(bounds):
        expr = F.when(h < b, F.lit(i + 1)) if expr is None else expr.when(h < b, F.lit(i + 1))
    return expr.when(h.isNotNull(), F.lit(len(bounds) + 1))


def year_of(d) -> Column:
    return F.year(_c(d))


def month_of(d) -> Column:
    return F.month(_c(d))


def weekday(d) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(d))


def weekday_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def weekday_monday_first(d) -> Column:
    """0 = Monday ... 6 = Sunday (ordering key for A4)."""
    return F.weekday(_c(d))


def day_of_month(d) -> Column:
    """D8 (named so it can never shadow a date column)."""
    return F.dayofmonth(_c(d))


def year_month(d) -> Column:
    """``yyyy-MM`` key."""
    return F.date_format(_c(d), "yyyy-MM")


def report_lag_days(reported, occurred) -> Column:
    """Lag in (fractional) days between two dates or timestamps."""
    return (F.unix_seconds(_c(reported).cast("timestamp")) -
            F.unix_seconds(_c(occurred).cast("timestamp"))) / F.lit(86400.0)


def hour_sin(hour) -> Column:
    """D11."""
    return F.sin(F.lit(2 * math.pi) * _c(hour) / F.lit(24.0))


def hour_cos(hour) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(hour) / F.lit(24.0))


def trunc_int(c) -> Column:
    """Truncate toward zero."""
    return _c(c).cast("int")

"""Text parsing expressions with Python-like number rules under ANSI mode.

``try_cast`` alone is not enough: Spark reads ``1.0d`` and ``1e3`` where Python
``int()`` refuses, and ``nan``/``inf`` would pass a ``> 0`` test.  Each number
is therefore guarded by a pattern and then ``try_cast`` (null on overflow).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number spellings.
INT_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
TIME_FORMAT = "HH:mm"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The ASCII whitespace Python's str.strip() removes.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c: str | Column) -> Column:
    """Python ``str.strip()``: drop leading and trailing whitespace (no regex)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def strict_int(c: str | Column, kind: str = "int") -> Column:
    """``int(s)`` or null: digits with an optional sign, in the range of ``kind``."""
    c = col(c)
    return F.when(c.rlike(INT_PATTERN), c.try_cast(kind))


def whole(c: str | Column) -> Column:
    """``int(float(s))`` or null: a finite number cut to a 64-bit integer."""
    return strict_double(c).try_cast("bigint")


def strict_double(c: str | Column) -> Column:
    """``float(s)`` or null, rejecting nan and infinity (also overflow such as ``1e400``)."""
    c = col(c)
    d = c.try_cast("double")
    return F.when(c.rlike(FLOAT_PATTERN) & (F.abs(d) < F.lit(float("inf"))), d)


def fields(c: str | Column, sep: str = ",", limit: int = -1) -> Column:
    """Split on a literal separator; ``limit`` > 0 keeps the rest in the last field."""
    return F.split(col(c), sep, limit)


def field(arr: Column, i: int) -> Column:
    """Element ``i`` (0-based) or null when out of range (``[i]`` raises under ANSI)."""
    return F.get(arr, i)


def seconds_of_day(c: str | Column) -> Column:
    """``HH:mm`` -> seconds since midnight; null when malformed (zone-free)."""
    parts = fields(c, ":")
    h = strict_int(field(parts, 0))
    m = strict_int(field(parts, 1))
    ok = (F.size(parts) == 2) & h.between(0, 23) & m.between(0, 59)
    return F.when(ok, h * 3600 + m * 60)


def time_on_date(date: Column, time: str | Column) -> Column:
    """Time-only string placed on a date; bad or missing time -> null."""
    text = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), col(time))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd " + TIME_FORMAT)).cast("timestamp_ntz")


def four_decimals(c: str | Column) -> Column:
    """Text form ``{x:.4f}``."""
    return F.format_string("%.4f", col(c))

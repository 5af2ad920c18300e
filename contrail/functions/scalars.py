"""Column expressions for the lab SQL: event time, key=value text, safe casts.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen and work the same in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_text(year: str | Column, month: str | Column, day: str | Column, hhmm: str | Column) -> Column:
    """``y-m-d HH:MM:00`` as the labs build it: unpadded month/day, ``lpad(hhmm, 4, '0')``."""
    t = F.lpad(_c(hhmm).cast("string"), 4, "0")
    return F.concat(_c(year).cast("string"), F.lit("-"), _c(month).cast("string"), F.lit("-"),
                    _c(day).cast("string"), F.lit(" "), F.substring(t, 1, 2), F.lit(":"),
                    F.substring(t, 3, 2), F.lit(":00"))


def event_ts(year: str | Column, month: str | Column, day: str | Column, hhmm: str | Column) -> Column:
    """Event timestamp from date parts and an HHMM clock integer.

    ``2400`` means midnight at the end of the day (next day 00:00); an
    impossible value (bad month, minute > 59, NULL) yields NULL rather than an
    error.
    """
    h = F.floor(_c(hhmm) / 100).cast("int")
    m = (_c(hhmm) % 100).cast("int")
    ok = (h >= 0) & (h <= 24) & (m >= 0) & (m <= 59) & ((h < 24) | (m == 0))
    base = F.try_make_timestamp(_c(year), _c(month), _c(day), F.lit(0), F.lit(0), F.lit(0))
    return F.when(ok, base + F.make_dt_interval(F.lit(0), h, m, F.lit(0)))


def event_epoch(year, month, day, hhmm) -> Column:
    return F.unix_timestamp(event_ts(year, month, day, hhmm))


def parse_event_text(text: str | Column) -> Column:
    """``unix_timestamp`` of the lab's event text, NULL when it does not parse."""
    return F.unix_timestamp(F.try_to_timestamp(_c(text), F.lit("y-M-d H:m:s")))


def kv_number(text: str | Column, key: str) -> Column:
    """Numeric value after ``key=`` in ``{a=1, b=2}`` text; NULL when absent or not a number.

    The whole value up to the next separator is cast, so exponents (``1.5E-4``) count.
    """
    return F.regexp_extract(_c(text), rf"(?:^|[{{ ,]){key}=([^,}} ]*)", 1).try_cast("double")


def kv_fixed_width(text: str | Column, key: str, width: int, strip: str = ",") -> Column:
    """The lab's original fixed-width read: ``translate(substr(t, instr(t, key=) + len, width), strip, '')``.

    Kept for compatibility; it mis-reads values whose width differs (T2).
    """
    t = _c(text)
    start = F.instr(t, f"{key}=") + len(key) + 1
    return F.translate(F.substring(t, start, F.lit(width)), strip, "")


def stable_pick(key: str | Column, modulus: int, offset: int = 1) -> Column:
    """Repeatable stand-in for ``rand()``: ``(key * 7919) mod modulus + offset``."""
    return F.pmod(_c(key) * F.lit(7919), F.lit(modulus)) + F.lit(offset)

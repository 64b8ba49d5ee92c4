"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market zone of the feeds' candle timestamps (fixed value).
MARKET_TZ = "Asia/Kolkata"
# Rendering of candle times (fixed value): ``%Y-%m-%d %H:%M:%S``.
LOCAL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nth_part(c, sep: str, n: int) -> Column:
    """1-based ``n``-th piece of ``c`` split on the literal ``sep``; NULL when absent.

    ``split`` takes a regex, so the separator is quoted; ``try_element_at`` keeps
    a short array from throwing under ANSI mode.
    """
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.try_element_at(F.split(_c(c), pattern), F.lit(n))


def exchange_segment(c) -> Column:
    """Instrument type encoded after the ``_`` of a composite exchange (``NSE_EQ`` -> ``EQ``)."""
    return nth_part(c, "_", 2)


def lenient_date(c) -> Column:
    """DATE from a DATE, TIMESTAMP or ``yyyy-MM-dd`` string; NULL when unparseable
    (``to_date`` throws under ANSI mode)."""
    return _c(c).try_cast("date")


def strict_int(c) -> Column:
    """Token string -> BIGINT, NULL when it is not a clean integer (ANSI ``try_cast``)."""
    return _c(c).try_cast("long")


def lenient_long(c) -> Column:
    """Number text -> BIGINT; ``1200.0`` is 1200, text that is no number in range is NULL."""
    return F.coalesce(_c(c).try_cast("long"), _c(c).try_cast("double").try_cast("long"))


def to_market_time(ts, tz: str = MARKET_TZ) -> Column:
    """Instant (TIMESTAMP or UTC-read TIMESTAMP_NTZ) -> wall clock of ``tz``.

    Correct only with the session zone set to UTC, which ``build_session`` does.
    """
    return F.from_utc_timestamp(_c(ts).cast("timestamp"), tz)


def format_local(ts) -> Column:
    return F.date_format(_c(ts), LOCAL_FORMAT)

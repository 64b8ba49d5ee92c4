"""Named bar intervals.

Fixed values: the quote intervals ``1d``, ``I1``, ``I30`` (read as one day, one
minute, thirty minutes) and the candle intervals ``1minute``, ``5minute``,
``30minute``, ``day``, ``1day``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERVALS = {
    "1d": "1 day",
    "I1": "1 minute",
    "I30": "30 minutes",
    "1minute": "1 minute",
    "5minute": "5 minutes",
    "30minute": "30 minutes",
    "day": "1 day",
    "1day": "1 day",
}

QUOTE_INTERVALS = ("1d", "I1", "I30")

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_of(interval: str) -> str:
    """The duration a name stands for; a duration stands for itself."""
    return INTERVALS.get(interval, interval)


def interval_seconds(interval: str) -> int:
    """Length of a named interval or a duration such as ``15 minutes``."""
    n, unit = duration_of(interval).split()
    return int(n) * _UNIT_SECONDS[unit.rstrip("s")]


def interval_duration(name: Column) -> Column:
    """The duration that an interval's name stands for, so that ``day``, ``1day`` and ``1d`` are one;
    NULL for a name that is not known."""
    known = F.create_map(*[F.lit(x) for pair in INTERVALS.items() for x in pair])
    return F.try_element_at(known, name)

"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from tickforge.functions.exprs import (  # noqa: F401
    exchange_segment, lenient_date, nth_part, strict_int, to_market_time, format_local,
    lenient_long,
)
from tickforge.functions.intervals import INTERVALS  # noqa: F401

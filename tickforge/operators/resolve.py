"""Request validation and resolution against an instrument master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import strict_int
from tickforge.functions.intervals import QUOTE_INTERVALS
from tickforge.operators.joins import broadcast_if_small

# Request defaults (fixed values): exchange "NSE", token and type "".
DEFAULT_EXCHANGE = "NSE"


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Fill the defaults a request item gets when a field is absent."""
    return requests.withColumns({
        "exchange": F.coalesce(F.col("exchange"), F.lit(DEFAULT_EXCHANGE)),
        "exchange_token": F.coalesce(F.col("exchange_token"), F.lit("")),
        "instrument_type": F.coalesce(F.col("instrument_type"), F.lit("")),
    })


def reject_reason(intervals: tuple[str, ...] | None = None,
                  interval_col: str = "interval_name"):
    """First failing check of a request item, or NULL when it passes.

    Order follows the service: the interval is checked before any item, then the
    token must be present and a clean integer.
    """
    tok = F.col("exchange_token")
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    if intervals is not None:
        ok = F.col(interval_col).isin(*intervals)
        reason = reason.when(~F.coalesce(ok, F.lit(False)), F.lit("bad_interval"))
    return (reason
            .when(tok.isNull() | (tok == ""), F.lit("missing_token"))
            .when(strict_int(tok).isNull(), F.lit("bad_token")))


def validate_requests(requests: DataFrame, intervals: tuple[str, ...] | None = None,
                      interval_col: str = "interval_name") -> tuple[DataFrame, DataFrame]:
    """Split request items into ``(valid, rejects)``; rejects carry ``reason``.

    Pass ``intervals=QUOTE_INTERVALS`` for OHLC requests.  Valid rows gain
    ``token_int``; nothing is raised.
    """
    tagged = requests.withColumn("reason", reject_reason(intervals, interval_col))
    valid = (tagged.where(F.col("reason").isNull()).drop("reason")
             .withColumn("token_int", strict_int("exchange_token")))
    rejects = tagged.where(F.col("reason").isNotNull())
    return valid, rejects


def first_match(master: DataFrame, keys: list[str], order_col: str = "src_pos") -> DataFrame:
    """One master row per key: the row with the smallest ``order_col`` (file order).

    File order is ``(src_file, src_pos)`` where the reader gave the file.  On a
    unified master, file positions of two feeds can be equal; the broker
    name then breaks the tie, so the pick is deterministic.  Written as an
    aggregate, not a window, so duplicates of one key are combined map-side
    before the shuffle.
    """
    others = [c for c in master.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in _ordering(master, order_col) if c not in keys])
    picked = F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_row")
    return master.groupBy(*keys).agg(picked).select(*keys, "_row.*")


def _ordering(master: DataFrame, order_col: str = "src_pos") -> list[str]:
    """Columns that put master rows in file order."""
    return [c for c in ("src_file", order_col, "broker") if c in master.columns]


def _segment_key():
    return F.concat(F.col("exchange"), F.lit("_"), F.col("instrument_type"))


def resolve_instruments(requests: DataFrame, master: DataFrame,
                        segment_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Feed-A resolution (O14): ``exchange_token = int(token)`` and
    ``exchange = '<exchange>_<instrument_type>'``; the first master row supplies
    ``instrument_key``.  On the unified master (it has ``broker``) exchange and type
    are columns of their own and are matched as such, whichever the feed.
    ``segment_col`` names another composite column.

    Returns ``(resolved, unresolved)``.  ``unresolved`` holds items that failed
    validation (``reason`` from O12) or matched no master row (``not_in_master``).
    """
    req = with_request_defaults(requests)
    valid, rejects = validate_requests(req)
    unified = segment_col is None and {"broker", "instrument_type"} <= set(master.columns)
    segment = _segment_key() if unified else F.col(segment_col or "exchange")
    m = first_match(master.select("exchange_token", segment.alias("exchange"),
                                  "instrument_key", *_ordering(master)),
                    ["exchange_token", "exchange"])
    m = m.select(F.col("exchange_token").alias("_m_token"), F.col("exchange").alias("_m_exchange"),
                 "instrument_key")
    probe = valid.withColumn("_seg", _segment_key())
    cond = [probe["token_int"] == m["_m_token"], probe["_seg"] == m["_m_exchange"]]
    joined = probe.join(broadcast_if_small(m), cond, "left")
    resolved = (joined.where(F.col("_m_token").isNotNull())
                .drop("_m_token", "_m_exchange", "_seg"))
    missing = (joined.where(F.col("_m_token").isNull())
               .drop("_m_token", "_m_exchange", "_seg", "instrument_key", "token_int")
               .withColumn("reason", F.lit("not_in_master")))
    return resolved, rejects.unionByName(missing)


def resolve_symbols(requests: DataFrame, master_b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feed-B resolution (O15): match ``(exchange_token, exchange)`` without the
    type; the result key is ``EXCHANGE:SYMBOL``.  An instrument without a symbol
    cannot be asked for, so its items are rejected (``missing_symbol``).
    """
    req = with_request_defaults(requests)
    valid, rejects = validate_requests(req)
    m = first_match(master_b.select("exchange_token", "exchange", "tradingsymbol", *_ordering(master_b)),
                    ["exchange_token", "exchange"])
    m = m.select(F.col("exchange_token").alias("_m_token"), F.col("exchange").alias("_m_exchange"),
                 "tradingsymbol")
    cond = [valid["token_int"] == m["_m_token"], valid["exchange"] == m["_m_exchange"]]
    joined = valid.join(broadcast_if_small(m), cond, "left")
    named = F.col("_m_token").isNotNull() & F.col("tradingsymbol").isNotNull()
    resolved = (joined.where(named)
                .withColumn("symbol_key", F.concat(F.col("exchange"), F.lit(":"), F.col("tradingsymbol")))
                .drop("_m_token", "_m_exchange"))
    missing = (joined.where(~named)
               .withColumn("reason", F.when(F.col("_m_token").isNull(), "not_in_master").otherwise("missing_symbol"))
               .drop("_m_token", "_m_exchange", "tradingsymbol", "token_int"))
    return resolved, rejects.unionByName(missing)


def unresolved_requests(requests: DataFrame, master: DataFrame, fail: bool = False) -> DataFrame:
    """Items with no usable master row (O16).  ``fail=True`` makes the job fail
    on the first such row instead (the service raised), via ``assert_true``.
    """
    _, bad = resolve_instruments(requests, master)
    if fail:
        msg = F.concat(F.lit("unresolved request item: "), F.coalesce(F.col("exchange_token"), F.lit("")),
                       F.lit(" ("), F.col("reason"), F.lit(")"))
        # A filter keeps the check in the plan (a dropped column would be pruned).
        return bad.where(F.assert_true(F.lit(False), msg).isNull())
    return bad


__all__ = ["validate_requests", "resolve_instruments", "resolve_symbols",
           "unresolved_requests", "first_match", "with_request_defaults", "QUOTE_INTERVALS"]

"""The service's endpoints as whole-table jobs.

Each takes a request table instead of one HTTP body and returns
``(rows, rejects)``: rows keyed by ``(request_id, pos)`` and rejects with a
``reason``.  ``sinks.request_status`` turns both into per-request envelopes.

A bare token is not an instrument: two exchanges may use the same number.  Ticks
and candles are matched on ``instrument_key`` where they carry it, else on
``(exchange, exchange_token)``; only a table with neither (one exchange's own) is
matched on the token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import MARKET_TZ, lenient_date
from tickforge.functions.intervals import QUOTE_INTERVALS, interval_duration
from tickforge.operators.bars import full_market_quote, keys_of, ltp_quote, ohlc_quote, wanted_bars
from tickforge.operators.history import Asked, historical_data, history_to_today
from tickforge.operators.joins import broadcast_if_small
from tickforge.operators.master import backfill_index_symbols, unify_masters
from tickforge.operators.resolve import (
    resolve_instruments, resolve_symbols, validate_requests, with_request_defaults,
)
from tickforge.schemas import CANDLE_COLUMNS
from tickforge.session import checkpoint_root


def master_data(feeds: dict[str, DataFrame], layouts: dict[str, str] | None = None,
                symbol_map: DataFrame | None = None) -> DataFrame:
    """``GET /master-data``: the unified master, index symbols back-filled."""
    m = unify_masters(feeds, layouts).withColumnRenamed("tradingsymbol", "trading_symbol")
    return backfill_index_symbols(m, symbol_map).withColumnRenamed("trading_symbol", "tradingsymbol")


def _request_column(c: str):
    return F.col("token_int" if c == "exchange_token" else c)


def _requested_ticks(resolved: DataFrame, ticks: DataFrame, key: list[str]) -> DataFrame:
    # Aggregate only the requested instruments: the distinct key set is
    # combined map-side and, when small, broadcast into a semi-join on the scan.
    types = dict(ticks.dtypes)
    wanted = resolved.select(*[_request_column(c).cast(types[c]).alias(c) for c in key]).distinct()
    return ticks.join(broadcast_if_small(wanted), key, "left_semi")


def _attach(resolved: DataFrame, quotes: DataFrame, key: list[str]) -> DataFrame:
    # The request's token text is replaced by the resolved integer token.
    r = resolved.drop("exchange_token").withColumnRenamed("token_int", "exchange_token")
    q = quotes.withColumnsRenamed({c: f"_q_{c}" for c in key})
    out = r.join(q, [r[c] == q[f"_q_{c}"] for c in key])
    return out.drop(*[f"_q_{c}" for c in key])


def ltp_for_requests(requests: DataFrame, master: DataFrame, ticks: DataFrame,
                     tick_key: str | list[str] | None = None, since=None) -> tuple[DataFrame, DataFrame]:
    """``POST /ltp-quote`` over a request table."""
    key = keys_of(ticks, tick_key)
    resolved, rejects = resolve_instruments(requests, master)
    q = ltp_quote(_requested_ticks(resolved, ticks, key), key=key, since=since)
    return _attach(resolved, q, key), rejects


def ltp_for_symbols(requests: DataFrame, master_b: DataFrame, ticks: DataFrame,
                    tick_key: str | list[str] | None = None, since=None) -> tuple[DataFrame, DataFrame]:
    """Feed B's ``POST /ltp-quote``: items are asked for by ``EXCHANGE:SYMBOL``
    (``symbol_key`` in the rows); an instrument without a symbol is rejected."""
    key = keys_of(ticks, tick_key)
    resolved, rejects = resolve_symbols(requests, master_b)
    q = ltp_quote(_requested_ticks(resolved, ticks, key), key=key, since=since)
    return _attach(resolved, q, key), rejects


def ohlc_items(requests: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The OHLC items that can be served, resolved, and the rejects; no tick is read."""
    valid, bad = validate_requests(requests, intervals=QUOTE_INTERVALS)
    resolved, rejects = resolve_instruments(valid.drop("token_int"), master)
    return resolved, with_request_defaults(bad).unionByName(rejects)


def ohlc_for_requests(requests: DataFrame, master: DataFrame, ticks: DataFrame, interval: str | None = None,
                      tick_key: str | list[str] | None = None, since=None) -> tuple[DataFrame, DataFrame]:
    """``POST /ohlc-quote``.

    Each item's ``interval_name`` must be one of ``1d``, ``I1``, ``I30`` (else it is
    rejected: ``bad_interval``) and names the bar it gets; ``interval`` sets one for
    the whole table instead.  All intervals are served by one pass over the instruments' last ticks.
    """
    if interval is not None and interval not in QUOTE_INTERVALS:
        raise ValueError(f"no quote bar of length {interval!r}; use one of {sorted(QUOTE_INTERVALS)}")
    key = keys_of(ticks, tick_key)
    if interval is not None:
        resolved, rejects = resolve_instruments(requests, master)
        q = ohlc_quote(_requested_ticks(resolved, ticks, key), interval, key=key, since=since)
        return _attach(resolved, q, key), rejects
    resolved, rejects = ohlc_items(requests, master)
    # Resolved once: the wanted buckets and the answers are read from the same rows.
    checkpoint_root(requests.sparkSession)
    resolved = resolved.checkpoint()
    types = dict(ticks.dtypes)
    wanted = resolved.select(*[_request_column(c).cast(types[c]).alias(c) for c in key], "interval_name").distinct()
    found = wanted_bars(ticks, wanted, key=key, since=since)
    q = found.select(*key, "interval_name", "datetime", "open", "high", "low", "close", "volume", F.col("close").alias("last_price"))
    return _attach(resolved, q, [*key, "interval_name"]), rejects


def full_quote_for_requests(requests: DataFrame, master: DataFrame, ticks: DataFrame,
                            tick_key: str | list[str] | None = None, since=None) -> tuple[DataFrame, DataFrame]:
    """``POST /full-mkt-quote`` over a request table."""
    key = keys_of(ticks, tick_key)
    resolved, rejects = resolve_instruments(requests, master)
    # Resolved once: two passes over the ticks and the answer read it.
    checkpoint_root(requests.sparkSession)
    resolved = resolved.checkpoint()
    q = full_market_quote(_requested_ticks(resolved, ticks, key), key=key, since=since)
    return _attach(resolved, q, key), rejects


HISTORY_REQUIRED = ["exchange_token", "interval_name", "from_date", "to_date", "instrument_type"]


def historical_for_requests(requests: DataFrame, master: DataFrame, candles: DataFrame,
                            full_quotes: DataFrame | None = None, today=None,
                            key: str | list[str] | None = None, tz: str = MARKET_TZ,
                            sort: bool = True, intervals=None, days=None) -> tuple[DataFrame, DataFrame]:
    """``POST /historical-data`` over a request table.

    Items carry ``request_id, pos, exchange, exchange_token, instrument_type,
    interval_name, from_date, to_date``.  An item missing a required field is
    rejected (``missing_parameters``), one with an unparseable date
    (``bad_date``); the rest are resolved against the master.  Where ``candles`` has an
    ``interval_name``, an item gets the candles of the interval it names -- ``day``, ``1day`` and ``1d``
    are one -- and an item whose interval is unknown or not in the table is rejected
    (``bad_interval``); ``intervals`` names those in the table where they are known, else they are
    looked up.  When ``today`` and ``full_quotes`` are given, an item whose range ends today and whose
    own candles lack today's bar gets one built from the quote, as the service did; an item
    without candles gets none.
    Output rows: ``request_id``, ``pos``, the instrument's key columns, ``interval_name``, ``datetime, open,
    high, low, close, volume, oi``.  With ``sort=True`` each item's rows sit together
    in one partition in time order, as the service returned them; items of one request may lie in
    several partitions, so a request of any size spreads over the cluster.
    """
    req = requests
    if "pos" not in req.columns:
        req = req.withColumn("pos", F.lit(0).cast("long"))
    missing = None
    for c in HISTORY_REQUIRED:
        cond = F.col(c).isNull() | (F.col(c).cast("string") == "")
        missing = cond if missing is None else (missing | cond)
    bad_dates = lenient_date("from_date").isNull() | lenient_date("to_date").isNull()
    req = req.withColumn("_interval", interval_duration(F.col("interval_name")))
    extra = ()
    reason = F.when(missing, F.lit("missing_parameters")).when(bad_dates, F.lit("bad_date"))
    if "interval_name" in candles.columns:
        extra = ("_interval",)
        candles = candles.withColumn("_interval", interval_duration(F.col("interval_name")))
        if intervals is None:
            held = candles.select(F.collect_set("_interval")).scalar()      # at most one name per known duration
        else:
            held = F.array_distinct(F.transform(F.array(*[F.lit(x) for x in intervals]), interval_duration))
        reason = reason.when(~F.coalesce(F.array_contains(held, F.col("_interval")), F.lit(False)), F.lit("bad_interval"))
    flagged = with_request_defaults(req.withColumn("_reason", reason))
    bad_params = (flagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason").drop("_interval"))
    resolved, rejects = resolve_instruments(flagged.where(F.col("_reason").isNull()).drop("_reason"), master)
    keys = keys_of(candles, key)
    types = dict(candles.dtypes)
    probe = resolved.select("request_id", "pos", *[_request_column(c).cast(types[c]).alias(c) for c in keys], "from_date",
                            "to_date", "interval_name", "_interval")
    # Resolved once: both levels of the range join and their day spans are read from the same rows.
    checkpoint_root(requests.sparkSession)
    probe = probe.checkpoint()
    day = lenient_date(F.lit(str(today))) if today is not None else None
    known = Asked(probe, day, extra[0] if extra and today is not None else None)
    item = ["request_id", "pos", "interval_name"]
    if today is not None and full_quotes is not None:
        out = history_to_today(probe, candles, full_quotes, today, item, keys, extra, tz, days, known)
    else:
        out = historical_data(probe, candles, key=keys, request_col=item, extra_keys=extra, days=days, known=known)
        if sort:
            out = out.repartition("request_id", "pos")
    if sort:
        out = out.sortWithinPartitions("request_id", "pos", "datetime")
    return (out.select("request_id", "pos", *keys, "interval_name", *CANDLE_COLUMNS),
            bad_params.unionByName(rejects.drop("_interval"), allowMissingColumns=True))


__all__ = ["master_data", "ltp_for_requests", "ohlc_for_requests", "full_quote_for_requests", "ohlc_items",
           "ltp_for_symbols", "historical_for_requests"]

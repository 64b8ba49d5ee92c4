"""Bars from ticks (O24) and the quote aggregates built on them.

Ticks are rows ``(exchange_token, ts, price, qty, oi, event_id)``, with ``exchange`` or
``instrument_key`` where tokens are not unique: ``ts`` an instant (TIMESTAMP, or TIMESTAMP_NTZ read as UTC), ``event_id`` a unique
tie-breaker.  Open/close/last are picked by ``(ts, event_id)``; all aggregates
are partial (map-side combined), so a hot instrument is reduced before the
shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import MARKET_TZ, format_local, to_market_time
from tickforge.functions.intervals import INTERVALS, interval_seconds
from tickforge.operators.joins import broadcast_if_small, broadcast_limit
from tickforge.session import checkpoint_root

# Spacing of instants in a tick's order number: wider than the whole BIGINT range,
# so adding any event_id never reaches the next microsecond.
_STEP = 2 * 10 ** 19


def key_columns(key: str | list[str] | tuple[str, ...]) -> list[str]:
    """An instrument key is one column or several, e.g. ``["exchange", "exchange_token"]``."""
    return [key] if isinstance(key, str) else list(key)


def instrument_key_of(table: DataFrame) -> list[str]:
    """The columns that identify an instrument in a tick or candle table: its
    ``instrument_key``, else ``(exchange, exchange_token)``, else the token alone (one
    exchange's table, where tokens are unique)."""
    for key in (["instrument_key"], ["exchange", "exchange_token"]):
        if set(key) <= set(table.columns):
            return key
    return ["exchange_token"]


def keys_of(table: DataFrame, key: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """``key`` as a list; None stands for the columns that identify an instrument in ``table``."""
    return key_columns(key) if key else instrument_key_of(table)


def tick_order(ts: str = "ts", tie: str = "event_id") -> Column:
    """``(ts, event_id)`` as one exact DECIMAL(38,0), which a hash aggregate can hold
    (a struct would force a sort of every scan split).  ``tie`` is a BIGINT; NULL counts as 0.
    A tick without a time has no order: it is never first or last."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    step = F.lit(str(_STEP)).cast("decimal(20,0)")
    return (micros * step + F.coalesce(F.col(tie).cast("long"), F.lit(0)).cast("decimal(20,0)")).cast("decimal(38,0)")


def ohlc_aggs(price: str = "price", qty: str = "qty", oi: str = "oi",
              ts: str = "ts", tie: str = "event_id") -> list[Column]:
    """Aggregates of one bar, each over a fixed-width buffer."""
    o = tick_order(ts, tie)
    return [
        F.min_by(F.col(price), o).alias("open"),
        F.max(F.col(price)).alias("high"),
        F.min(F.col(price)).alias("low"),
        F.max_by(F.col(price), o).alias("close"),
        F.sum(F.col(qty)).cast("long").alias("volume"),
        F.max_by(F.col(oi).cast("long"), o).alias("oi"),
        F.max(F.col(ts).cast("timestamp")).alias("last_ts"),
    ]


def ohlc_out(with_last_ts: bool = True) -> list[Column]:
    """Bar columns of an ``ohlc_aggs`` result."""
    cols = ["open", "high", "low", "close", "volume", "oi"]
    return [F.col(c) for c in (cols + ["last_ts"] if with_last_ts else cols)]


def _since(ticks: DataFrame, since, tz: str) -> DataFrame:
    """Ticks from local midnight of day ``since`` on (None: all).  Where the table has a
    ``trade_date``, that prunes its partitions."""
    if since is None:
        return ticks
    day = F.lit(str(since)).cast("date")
    if "trade_date" in ticks.columns:
        return ticks.where(F.col("trade_date") >= day)
    return ticks.where(F.col("ts").cast("timestamp") >= F.to_utc_timestamp(day.cast("timestamp"), tz))


def bars(ticks: DataFrame, interval: str, tz: str = MARKET_TZ,
         key: str | list[str] | None = None) -> DataFrame:
    """All bars of ``interval`` (a name such as ``1minute``/``day`` or a Spark
    duration such as ``'15 minutes'``) per instrument (O24).

    Buckets are laid on the market-zone wall clock, so day bars start at local
    midnight.  Output: ``key, bar_start (local TIMESTAMP), datetime
    ('yyyy-MM-dd HH:mm:ss' local), trade_date, open, high, low, close, volume,
    oi, last_ts``.
    """
    dur = INTERVALS.get(interval, interval)
    # Group on the bucket start alone (one timestamp, not the window struct):
    # smaller partial-aggregate rows to sort and shuffle.
    start = F.window(to_market_time("ts", tz), dur).start
    keys = keys_of(ticks, key)
    agg = ticks.groupBy(*keys, start.alias("bar_start")).agg(*ohlc_aggs())
    return agg.select(
        *keys,
        F.col("bar_start"),
        format_local(F.col("bar_start")).alias("datetime"),
        F.to_date(F.col("bar_start")).alias("trade_date"),
        *ohlc_out(),
    )


def ltp_quote(ticks: DataFrame, key: str | list[str] | None = None, tz: str = MARKET_TZ, since=None) -> DataFrame:
    """Last traded price per instrument (O21): ``key, last_price, last_time``.

    ``since`` (a day, here and below) leaves older ticks unread; an instrument
    without ticks from then on has no row.
    """
    keys = keys_of(ticks, key)
    return (_since(ticks, since, tz).groupBy(*keys)
            .agg(F.max_by("price", tick_order()).alias("last_price"),
                 F.max(F.col("ts").cast("timestamp")).alias("_ts"))
            .select(*keys, "last_price", format_local(to_market_time("_ts", tz)).alias("last_time")))


def latest_bar(bar_df: DataFrame, key: str | list[str] | None = None) -> DataFrame:
    """The most recent bar of each instrument (bars are one per (key, start))."""
    keys = keys_of(bar_df, key)
    cols = [c for c in bar_df.columns if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("bar_start")).alias("_b")
    return bar_df.groupBy(*keys).agg(picked).select(*keys, "_b.*")


def newest_bars(ticks: DataFrame, interval: str, tz: str = MARKET_TZ,
                key: str | list[str] | None = None) -> DataFrame:
    """The most recent bar of each instrument without building the others.

    A first pass over key and time finds each instrument's last bucket (a reliable
    checkpoint, one row per instrument); only ticks of those buckets are then
    aggregated.  The buckets are broadcast as a filter on the scan while their
    measured size is within ``broadcast_limit``; beyond it, and on streams, all
    bars are built -- shuffling partial bars is cheaper than shuffling every tick.
    """
    keys = keys_of(ticks, key)
    if ticks.isStreaming:
        return latest_bar(bars(ticks, interval, tz, key), key)
    checkpoint_root(ticks.sparkSession)
    bucket = F.window(to_market_time("ts", tz), INTERVALS.get(interval, interval)).start
    last = ticks.groupBy(*keys).agg(F.max(F.col("ts")).alias("ts")).withColumn("_b_start", bucket)
    last = last.select(*[F.col(k).alias(f"_b_{i}") for i, k in enumerate(keys)], "_b_start").checkpoint()
    width = F.lit(64)
    for i in range(len(keys)):
        width = width + F.coalesce(F.octet_length(F.col(f"_b_{i}").cast("string")), F.lit(0)) + 16
    held = last.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if held > broadcast_limit(ticks.sparkSession):
        return latest_bar(bars(ticks, interval, tz, key), key)
    # Null-safe: ticks without a key are a group of their own, as in any grouping.
    cond = F.col("_bar") == F.col("_b_start")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_b_{i}"))
    recent = ticks.withColumn("_bar", bucket).join(F.broadcast(last), cond, "left_semi").drop("_bar")
    return bars(recent, interval, tz, key)


def _bucket(ts: Column, micros: Column) -> Column:
    """Start of the bucket of a market-zone time, as ``F.window`` lays it."""
    at = F.unix_micros(ts)
    return F.timestamp_micros(at - F.pmod(at, micros))


def wanted_bars(ticks: DataFrame, wanted: DataFrame, tz: str = MARKET_TZ,
                key: str | list[str] | None = None, since=None) -> DataFrame:
    """The latest bar of every wanted (instrument, ``interval_name``), all intervals in one pass.

    ``wanted`` holds the tick table's key columns and ``interval_name``.  A first pass over
    key and time finds each instrument's last tick; a second reads the ticks of that market day
    and gives each tick to those of the instrument's wanted buckets that it lies in.  The
    instruments are broadcast while their measured size is within ``broadcast_limit``; beyond it,
    minute bars of the wanted instruments are shuffled and rolled up instead.
    Output: key, ``interval_name``, then the columns of ``bars``.
    """
    keys = keys_of(ticks, key)
    ticks = _since(ticks, since, tz)
    checkpoint_root(ticks.sparkSession)
    asked = wanted.select(*[F.col(k).alias(f"_w_{i}") for i, k in enumerate(keys)], "interval_name")
    asked = asked.groupBy(*[f"_w_{i}" for i in range(len(keys))]).agg(F.collect_set("interval_name").alias("_names"))

    def here(df, prefix="_w_"):
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & df[k].eqNullSafe(F.col(f"{prefix}{i}"))
        return cond
    seen = ticks.join(broadcast_if_small(asked.drop("_names")), here(ticks), "left_semi")
    last = (seen.groupBy(*keys).agg(F.max(F.col("ts").cast("timestamp")).alias("_last")).where("_last IS NOT NULL"))
    last = last.join(asked, here(last)).select(*[f"_w_{i}" for i in range(len(keys))], "_names",
                                               to_market_time("_last", tz).alias("_last")).checkpoint()
    width = F.lit(96) + 24 * F.size("_names")
    for i in range(len(keys)):
        width = width + F.coalesce(F.octet_length(F.col(f"_w_{i}").cast("string")), F.lit(0)) + 16
    held = last.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    micros = F.lit(None).cast("long")
    for name in INTERVALS:
        micros = F.when(F.col("interval_name") == name, interval_seconds(name) * 1_000_000).otherwise(micros)
    small = held <= broadcast_limit(ticks.sparkSession)
    if small:
        rows = ticks.withColumn("_at", to_market_time("ts", tz))
        rows = rows.join(F.broadcast(last), here(rows) & (F.to_date("_at") == F.to_date("_last")))
        aggs = ohlc_aggs()
    else:
        rows = bar_partials(seen, "1minute", tz, keys).withColumnRenamed("bar_start", "_at")
        rows = rows.join(last, here(rows) & (F.to_date("_at") == F.to_date("_last")))
        aggs = merge_aggs()
    each = (rows.withColumn("interval_name", F.explode("_names")).withColumn("bar_start", _bucket(F.col("_at"), micros))
            .where(F.col("bar_start") == _bucket(F.col("_last"), micros)))
    agg = each.groupBy(*keys, "interval_name", "bar_start").agg(*aggs)
    return agg.select(*keys, "interval_name", "bar_start", format_local(F.col("bar_start")).alias("datetime"),
                      F.to_date(F.col("bar_start")).alias("trade_date"), *ohlc_out())


# --------------------------------------------------------------- partial bars

PARTIAL = ["open", "high", "low", "close", "volume", "oi", "last_ts", "open_order", "close_order"]


def bar_partials(ticks: DataFrame, interval: str = "1minute", tz: str = MARKET_TZ,
                 key: str | list[str] | None = None) -> DataFrame:
    """Bars that can be merged: beside ``bars``' columns the order numbers of the ticks that gave
    open and close (``open_order``, ``close_order``)."""
    keys = keys_of(ticks, key)
    start = F.window(to_market_time("ts", tz), INTERVALS.get(interval, interval)).start
    agg = ticks.groupBy(*keys, start.alias("bar_start")).agg(
        *ohlc_aggs(), F.min(tick_order()).alias("open_order"), F.max(tick_order()).alias("close_order"))
    return agg.select(*keys, "bar_start", F.to_date("bar_start").alias("trade_date"), *PARTIAL)


def merge_aggs() -> list[Column]:
    """Aggregates that merge partial bars into one, each over a fixed-width buffer."""
    return [
        F.min_by("open", "open_order").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_order").alias("close"),
        F.sum("volume").cast("long").alias("volume"),
        F.max_by("oi", "close_order").alias("oi"),
        F.max("last_ts").alias("last_ts"),
        F.min("open_order").alias("open_order"),
        F.max("close_order").alias("close_order"),
    ]


def roll_up(partials: DataFrame, interval: str, source: str = "1minute",
            key: str | list[str] | None = None) -> DataFrame:
    """Bars of ``interval`` from stored partial bars of a shorter one that divides it.

    Equal to ``bars`` over the ticks: open and close are those of the first and last tick by
    their order numbers, whatever order the partials come in.  No tick is read.
    """
    step = interval_seconds(interval)
    if step % interval_seconds(source):
        raise ValueError(f"bars of {source} do not make bars of {interval}")
    keys = keys_of(partials, key)
    start = _bucket(F.col("bar_start").cast("timestamp"), F.lit(step * 1_000_000))
    agg = partials.groupBy(*keys, start.alias("_start")).agg(*merge_aggs())
    return agg.select(*keys, F.col("_start").alias("bar_start"), format_local(F.col("_start")).alias("datetime"),
                      F.to_date("_start").alias("trade_date"), *ohlc_out())


def ohlc_quote(ticks: DataFrame, interval: str = "1d", key: str | list[str] | None = None,
               tz: str = MARKET_TZ, since=None) -> DataFrame:
    """Latest bar per instrument for a quote interval ``1d``/``I1``/``I30``.

    Output: ``key, datetime, open, high, low, close, volume, last_price``.
    """
    if interval not in ("1d", "I1", "I30"):
        raise ValueError(f"no quote bar of length {interval!r}; use 1d, I1 or I30")
    last = newest_bars(_since(ticks, since, tz), interval, tz, key)
    return last.select(*keys_of(ticks, key), "datetime", "open", "high", "low", "close", "volume",
                       F.col("close").alias("last_price"))


def full_market_quote(ticks: DataFrame, key: str | list[str] | None = None, tz: str = MARKET_TZ,
                      since=None) -> DataFrame:
    """Full quote per instrument (O23): the day bar of the instrument's latest
    market day as an ``ohlc`` struct, that day's ``volume``, the last ``oi``,
    ``last_price`` and ``timestamp`` (instant of the last tick).
    """
    last = newest_bars(_since(ticks, since, tz), "day", tz, key)
    return last.select(
        *keys_of(ticks, key),
        F.col("trade_date"),
        F.struct("open", "high", "low", "close").alias("ohlc"),
        F.col("close").alias("last_price"),
        "volume", "oi",
        F.col("last_ts").alias("timestamp"),
    )

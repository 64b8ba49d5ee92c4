"""Historical candles: time normalisation (O29), date-ranged history (O18),
today's bar (O19), trailing window (O13) and chunk coverage (O25)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.exprs import MARKET_TZ, format_local, lenient_date
from tickforge.operators.bars import key_columns, keys_of
from tickforge.schemas import CANDLE_COLUMNS


def normalise_candle_time(candles: DataFrame, col: str = "datetime", tz: str = MARKET_TZ) -> DataFrame:
    """Offset timestamp string -> market-zone ``yyyy-MM-dd HH:mm:ss`` plus
    ``trade_date`` (O29).  Unparseable strings give NULL, not an error.

    ``2023-01-31T09:15:00+05:30`` -> ``2023-01-31 09:15:00``.  Requires the session
    zone to be UTC.
    """
    local = F.from_utc_timestamp(F.try_to_timestamp(F.col(col)), tz)
    return (candles.withColumn("_local", local)
            .withColumns({col: format_local(F.col("_local")), "trade_date": F.to_date(F.col("_local"))})
            .drop("_local"))


def _as_date(v) -> Column:
    if isinstance(v, Column):
        return v
    if v is None:
        return F.lit(None).cast("date")
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.strftime("%Y-%m-%d")
    return F.to_date(F.lit(v))


def trailing_window(candles: DataFrame, as_of, days: int = 10,
                    date_col: str = "trade_date") -> DataFrame:
    """Candles of ``[as_of - 1 - days, as_of - 1]``: the ``days`` days before
    yesterday through yesterday (O13).  ``as_of`` is an argument, never the clock."""
    end = F.date_sub(_as_date(as_of), 1)
    return candles.where(F.col(date_col).between(F.date_sub(end, days), end))


#: Ranges of up to this many days are met day by day, longer ones month by month.
SHORT_DAYS = 7


def _span(df: DataFrame, low: str, high: str) -> Column:
    """(first, last) day of a table as one scalar subquery."""
    return df.select(F.struct(F.min(low).alias("first"), F.max(high).alias("last"))).scalar()


class Asked:
    """What checkpointed items ask for, by one small job: the days that the short and the long ranges
    span (None: there are none), and the values of a column among the items that end on ``day``."""

    def __init__(self, items: DataFrame, day=None, series: str | None = None):
        f, t = lenient_date("from_date"), lenient_date("to_date")
        length = F.datediff(t, f)
        short, long = (length >= 0) & (length < SHORT_DAYS), length >= SHORT_DAYS
        due = F.collect_set(F.when(t == day, F.col(series))) if series else F.lit(None)
        r = items.agg(*[F.struct(F.min(F.when(c, f)), F.max(F.when(c, t))).alias(n) for c, n in ((short, "short"), (long, "long"))],
                      due.alias("due")).first()
        self.short, self.long = ((tuple(x) if x[0] is not None else None) for x in (r.short, r.long))
        self.due = r.due or []


def _probes(items: DataFrame, low: Column, high: Column) -> tuple[DataFrame, DataFrame]:
    """Ranges of up to ``SHORT_DAYS`` days as a row per day, longer ones as a row per month of
    [low, high]; the day or month is ``_unit``."""
    length = F.datediff("_to", "_from")
    near = (items.where((length >= 0) & (length < SHORT_DAYS))
            .withColumn("_unit", F.explode(F.sequence("_from", "_to"))))
    first, last = F.greatest("_from", low), F.least("_to", high)
    months = F.when(first <= last, F.sequence(F.trunc(first, "MM"), last, F.expr("INTERVAL 1 MONTH")))
    # A table without candles has no days to clip to; then there is nothing to ask for.
    far = (items.where(length >= SHORT_DAYS)
           .withColumn("_unit", F.explode(F.when(low.isNotNull() & high.isNotNull(), months))))
    return near, far


def _in_range(items: DataFrame, candles: DataFrame, keys: list[str], days=None, known: Asked | None = None) -> DataFrame:
    """``items`` (columns ``_from``, ``_to``) with the candles of their instrument and range.

    A range of up to ``SHORT_DAYS`` days becomes a row per day and is joined on ``(key, day)``; a longer
    one a row per month -- clipped to the days that the candles have (``days``, else their first and
    last) -- joined on ``(key, month)`` with the range as a residual condition.  Each of the two scans only
    the days between the first and last that its items ask for, so one without items reads nothing, and a
    table stored by day is pruned to the days of the join as well.  Where these days are ``known`` they are
    constants, and a side without items is left out.
    """
    if days is None and not (known and known.long is None):
        span = _span(candles, "trade_date", "trade_date")
        days = (span.getField("first"), span.getField("last"))
    low, high = (_as_date(d) for d in days or (None, None))
    near, far = _probes(items, low, high)
    length = F.datediff("_to", "_from")
    short, long = items.where((length >= 0) & (length < SHORT_DAYS)), items.where(length >= SHORT_DAYS)
    out = None
    for side, asked, unit in ((near, short, F.col("_c_trade_date")), (far, long, F.trunc("_c_trade_date", "MM"))):
        if known is None:
            asked = _span(asked, "_from", "_to")
            first, last = asked.getField("first"), asked.getField("last")
        else:
            span = known.short if side is near else known.long
            if span is None and not (side is far and out is None):
                continue
            first, last = (_as_date(x) for x in span or (None, None))
        c = candles.where(F.col("trade_date").between(first, last))
        c = c.select(*[F.col(x).alias(f"_c_{x}") for x in dict.fromkeys([*keys, "trade_date", *CANDLE_COLUMNS, *(
            x for x in candles.columns if x.startswith("_"))])])
        cond = F.col("_unit") == unit
        for k in keys:
            cond = cond & (F.col(k) == F.col(f"_c_{k}"))
        if side is far:
            cond = cond & F.col("_c_trade_date").between(F.col("_from"), F.col("_to"))
        # The probe's size estimate ignores the explode and is no bound: AQE picks broadcast or
        # sort-merge from the measured size.
        met = side.join(c, cond).drop("_unit")
        out = met if out is None else out.unionByName(met)
    return out


def historical_data(requests: DataFrame, candles: DataFrame, key: str | list[str] | None = None,
                    from_col: str = "from_date", to_col: str = "to_date",
                    request_col: str | list[str] = "request_id", extra_keys: tuple[str, ...] = (),
                    days=None, known: Asked | None = None) -> DataFrame:
    """Per request, the candles of its instrument with ``from <= trade_date <= to``.

    ``key`` names the instrument's columns (by default what identifies one in ``candles``).  A range
    is met day by day or month by month (``_in_range``), so the join is an equi-join that spreads
    a heavily traded instrument over its days and prunes a date-partitioned candle table, and a request
    for all time costs no more rows than the table has months.  ``days=(first, last)`` gives the
    table's days where they are known; else a pass over ``trade_date`` finds them.
    Output columns: ``request_id, key, datetime, open, high, low, close, volume,
    oi`` -- sort with ``orderBy(request_id, datetime)`` where order matters.
    ``extra_keys`` (e.g. ``interval_name``) must match between request and candle.
    """
    keys, carry = keys_of(candles, key), key_columns(request_col)
    items = requests.select(*carry, *keys, *extra_keys, lenient_date(from_col).alias("_from"),
                            lenient_date(to_col).alias("_to"))
    met = _in_range(items, candles, [*keys, *extra_keys], days, known)
    return met.select(*carry, *keys, *[F.col(f"_c_{c}").alias(c) for c in CANDLE_COLUMNS])


def _quote_candles(full_quotes: DataFrame, keys: list[str], tz: str) -> DataFrame:
    """Full quotes that have ``ohlc`` and ``timestamp`` as candles, timed by the quote."""
    local = F.from_utc_timestamp(F.col("timestamp").cast("timestamp"), tz)
    q = full_quotes.where(F.col("ohlc").isNotNull() & F.col("timestamp").isNotNull())
    return q.select(*keys, F.to_date(local).alias("trade_date"), format_local(local).alias("datetime"),
                    *[F.col(f"ohlc.{c}").cast("double").alias(c) for c in ("open", "high", "low", "close")],
                    F.col("volume").cast("long").alias("volume"), F.col("oi").cast("long").alias("oi"))


def history_to_today(items: DataFrame, candles: DataFrame, full_quotes: DataFrame, today,
                     item_cols: list[str], key: str | list[str] | None = None, extra_keys: tuple[str, ...] = (),
                     tz: str = MARKET_TZ, days=None, known: Asked | None = None) -> DataFrame:
    """``historical_data`` per item, with today's bar from the full quote where it is due (O18 + O19).

    ``items`` carry ``item_cols`` (what makes an item, e.g. request and position), key columns,
    ``extra_keys``, ``from_date`` and ``to_date``.  An item gets the quote's bar when its range ends
    ``today``, candles of its own came back and none of them is today's -- decided per item, not
    per request.  The quotes take part in the one range join as marked candles of today; a window over
    the item, whose rows are sorted together anyway, drops those that are not due.
    """
    keys = keys_of(candles, key)
    day = _as_date(today)
    marked = candles.select(*keys, *extra_keys, "trade_date", *CANDLE_COLUMNS, F.lit(False).alias("_quoted"))
    quoted = _quote_candles(full_quotes, keys, tz).withColumns({"trade_date": day, "_quoted": F.lit(True)})
    for c in extra_keys:
        # A quote has no interval: it stands for today's bar at each that is asked for.
        asked = (items.where(lenient_date("to_date") == day).select(F.collect_set(c)).scalar() if known is None
                 else F.array(*[F.lit(x) for x in known.due]).cast("array<string>"))
        quoted = quoted.withColumn(c, F.explode(asked))
    rows = items.select(*item_cols, *[c for c in (*keys, *extra_keys) if c not in item_cols],
                        lenient_date("from_date").alias("_from"), lenient_date("to_date").alias("_to"))
    if days is None and not (known and known.long is None):
        days = _span(candles, "trade_date", "trade_date")
        days = (days.getField("first"), F.greatest(days.getField("last"), day))
    met = _in_range(rows, marked.unionByName(quoted), [*keys, *extra_keys], days, known)
    met = met.where(~F.col("_c__quoted") | (F.col("_to") == day))
    item = Window.partitionBy(*item_cols, "_from", "_to", *[c for c in (*keys, *extra_keys) if c not in item_cols])
    own = ~F.col("_c__quoted")
    met = met.withColumns({"_any": F.max(own).over(item), "_now": F.max(own & (F.col("_c_trade_date") == day)).over(item)})
    met = met.where(own | (F.col("_any") & ~F.col("_now")))
    return met.select(*rows.columns[:-2], *[F.col(f"_c_{c}").alias(c) for c in CANDLE_COLUMNS])


def backfill_today(candles: DataFrame, full_quotes: DataFrame, today,
                   key: str | list[str] | None = None, tz: str = MARKET_TZ,
                   range_ends_today: bool = True) -> DataFrame:
    """Append today's bar from the full quote where the candles lack it.

    An instrument (``key``: one column or several, by default what identifies it in ``candles``)
    gets the extra row only if it has candles, none of them is
    dated ``today``, and its full quote has ``ohlc`` and ``timestamp``; the row's
    ``datetime`` is the quote timestamp in market time.  Where the candles carry an
    ``interval_name``, this is decided per instrument and interval.  With
    ``range_ends_today=False`` the candles are returned unchanged (the service
    only adds the bar when the requested range ends today).
    """
    keys = keys_of(candles, key)
    series = keys + [c for c in ("interval_name",) if c in candles.columns and c not in keys]
    out_cols = [*series, "trade_date", *CANDLE_COLUMNS]
    base = candles.select(*out_cols)
    if not range_ends_today:
        return base
    day = _as_date(today)
    # One aggregate, combined map-side: a hot instrument costs one row per task.
    lacking = (candles.groupBy(*series).agg(F.max(F.col("trade_date").eqNullSafe(day)).alias("_today"))
               .where(~F.col("_today")).select(*series))
    added = _quote_candles(full_quotes, keys, tz).join(lacking, keys)
    return base.unionByName(added.select(*out_cols))


def chunk_coverage(chunks: DataFrame, candles: DataFrame, key: str | list[str] | None = None,
                   request_col: str = "request_id", failed: DataFrame | None = None,
                   requests: DataFrame | None = None, per_instrument: bool = False) -> DataFrame:
    """Planned vs returned chunks per request.

    ``chunks`` comes from ``plan_date_chunks`` (``chunk_no, chunk_from,
    chunk_to``) and carries the key columns (by default what identifies an instrument in
    ``candles``).  Per instrument the candle days and the running count of candles up to each are
    one row (no longer than the calendar); a chunk's candles are the count up to its last
    day less the count up to the day before its first, so no chunk is spread into days.

    Output per request: ``n_chunks``, ``empty_chunks``, ``n_candles``, ``retrieved``
    (how many of its instruments gave any candle) and, when ``failed`` (rows ``request_id,
    chunk_no`` of rejected chunk payloads, with key columns where an item is meant) is given,
    ``failed_chunks``.  ``per_instrument=True`` gives a row per request and instrument instead.  With
    ``requests`` a request that has no chunk (a reversed range) is listed too,
    with zero counts.
    """
    keys = keys_of(candles, key)
    daily = candles.where(F.col("trade_date").isNotNull()).groupBy(*keys, "trade_date").agg(F.count(F.lit(1)).alias("_n"))
    up_to = F.sum("_n").over(Window.partitionBy(*keys).orderBy("trade_date"))
    runs = (daily.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.struct("trade_date", up_to.alias("n")).alias("_d"))
            .groupBy(*[f"_c_{k}" for k in keys]).agg(F.sort_array(F.collect_list("_d")).alias("_run")))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_c_{k}"))

    def count_up_to(day: Column) -> Column:
        # Days are in order: the last one that is not later gives the count.
        return F.reduce("_run", F.lit(0).cast("long"), lambda n, x: F.when(x["trade_date"] <= day, x["n"]).otherwise(n))
    n = F.coalesce(count_up_to(F.col("chunk_to")) - count_up_to(F.date_sub("chunk_from", 1)), F.lit(0).cast("long"))
    plan = chunks.select(request_col, *[k for k in keys if k != request_col], "chunk_no", "chunk_from", "chunk_to")
    per_chunk = plan.join(runs, cond, "left").select(*plan.columns, n.alias("_n"))
    aggs = [F.count(F.lit(1)).alias("n_chunks"),
            F.sum(F.when(F.col("_n") == 0, 1).otherwise(0)).cast("long").alias("empty_chunks"),
            F.sum("_n").cast("long").alias("n_candles")]
    if failed is not None:
        on = [request_col, "chunk_no", *[k for k in keys if k in failed.columns and k != request_col]]
        marks = failed.select(*[F.col(c).alias(f"_f_{c}") for c in on]).distinct()
        met = F.lit(True)
        for c in on:
            met = met & F.col(c).eqNullSafe(F.col(f"_f_{c}"))
        per_chunk = per_chunk.join(marks, met, "left")
        aggs.append(F.sum(F.col("_f_chunk_no").isNotNull().cast("long")).cast("long").alias("failed_chunks"))
    item = [request_col, *[k for k in keys if k != request_col]]
    covered = per_chunk.groupBy(*item).agg(*aggs)
    counts = [c for c in covered.columns if c not in item]
    got = F.when(F.col("n_candles") > 0, 1).otherwise(0)
    if per_instrument:
        if requests is not None:
            asked = requests.select(*item).distinct()
            names = {c: f"_r_{c}" for c in item}
            same = F.lit(True)
            for c in item:
                same = same & F.col(c).eqNullSafe(F.col(names[c]))
            covered = asked.join(covered.withColumnsRenamed(names), same, "left").drop(*names.values()).na.fill(0, counts)
        return covered.withColumn("retrieved", got)
    covered = covered.withColumn("retrieved", got).groupBy(request_col).agg(
        *[F.sum(c).cast("long").alias(c) for c in counts], F.sum("retrieved").cast("int").alias("retrieved"))
    if requests is not None:
        covered = requests.select(request_col).distinct().join(covered, request_col, "left").na.fill(0, [*counts, "retrieved"])
    return covered

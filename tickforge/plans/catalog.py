"""Registered jobs over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each job runs over whole tables; every computed column is aliased to the name
its oracle SQL (``tickforge.plans.oracle``) uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.exprs import exchange_segment, format_local, to_market_time
from tickforge.functions.intervals import QUOTE_INTERVALS
from tickforge.operators import (
    backfill_index_symbols, backfill_today, bar_partials, bars, chunk_coverage, enrich_quotes,
    full_market_quote, historical_data, index_symbol_map, ltp_quote, merge_quote_batches,
    ohlc_quote, plan_date_chunks, plan_key_batches, quote_matrix, resolve_instruments,
    resolve_symbols, roll_up, trailing_window, unify_masters, unresolved_requests, validate_requests,
)
from tickforge.operators import endpoints as E
from tickforge.operators.history import normalise_candle_time
from tickforge.operators.joins import broadcast_if_small
from tickforge.operators.master import UNIFIED_COLUMNS
from tickforge.plans import staging, views as V
from tickforge.session import checkpoint_root, keep_buckets
from tickforge.sinks import (
    BarStore, list_master, request_status, save_candles, write_candles, write_master, write_ticks,
)
from tickforge.sources import (
    parse_candles, parse_quotes, read_master_a, read_master_b, read_master_json, read_requests,
)

Query = Callable[[SparkSession, str], DataFrame]

CANDLE_OUT = ["exchange_token", "datetime", "open", "high", "low", "close", "volume", "oi"]
MATRIX_TOKENS = [1, 2, 3, 4, 5]
MATRIX_FIELDS = ["last_price", "volume", "oi"]


# --- sources (O01-O06) -------------------------------------------------------

def q_master_a_csv(spark, d):
    m = V.master_view(spark, d).select("instrument_key", "exchange_token", "exchange",
                                       "tradingsymbol", "venue")
    back = read_master_a(spark, staging.stage_csv(m, "master_a"))
    return back.select("instrument_key", "exchange_token", "exchange", "tradingsymbol", "venue")


def q_master_b_csv(spark, d):
    m = V.master_b_view(spark, d).drop("src_pos")
    back = read_master_b(spark, staging.stage_csv(m, "master_b", gzip=False))
    return back.select("instrument_token", "exchange_token", "tradingsymbol", "name", "last_price",
                       F.date_format("expiry", "yyyy-MM-dd").alias("expiry"), "strike", "tick_size",
                       "lot_size", "instrument_type", "segment", "exchange")


def _master_json(spark, d):
    m = V.master_view(spark, d).select("instrument_key", F.col("tradingsymbol").alias("trading_symbol"),
                                       "exchange_token", "exchange", "venue")
    return read_master_json(spark, staging.stage_json_arrays(m, "master_json", "instrument_key"))


def q_master_json(spark, d):
    """``venue`` is no declared field: it is read from the record."""
    venue = F.expr("record:venue::string").alias("venue")
    return _master_json(spark, d).select("instrument_key", "trading_symbol", "exchange_token", "exchange", venue)


def q_requests_json(spark, d):
    r = V.requests_view(spark, d)
    back = read_requests(spark, staging.stage_json_lines(r, "requests"))
    return back.select("request_id", "pos", "exchange_token", "exchange", "instrument_type",
                       "interval_name")


def q_history_requests_json(spark, d):
    """O06 on history bodies: ``interval``, ``from_date`` and ``to_date`` as the service names them."""
    r = V.history_service_requests_view(spark, d).withColumnRenamed("interval_name", "interval")
    back = read_requests(spark, staging.stage_json_lines(r, "history-requests"))
    return back.select("request_id", "pos", "exchange_token", "exchange", "instrument_type", "interval_name",
                       "from_date", "to_date")


def q_quotes_parsed(spark, d):
    rows, _ = parse_quotes(V.quote_payloads(spark, d))
    return rows.select("batch_no", "quote_key", "instrument_token", F.col("last_price").alias("ltp"),
                       "volume", "oi")


def q_candles_parsed(spark, d):
    rows, _ = parse_candles(V.candle_payloads(spark, d))
    return rows.select(*CANDLE_OUT, F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))


def q_candle_time(spark, d):
    t = V.ticks_view(spark, d)
    raw = t.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                        F.lit("Z")).alias("datetime"))
    out = normalise_candle_time(raw)
    return out.select("event_id", "datetime", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))


# --- sinks (O07-O09) ---------------------------------------------------------

def q_master_list(spark, d):
    return list_master(V.master_view(spark, d),
                       ["instrument_key", "exchange_token", "exchange", "tradingsymbol", "venue", "src_pos"])


STORED_OUT = ["exchange", "exchange_token", "interval_name", "datetime", "open", "high", "low", "close", "volume", "oi"]


def q_candles_written(spark, d):
    """Candles of two exchanges and two intervals written by day and read back."""
    path = staging.staging_dir(spark, "candles")
    write_candles(V.exchange_candles_view(spark, d), path)
    back = spark.read.parquet(path)
    return back.select(*STORED_OUT, F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))


def _candle_table(spark, d) -> DataFrame:
    """CX as a bucketed catalog table of its own."""
    path = staging.staging_dir(spark, "candle-table")
    name = "candles_" + path.rsplit("-", 1)[1]
    return save_candles(V.exchange_candles_view(spark, d), name, path, buckets=spark.sparkContext.defaultParallelism)


def q_candles_saved(spark, d):
    """The same in a table bucketed by instrument inside its days."""
    return _candle_table(spark, d).select(*STORED_OUT, F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))


def q_request_status(spark, d):
    """Envelopes of the LTP endpoint, each item a request of its own; the batches of tokens
    that end in 9 failed."""
    r = V.requests_view(spark, d).drop("request_id").withColumn("request_id", F.col("pos"))
    rows, bad = E.ltp_for_requests(r, V.listed_master_view(spark, d), V.exchange_ticks_view(spark, d))
    return request_status(r, bad, rows, errors=r.where(F.col("exchange_token").endswith("9")))


# --- masters (O10-O11) -------------------------------------------------------

MASTER_OUT = [*UNIFIED_COLUMNS, "last_price", "expiry", "strike", "tick_size", "lot_size"]


def _feeds(spark, d):
    return {"FEED_A": V.master_view(spark, d), "Feed_B": V.master_b_view(spark, d)}


def q_unified_master(spark, d):
    return unify_masters(_feeds(spark, d)).select(*MASTER_OUT)


def q_master_data(spark, d):
    """``GET /master-data``: both feeds whole, with contract details."""
    return E.master_data(_feeds(spark, d), symbol_map=_index_map(spark, d)).select(*MASTER_OUT)


def q_master_written(spark, d):
    """O10 + O07: the unified master stored once as Parquet partitioned by broker."""
    path = staging.staging_dir(spark, "master")
    write_master(q_unified_master(spark, d), path)
    back = spark.read.parquet(path)
    return back.select(*MASTER_OUT)


def _index_map(spark, d):
    # Index-like instruments: the map covers the PROMO and SMALL types.
    keys = (V.master_view(spark, d)
            .where(F.col("exchange").endswith("_PROMO") | F.col("exchange").endswith("_SMALL"))
            .select("instrument_key"))
    return index_symbol_map(keys)


def q_index_backfill(spark, d):
    out = backfill_index_symbols(_master_json(spark, d), _index_map(spark, d))
    return out.select("instrument_key", "trading_symbol")


# --- requests (O12, O14-O16) -------------------------------------------------

def q_rejected_requests(spark, d):
    _, rejects = validate_requests(V.requests_view(spark, d), intervals=QUOTE_INTERVALS)
    return rejects.select("request_id", "pos", "reason")


def q_resolved(spark, d):
    ok, _ = resolve_instruments(V.requests_view(spark, d), V.listed_master_view(spark, d))
    return ok.select("request_id", "pos", F.col("token_int").alias("exchange_token"), "instrument_key")


def q_resolved_symbol(spark, d):
    ok, _ = resolve_symbols(V.requests_view(spark, d), V.listed_master_b_view(spark, d))
    return ok.select("request_id", "pos", F.col("token_int").alias("exchange_token"), "symbol_key")


def q_unresolved_symbol(spark, d):
    _, bad = resolve_symbols(V.requests_view(spark, d), V.listed_master_b_view(spark, d))
    return bad.select("request_id", "pos", "exchange_token", "reason")


def q_unresolved(spark, d):
    bad = unresolved_requests(V.requests_view(spark, d), V.listed_master_view(spark, d))
    return bad.select("request_id", "pos", "exchange_token", "reason")


# --- quotes (O17, O20-O23, O26) ---------------------------------------------

def _enriched(spark, d):
    rows, _ = parse_quotes(V.quote_payloads(spark, d))
    ok, _ = enrich_quotes(rows, V.listed_master_view(spark, d))
    return ok


def q_quotes_enriched(spark, d):
    return _enriched(spark, d).select("batch_no", "quote_key", "instrument_token", "exchange",
                                      "exchange_token", "trading_symbol", "instrument_type", "last_price", "volume", "oi")


MERGED = ["exchange", "exchange_token", "batch_no", "entry_pos", "quote_key", "instrument_token",
          "trading_symbol", "instrument_type", "last_price", "volume", "oi"]


def q_quotes_merged(spark, d):
    return merge_quote_batches(_enriched(spark, d).select(*MERGED)).drop("entry_pos")


def q_quotes_merged_legacy(spark, d):
    """The service's own key: equal tokens of two exchanges overwrite each other."""
    return merge_quote_batches(_enriched(spark, d).select(*MERGED), key_cols=["exchange_token"]).drop("entry_pos")


def q_quote_matrix(spark, d):
    return quote_matrix(q_quotes_merged_legacy(spark, d), MATRIX_TOKENS, MATRIX_FIELDS)


def q_ltp(spark, d):
    return ltp_quote(V.ticks_view(spark, d))


def _ohlc(interval):
    def q(spark, d):
        return ohlc_quote(V.ticks_view(spark, d), interval)
    return q


def q_full_quote(spark, d):
    fq = full_market_quote(V.ticks_view(spark, d))
    return _flat_quote(fq)


def q_full_quote_stored(spark, d):
    """O23 over ticks stored by market day, for instruments traded since a day: older
    partitions are not read."""
    path = staging.staging_dir(spark, "ticks-by-day")
    write_ticks(V.ticks_view(spark, d), path)
    return _flat_quote(full_market_quote(spark.read.parquet(path), since=V.AS_OF))


def _flat_quote(fq):
    carry = [c for c in ("request_id", "pos", "instrument_key") if c in fq.columns]
    return fq.select(*carry, "exchange_token", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
                     "ohlc.open", "ohlc.high", "ohlc.low", "ohlc.close", "last_price", "volume", "oi",
                     format_local(to_market_time("timestamp")).alias("timestamp"))


def q_full_quote_enriched(spark, d):
    """Flagship: full quote per instrument with its symbol and type (NULL where the master
    does not list it)."""
    fq = _flat_quote(full_market_quote(V.ticks_view(spark, d)))
    m = V.master_view(spark, d).select(F.col("exchange_token").alias("_mt"),
                                       F.col("tradingsymbol").alias("trading_symbol"),
                                       exchange_segment("exchange").alias("instrument_type"))
    out = fq.join(broadcast_if_small(m), fq["exchange_token"] == m["_mt"], "left")
    return out.select("exchange_token", "trading_symbol", "instrument_type", "trade_date", "open", "high",
                      "low", "close", "last_price", "volume", "oi", "timestamp")


def _bars(interval):
    def q(spark, d):
        return bars(V.ticks_view(spark, d), interval).select(*CANDLE_OUT)
    return q


def _partials(spark, d) -> DataFrame:
    """Minute partial bars of T, stored by day."""
    path = staging.staging_dir(spark, "minute-bars")
    bar_partials(V.ticks_view(spark, d), "1minute").write.partitionBy("trade_date").parquet(path)
    return spark.read.parquet(path)


def _rolled(interval):
    def q(spark, d):
        return roll_up(_partials(spark, d), interval).select(*CANDLE_OUT)
    return q


def q_bars_incremental(spark, d):
    """O24 kept up to date: the days up to AS_OF land first, some ticks with a wrong price; then the rest
    with the corrections, once and again.  The minute bars are those of a rebuild."""
    t = V.ticks_view(spark, d)
    early = F.to_date(to_market_time("ts")) <= F.lit(V.AS_OF).cast("date")
    wrong = early & (F.col("qty") > 90)
    store = BarStore(spark, staging.staging_dir(spark, "bar-store"))
    store.merge(t.where(early).withColumn("price", F.when(wrong, F.col("price") * 2).otherwise(F.col("price"))), first=True)
    for _ in range(2):
        store.merge(t.where(~early | wrong))
    return store.bars.select("exchange_token", format_local("bar_start").alias("datetime"), "open", "high", "low", "close",
                             "volume", "oi")


# --- history (O13, O18, O19, O25, O27, O28) ---------------------------------

def q_trailing_window(spark, d):
    out = trailing_window(V.candles_view(spark, d), V.AS_OF, days=10)
    return out.select(*CANDLE_OUT)


def q_trailing_window_stored(spark, d):
    """O13 over candles stored by day: the window prunes date partitions."""
    path = staging.staging_dir(spark, "candles-by-day")
    write_candles(V.candles_view(spark, d), path)
    return trailing_window(spark.read.parquet(path), V.AS_OF, days=10).select(*CANDLE_OUT)


def q_historical(spark, d):
    h = historical_data(V.history_requests_view(spark, d), V.candles_view(spark, d))
    return h.select("request_id", *CANDLE_OUT)


def q_historical_stored(spark, d):
    """O18 over a candle table partitioned by day and bucketed by instrument: the join prunes
    days at run time and does not shuffle the candles."""
    keep_buckets(spark)
    h = historical_data(V.exchange_history_view(spark, d), _candle_table(spark, d), request_col=["request_id", "pos"],
                        extra_keys=("interval_name",))
    return h.select("request_id", "pos", "exchange", *CANDLE_OUT)


def q_today_backfill(spark, d):
    """Today's bar missing where it was a down bar (close < open), per exchange and interval; the full
    quote lacks its timestamp where that day's volume is under 50."""
    c = V.exchange_candles_view(spark, d)
    today = F.lit(V.TODAY).cast("date")
    c = c.where(~((F.col("trade_date") == today) & (F.col("close") < F.col("open"))))
    fq = full_market_quote(V.exchange_ticks_view(spark, d))
    fq = fq.withColumn("timestamp", F.when(F.col("volume") < 50, F.lit(None))
                       .otherwise(F.col("timestamp")))
    out = backfill_today(c, fq, V.TODAY)
    return out.select(*STORED_OUT, F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))


def q_chunk_coverage(spark, d):
    h = V.history_requests_view(spark, d)
    return chunk_coverage(plan_date_chunks(h, days=3), V.candles_view(spark, d), requests=h)


def _item_chunks(spark, d):
    """HX's items planned in chunks of 5 days (those for all time left out: a million chunks each);
    the payload of every second chunk of the tokens that end in 3 failed."""
    h = V.exchange_history_view(spark, d)
    chunks = plan_date_chunks(h.where("to_date < DATE'9999-01-01'"), days=5)
    failed = chunks.where((F.col("chunk_no") % 2 == 1) & (F.col("exchange_token") % 10 == 3))
    return h, chunks, failed.select("request_id", "chunk_no", "exchange", "exchange_token")


def q_chunk_coverage_items(spark, d):
    """O25 per request and instrument of two exchanges, failed payloads counted."""
    h, chunks, failed = _item_chunks(spark, d)
    return chunk_coverage(chunks, V.exchange_candles_view(spark, d).where("interval_name = 'day'"), failed=failed,
                          requests=h, per_instrument=True)


def _key_batches(size):
    def q(spark, d):
        return plan_key_batches(V.batch_keys_view(spark, d), size)
    return q


def q_key_batches_symbols(spark, d):
    """Feed-B LTP batches: resolved ``EXCHANGE:SYMBOL`` keys, 750 per call."""
    ok, _ = resolve_symbols(V.requests_view(spark, d), V.listed_master_b_view(spark, d))
    keys = ok.select("request_id", "pos", "symbol_key")
    return plan_key_batches(keys, 750, key_col="symbol_key")


def q_date_chunks(spark, d):
    ch = plan_date_chunks(V.date_ranges_view(spark, d), days=1000)
    return ch.select("request_id", "chunk_no",
                     F.date_format("chunk_from", "yyyy-MM-dd").alias("chunk_from"),
                     F.date_format("chunk_to", "yyyy-MM-dd").alias("chunk_to"))


def q_date_chunks_legacy(spark, d):
    ch = plan_date_chunks(V.date_ranges_view(spark, d), days=1000, legacy=True)
    return ch.select("request_id", "chunk_no",
                     F.date_format("chunk_from", "yyyy-MM-dd").alias("chunk_from"),
                     F.date_format("chunk_to", "yyyy-MM-dd").alias("chunk_to"))


# --- endpoints over request tables ------------------------------------------

def _endpoint(spark, d):
    return V.requests_view(spark, d), V.listed_master_view(spark, d), V.exchange_ticks_view(spark, d)


OHLC_OUT = ["request_id", "pos", "instrument_key", "datetime", "open", "high", "low", "close", "volume",
            "last_price"]


def q_ltp_for_requests(spark, d):
    rows, _ = E.ltp_for_requests(*_endpoint(spark, d))
    return rows.select("request_id", "pos", "instrument_key", "last_price", "last_time")


def q_ltp_for_symbols(spark, d):
    rows, _ = E.ltp_for_symbols(V.requests_view(spark, d), V.listed_master_b_view(spark, d),
                                V.exchange_ticks_view(spark, d))
    return rows.select("request_id", "pos", "symbol_key", "last_price", "last_time")


def q_ohlc_for_requests(spark, d):
    """Each item gets the bar its own interval names."""
    rows, _ = E.ohlc_for_requests(*_endpoint(spark, d))
    return rows.select(*OHLC_OUT, "interval_name")


def q_ohlc_for_requests_i30(spark, d):
    rows, _ = E.ohlc_for_requests(*_endpoint(spark, d), "I30")
    return rows.select(*OHLC_OUT)


def q_ohlc_rejects(spark, d):
    requests, master, _ = _endpoint(spark, d)
    _, bad = E.ohlc_items(requests, master)
    return bad.select("request_id", "pos", "reason")


def q_full_quote_for_requests(spark, d):
    rows, _ = E.full_quote_for_requests(*_endpoint(spark, d))
    return _flat_quote(rows).drop("exchange_token")


def _history_job(spark, d):
    # Candles are a table: made once here, not once per pass over them.
    checkpoint_root(spark)
    return E.historical_for_requests(V.history_service_requests_view(spark, d), V.listed_master_view(spark, d),
                                     V.exchange_candles_view(spark, d).checkpoint(), full_market_quote(V.exchange_ticks_view(spark, d)),
                                     V.TODAY, intervals=["day", "30minute"])


def q_historical_for_requests(spark, d):
    """Several items per request, candles of two exchanges and two intervals, today's bar per item."""
    return _history_job(spark, d)[0]


def q_historical_rejects(spark, d):
    return _history_job(spark, d)[1].select("request_id", "pos", "reason")


def queries() -> dict[str, Query]:
    from tickforge.streaming import catalog as streams
    q: dict[str, Query] = {
        "master_a_csv": q_master_a_csv,
        "master_b_csv": q_master_b_csv,
        "master_json": q_master_json,
        "requests_json": q_requests_json,
        "history_requests_json": q_history_requests_json,
        "quotes_parsed": q_quotes_parsed,
        "candles_parsed": q_candles_parsed,
        "candle_time": q_candle_time,
        "master_list": q_master_list,
        "candles_written": q_candles_written,
        "candles_saved": q_candles_saved,
        "request_status": q_request_status,
        "unified_master": q_unified_master,
        "master_written": q_master_written,
        "master_data": q_master_data,
        "index_backfill": q_index_backfill,
        "rejected_requests": q_rejected_requests,
        "trailing_window": q_trailing_window,
        "trailing_window_stored": q_trailing_window_stored,
        "resolved": q_resolved,
        "resolved_symbol": q_resolved_symbol,
        "unresolved": q_unresolved,
        "unresolved_symbol": q_unresolved_symbol,
        "quotes_enriched": q_quotes_enriched,
        "historical": q_historical,
        "historical_stored": q_historical_stored,
        "today_backfill": q_today_backfill,
        "quotes_merged": q_quotes_merged,
        "quotes_merged_legacy": q_quotes_merged_legacy,
        "ltp": q_ltp,
        "ohlc_1d": _ohlc("1d"),
        "ohlc_i1": _ohlc("I1"),
        "ohlc_i30": _ohlc("I30"),
        "full_quote": q_full_quote,
        "full_quote_stored": q_full_quote_stored,
        "full_quote_enriched": q_full_quote_enriched,
        "bars_1minute": _bars("1minute"),
        "bars_5minute": _bars("5minute"),
        "bars_30minute": _bars("30minute"),
        "bars_day": _bars("day"),
        "bars_5minute_rolled": _rolled("5minute"),
        "bars_30minute_rolled": _rolled("30minute"),
        "bars_day_rolled": _rolled("day"),
        "bars_incremental": q_bars_incremental,
        "chunk_coverage": q_chunk_coverage,
        "chunk_coverage_items": q_chunk_coverage_items,
        "quote_matrix": q_quote_matrix,
        "key_batches_750": _key_batches(750),
        "key_batches_450": _key_batches(450),
        "key_batches_symbols": q_key_batches_symbols,
        "date_chunks": q_date_chunks,
        "date_chunks_legacy": q_date_chunks_legacy,
        "ltp_for_requests": q_ltp_for_requests,
        "ltp_for_symbols": q_ltp_for_symbols,
        "ohlc_for_requests": q_ohlc_for_requests,
        "ohlc_for_requests_i30": q_ohlc_for_requests_i30,
        "ohlc_rejects": q_ohlc_rejects,
        "full_quote_for_requests": q_full_quote_for_requests,
        "historical_for_requests": q_historical_for_requests,
        "historical_rejects": q_historical_rejects,
    }
    q.update(streams.queries())
    return q

"""Declared schemas for the data model (instrument masters, requests, payloads, candles)."""

from pyspark.sql import types as T

# Columns of the feed-A master that are typed by name; every other column of the
# file is kept as a string.
MASTER_A_TYPES = {
    "instrument_key": T.StringType(),
    "exchange_token": T.LongType(),
    "exchange": T.StringType(),
    "tradingsymbol": T.StringType(),
}

# Feed-B master: the full column list, ``strike`` forced to double.
MASTER_B_TYPES = {
    "instrument_token": T.LongType(),
    "exchange_token": T.LongType(),
    "tradingsymbol": T.StringType(),
    "name": T.StringType(),
    "last_price": T.DoubleType(),
    "expiry": T.DateType(),
    "strike": T.DoubleType(),
    "tick_size": T.DoubleType(),
    "lot_size": T.LongType(),
    "instrument_type": T.StringType(),
    "segment": T.StringType(),
    "exchange": T.StringType(),
}

# Declared fields of the JSON master; all others stay in its VARIANT column.
MASTER_JSON_TYPES = {
    "instrument_key": T.StringType(),
    "trading_symbol": T.StringType(),
    "exchange_token": T.LongType(),
    "exchange": T.StringType(),
}

# One request item: all strings, as received.
REQUEST = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("exchange_token", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("instrument_type", T.StringType()),
    T.StructField("interval_name", T.StringType()),
])

# A landed request item may also carry the history body's fields.
REQUEST_BODY = T.StructType([
    *REQUEST.fields,
    T.StructField("interval", T.StringType()),
    T.StructField("from_date", T.StringType()),
    T.StructField("to_date", T.StringType()),
])

OHLC = T.StructType([
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
])

# Value of one entry in a quote payload's ``data`` map.  LTP, OHLC and full
# quotes share it; fields a payload lacks come back NULL.
QUOTE_ENTRY = T.StructType([
    T.StructField("instrument_token", T.StringType()),
    T.StructField("last_price", T.DoubleType()),
    T.StructField("ohlc", OHLC),
    T.StructField("volume", T.StringType()),      # vendors also send 1200.0
    T.StructField("oi", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

QUOTE_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.MapType(T.StringType(), QUOTE_ENTRY)),
])

# Candle payload: positional 7-slot arrays, read as strings then cast per slot.
CANDLE_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("candles", T.ArrayType(T.ArrayType(T.StringType()))),
    ])),
])

# The candle table's fixed output columns, in order.
CANDLE_COLUMNS = ["datetime", "open", "high", "low", "close", "volume", "oi"]

"""Quote/candle payload parsing, enrichment, merge and matrix."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickforge.operators import enrich_quotes, merge_quote_batches, quote_matrix
from tickforge.operators.history import normalise_candle_time
from tickforge.sources import parse_candles, parse_quotes


@pytest.fixture()
def master(spark):
    return spark.createDataFrame([
        ("NSE_EQ|INE1", 21195, "NSE_EQ", "ABC", 0),
        ("BSE_EQ|INE2", 21195, "BSE_EQ", "ABC-B", 1),
        ("NSEIDX|X", 7, "NSEIDX", "IDX", 2),
    ], "instrument_key string, exchange_token int, exchange string, tradingsymbol string, src_pos long")


def test_parse_quotes_envelopes(spark):
    payloads = spark.createDataFrame([
        (0, '{"status":"success","data":{"NSE_EQ:ABC":{"instrument_token":"NSE_EQ|INE1","last_price":10.5,'
            '"volume":7,"extra":{"depth":[1,2]}},"B":{"last_price":1.0}}}'),
        (1, '{"status":"error","errors":[{"message":"bad key"}]}'),
        (2, '{"status":"success"}'),
        (3, "<html>not json</html>"),
        (4, '{"status":"success","data":{}}'),
    ], "batch_no long, payload string")
    good, bad = parse_quotes(payloads, keep_raw=True)
    assert rows(bad, "batch_no", "reason") == [(1, "not_success"), (2, "missing_data"), (3, "not_json_or_empty")]
    g = {r.quote_key: r for r in good.collect()}
    assert set(g) == {"NSE_EQ:ABC", "B"}
    assert g["NSE_EQ:ABC"].last_price == 10.5 and g["NSE_EQ:ABC"].volume == 7
    assert g["NSE_EQ:ABC"].entry_pos == 0 and g["B"].entry_pos == 1
    assert g["B"].instrument_token is None
    assert '"depth":[1,2]' in g["NSE_EQ:ABC"].raw          # pass-through field kept


def test_enrich_quotes_rejects(spark, master):
    q = spark.createDataFrame([
        (0, 0, "NSE_EQ|INE1", 1.0), (0, 1, None, 2.0), (0, 2, "NONE|1", 3.0), (0, 3, "NSEIDX|X", 4.0),
    ], "batch_no long, entry_pos long, instrument_token string, last_price double")
    ok, bad = enrich_quotes(q, master)
    assert rows(ok, "instrument_token", "exchange_token", "trading_symbol", "instrument_type") == [
        ("NSEIDX|X", 7, "IDX", None),              # exchange without '_' -> no type, no error
        ("NSE_EQ|INE1", 21195, "ABC", "EQ"),
    ]
    assert rows(bad, "entry_pos", "reason") == [(1, "missing_instrument_token"), (2, "unknown_instrument")]


def test_merge_last_write_wins(spark):
    q = spark.createDataFrame([
        ("NSE", 21195, 0, 5, 1.0), ("NSE", 21195, 1, 0, 2.0), ("NSE", 21195, 1, 3, 3.0),
        ("BSE", 21195, 0, 9, 9.0),
    ], "exchange string, exchange_token int, batch_no long, entry_pos long, last_price double")
    full = merge_quote_batches(q)                                    # default key keeps exchanges apart
    assert rows(full, "exchange", "last_price") == [("BSE", 9.0), ("NSE", 3.0)]
    legacy = merge_quote_batches(q, key_cols=["exchange_token"])     # original key: later batch wins
    assert rows(legacy, "exchange_token", "last_price") == [(21195, 3.0)]


def test_quote_matrix(spark):
    q = spark.createDataFrame([(1, 10.0, 5), (2, 20.0, 6), (3, 30.0, 7)],
                              "exchange_token long, last_price double, volume long")
    m = quote_matrix(q, [1, 2, 4], ["last_price", "volume"])
    assert m.columns == ["field", "tok_1", "tok_2", "tok_4"]
    assert rows(m) == [("last_price", 10.0, 20.0, None), ("volume", 5.0, 6.0, None)]
    with pytest.raises(ValueError):
        quote_matrix(q, [], ["volume"])


def test_parse_candles(spark):
    payloads = spark.createDataFrame([
        (1, '{"status":"success","data":{"candles":[["2023-01-31T09:15:00+05:30",1.5,2,1,1.75,100,7],'
            '["2023-01-31T15:29:00+05:30",1,1,1,1,3]]}}'),
        (2, '{"status":"success","data":{"candles":[]}}'),
        (3, '{"status":"failure"}'),
        (4, '{"status":"success","data":{}}'),
        (5, "garbage"),
    ], "exchange_token long, payload string")
    good, bad = parse_candles(payloads)
    assert rows(good, "exchange_token", "datetime", "open", "high", "close", "volume", "oi") == [
        (1, "2023-01-31 09:15:00", 1.5, 2.0, 1.75, 100, 7),
        (1, "2023-01-31 15:29:00", 1.0, 1.0, 1.0, 3, None),       # 6-slot candle: oi NULL
    ]
    assert str(good.first().trade_date) == "2023-01-31"
    assert rows(bad, "exchange_token", "reason") == [(3, "not_success"), (4, "missing_data"),
                                                     (5, "not_json_or_empty")]


def test_normalise_candle_time_zone(spark):
    df = spark.createDataFrame([("2024-01-01T20:00:00Z",), ("2024-01-01T09:15:00+05:30",), ("nope",)], "datetime string")
    out = normalise_candle_time(df)
    assert sorted((r.datetime, str(r.trade_date)) for r in out.collect() if r.datetime) == [
        ("2024-01-01 09:15:00", "2024-01-01"), ("2024-01-02 01:30:00", "2024-01-02")]
    assert sum(r.datetime is None for r in out.collect()) == 1


def test_parse_quotes_variant_pass_through(spark):
    payloads = spark.createDataFrame([(0, '{"status":"success","data":{"K":{"last_price":1.5,'
                                          '"depth":{"buy":[{"price":1.4,"quantity":10}]}}}}')],
                                     "batch_no long, payload string")
    good, _ = parse_quotes(payloads, keep_raw=True, raw_as_variant=True)
    r = good.select(F.variant_get("raw", "$.depth.buy[0].quantity", "int").alias("q"), "last_price").first()
    assert (r.q, r.last_price) == (10, 1.5)

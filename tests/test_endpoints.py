"""Endpoint compositions over request tables."""

from pyspark.sql import functions as F

from conftest import rows
from tickforge.operators import full_market_quote
from tickforge.operators.endpoints import (
    historical_for_requests, ltp_for_requests, master_data, ohlc_for_requests,
)
from tickforge.sinks import request_status

MASTER = [("NSE_EQ|A", 1, "NSE_EQ", "A", 0), ("NSE_EQ|B", 2, "NSE_EQ", "B", 1),
          ("NSE_INDEX|Nifty 50", 3, "NSE_INDEX", "", 2)]
MSCHEMA = "instrument_key string, exchange_token int, exchange string, tradingsymbol string, src_pos long"


def _ticks(spark):
    data = [(1, 1, "2024-01-02 04:00:00", 10.0, 1, 0), (2, 1, "2024-01-02 05:00:00", 11.0, 2, 0),
            (3, 2, "2024-01-02 04:30:00", 20.0, 3, 0), (4, 2, "2024-01-03 04:30:00", 21.0, 4, 0)]
    return spark.createDataFrame(data, "event_id long, exchange_token long, ts string, price double, qty long, "
                                       "oi long").withColumn("ts", F.to_timestamp("ts"))


def test_master_data(spark):
    m = master_data({"feed_a": spark.createDataFrame(MASTER, MSCHEMA)})
    assert rows(m, "instrument_key", "tradingsymbol", "instrument_type") == [
        ("NSE_EQ|A", "A", "EQ"), ("NSE_EQ|B", "B", "EQ"), ("NSE_INDEX|Nifty 50", "NIFTY 50", "INDEX")]


def test_quotes_for_requests(spark):
    master = spark.createDataFrame(MASTER, MSCHEMA)
    req = spark.createDataFrame([(1, 0, "1", "NSE", "EQ"), (1, 1, "2", None, "EQ"), (2, 0, "9", "NSE", "EQ"),
                                 (3, 0, "3", "NSE", "INDEX")],
                                "request_id long, pos long, exchange_token string, exchange string, "
                                "instrument_type string")
    got, bad = ltp_for_requests(req, master, _ticks(spark))
    assert rows(got, "request_id", "pos", "exchange_token", "last_price") == [(1, 0, 1, 11.0), (1, 1, 2, 21.0)]
    st = request_status(req, bad, got)
    assert rows(st, "request_id", "status_code") == [(1, 200), (2, 400), (3, 404)]
    o, _ = ohlc_for_requests(req, master, _ticks(spark), "1d")
    assert rows(o, "request_id", "pos", "datetime", "open") == [(1, 0, "2024-01-02 00:00:00", 10.0),
                                                                (1, 1, "2024-01-03 00:00:00", 21.0)]


def test_historical_for_requests(spark):
    master = spark.createDataFrame(MASTER, MSCHEMA)
    ticks = _ticks(spark)
    from tickforge.operators import bars
    candles = bars(ticks, "day").withColumn("interval_name", F.lit("day"))
    req = spark.createDataFrame([
        (10, "1", "NSE", "EQ", "day", "2024-01-01", "2024-01-03"),     # ends today, lacks today's bar
        (11, "2", "NSE", "EQ", "day", "2024-01-01", "2024-01-03"),     # has today's bar
        (12, "2", "NSE", "EQ", "1minute", "2024-01-01", "2024-01-03"),  # no candles at that interval
        (13, "1", "NSE", "EQ", None, "2024-01-01", "2024-01-03"),      # missing parameter
        (14, "7", "NSE", "EQ", "day", "2024-01-01", "2024-01-03"),     # not in master
    ], "request_id long, exchange_token string, exchange string, instrument_type string, interval_name string, "
       "from_date string, to_date string")
    fq = full_market_quote(ticks).withColumn("timestamp", F.to_timestamp(F.lit("2024-01-03 06:00:00")))
    out, bad = historical_for_requests(req, master, candles, fq, "2024-01-03")
    for part in out.rdd.glom().collect():                    # time order inside each request
        seq = [(r.request_id, r.datetime) for r in part]
        assert seq == sorted(seq)
    assert rows(out, "request_id", "datetime") == [
        (10, "2024-01-02 00:00:00"), (10, "2024-01-03 11:30:00"),
        (11, "2024-01-02 00:00:00"), (11, "2024-01-03 00:00:00")]
    assert rows(bad, "request_id", "reason") == [(12, "bad_interval"), (13, "missing_parameters"), (14, "not_in_master")]


def test_history_rejects_bad_dates(spark):
    master = spark.createDataFrame(MASTER, MSCHEMA)
    candles = spark.createDataFrame([], "exchange_token long, trade_date date, datetime string, open double, "
                                        "high double, low double, close double, volume long, oi long")
    req = spark.createDataFrame([(1, "1", "NSE", "EQ", "day", "2024-02-30", "2024-03-01")],
                                "request_id long, exchange_token string, exchange string, instrument_type string, "
                                "interval_name string, from_date string, to_date string")
    out, bad = historical_for_requests(req, master, candles)
    assert out.count() == 0
    assert rows(bad, "request_id", "reason") == [(1, "bad_date")]


HREQ = ("request_id long, pos long, exchange_token string, exchange string, instrument_type string, interval_name string, "
        "from_date string, to_date string")


def _two_exchanges(spark):
    """Token 1 on two exchanges (day and 30-minute candles), token 2 without candles."""
    master = spark.createDataFrame([("NSE_EQ|A", 1, "NSE_EQ", "A", 0), ("BSE_EQ|A", 1, "BSE_EQ", "A", 1),
                                    ("NSE_EQ|B", 2, "NSE_EQ", "B", 2)], MSCHEMA)
    data = [("NSE", 1, "day", "2024-01-02 00:00:00", 1.0), ("NSE", 1, "day", "2024-01-03 00:00:00", 2.0),
            ("BSE", 1, "day", "2024-01-02 00:00:00", 11.0), ("NSE", 1, "30minute", "2024-01-02 09:30:00", 5.0)]
    candles = (spark.createDataFrame(data, "exchange string, exchange_token long, interval_name string, datetime string, open double")
               .selectExpr("*", "to_date(substring(datetime, 1, 10)) AS trade_date", "open AS high", "open AS low",
                           "open AS close", "1L AS volume", "0L AS oi"))
    q = spark.createDataFrame([(x, t, (7.0, 8.0, 6.0, 7.5), 3, 4, "2024-01-03 05:00:00")
                               for x, t in (("NSE", 1), ("BSE", 1), ("NSE", 2))],
                              "exchange string, exchange_token long, ohlc struct<open:double,high:double,low:double,close:double>, "
                              "volume long, oi long, timestamp string").withColumn("timestamp", F.to_timestamp("timestamp"))
    return master, candles, q


def test_today_is_decided_per_item(spark):
    """One request: A has today's bar, the other exchange lacks it, B has no candles at all."""
    master, candles, q = _two_exchanges(spark)
    req = spark.createDataFrame([
        (1, 0, "1", "NSE", "EQ", "1day", "2024-01-01", "2024-01-03"), (1, 1, "1", "BSE", "EQ", "day", "2024-01-01", "2024-01-03"),
        (1, 2, "2", "NSE", "EQ", "day", "2024-01-01", "2024-01-03"), (1, 3, "1", "NSE", "EQ", "30minute", "2024-01-01", "2024-01-03"),
        (1, 4, "1", "BSE", "EQ", "1d", "2024-01-01", "2024-01-02"), (1, 5, "1", "NSE", "EQ", "2hour", "2024-01-01", "2024-01-03"),
        (1, 6, "1", "NSE", "EQ", "5minute", "2024-01-01", "2024-01-03"), (None, 0, "1", "BSE", "EQ", "day", "2024-01-03", "2024-01-03"),
    ], HREQ)
    out, bad = historical_for_requests(req, master, candles, q, "2024-01-03")
    today = "2024-01-03 10:30:00"
    assert rows(out, "request_id", "pos", "exchange", "interval_name", "datetime", "open") == [
        (1, 0, "NSE", "1day", "2024-01-02 00:00:00", 1.0), (1, 0, "NSE", "1day", "2024-01-03 00:00:00", 2.0),
        (1, 1, "BSE", "day", "2024-01-02 00:00:00", 11.0), (1, 1, "BSE", "day", today, 7.0),
        (1, 3, "NSE", "30minute", "2024-01-02 09:30:00", 5.0), (1, 3, "NSE", "30minute", today, 7.0),
        (1, 4, "BSE", "1d", "2024-01-02 00:00:00", 11.0)]
    assert rows(bad, "pos", "reason") == [(5, "bad_interval"), (6, "bad_interval")]
    named, none = historical_for_requests(req, master, candles, q, "2024-01-03", intervals=["day"])
    assert rows(none, "pos") == [(3,), (5,), (6,)] and rows(named, "pos") == [(0,), (0,), (1,), (1,), (4,)]


def test_history_is_sorted_per_item(spark):
    master, candles, q = _two_exchanges(spark)
    req = spark.createDataFrame([(1, k, "1", "NSE", "EQ", "day", "2024-01-01", "2024-01-03") for k in range(200)], HREQ)
    for quotes, today in ((None, None), (q, "2024-01-03")):
        out, _ = historical_for_requests(req, master, candles, quotes, today)
        parts = [[(r.pos, r.datetime) for r in p] for p in out.rdd.glom().collect()]
        assert all(p == sorted(p) for p in parts) and sum(map(len, parts)) == 400
        assert sum(bool(p) for p in parts) == 1 or all(len({k for k, _ in p}) < 200 for p in parts)


def test_ohlc_of_all_intervals_in_one_pass(spark):
    """Both ways -- instruments broadcast, or minute bars rolled up -- equal the bars made one by one."""
    from tickforge.operators import ohlc_quote
    master = spark.createDataFrame([("NSE_EQ|A", 1, "NSE_EQ", "A", 0), ("BSE_EQ|A", 1, "BSE_EQ", "A", 1)], MSCHEMA)
    ticks = spark.sql("""SELECT id - 50 AS event_id, 1L AS exchange_token, IF(id % 3 = 0, 'NSE', 'BSE') AS exchange,
        timestamp_seconds(1704067200 + (id * 7919) % 90000 DIV 40 * 40) AS ts, CAST(id AS DOUBLE) AS price, id % 5 AS qty, id AS oi
        FROM range(3000)""")
    items = [(k, 0, "1", x, "EQ", i) for k, (x, i) in enumerate(
        (x, i) for x in ("NSE", "BSE") for i in ("1d", "I1", "I30", "1d"))]
    req = spark.createDataFrame(items, "request_id long, pos long, exchange_token string, exchange string, "
                                       "instrument_type string, interval_name string")
    want = {(x, i): tuple(r) for i in ("1d", "I1", "I30") for r in ohlc_quote(ticks, i).drop("exchange_token").collect()
            for x in (r.exchange,)}
    for limit in ("67108864", "1"):
        spark.conf.set("spark.tickforge.broadcastLimit", limit)
        try:
            got, _ = ohlc_for_requests(req, master, ticks)
            back = {r[0]: tuple(r[1:]) for r in got.select("request_id", "exchange", "datetime", "open", "high", "low", "close",
                                                           "volume", "last_price").collect()}
        finally:
            spark.conf.unset("spark.tickforge.broadcastLimit")
        assert back == {k: want[x, i] for k, _, _, x, _, i in items}

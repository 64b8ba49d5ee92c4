"""Date chunks, history, today's bar, trailing window, coverage, bars."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickforge.operators import (
    backfill_today, bars, chunk_coverage, explode_days, full_market_quote, historical_data, latest_bar, ltp_quote,
    newest_bars, ohlc_quote, plan_date_chunks, trailing_window,
)


def _chunks(spark, pairs, **kw):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                               "request_id long, from_date string, to_date string")
    out = plan_date_chunks(df, **kw)
    return [(r.request_id, r.chunk_no, str(r.chunk_from), str(r.chunk_to)) for r in
            out.orderBy("request_id", "chunk_no").collect()]


def test_date_chunks_edges(spark):
    pairs = [("2024-01-10", "2024-01-01"),           # reversed: no chunk
             ("2024-01-01", "2024-01-01"),           # one day
             ("2020-01-01", "2022-09-26"),           # exactly 1000 days
             ("2020-01-01", "2022-09-27")]           # 1001 days: trailing one-day chunk
    assert _chunks(spark, pairs) == [
        (1, 0, "2024-01-01", "2024-01-01"),
        (2, 0, "2020-01-01", "2022-09-26"),
        (3, 0, "2020-01-01", "2022-09-26"), (3, 1, "2022-09-27", "2022-09-27"),
    ]
    # The original loop (start < to) loses the one-day range and the trailing day.
    assert _chunks(spark, pairs, legacy=True) == [
        (2, 0, "2020-01-01", "2022-09-26"), (3, 0, "2020-01-01", "2022-09-26"),
    ]


@pytest.fixture()
def ticks(spark):
    # UTC instants; market zone is +05:30.  Token 1 trades on two market days.
    data = [
        (1, 1, "2024-01-01 03:45:00", 10.0, 5, 100),
        (2, 1, "2024-01-01 03:45:00", 11.0, 1, 101),      # same ts: event_id breaks the tie
        (3, 1, "2024-01-01 09:59:30", 9.0, 2, 102),
        (4, 1, "2024-01-01 19:00:00", 12.0, 4, 103),      # 00:30 on Jan 2 local
        (5, 2, "2024-01-01 04:00:00", 50.0, 10, 7),
    ]
    df = spark.createDataFrame(data, "event_id long, exchange_token long, ts string, price double, qty long, oi long")
    return df.withColumn("ts", F.to_timestamp("ts"))


def test_day_bars_in_market_zone(ticks):
    b = bars(ticks, "day")
    assert rows(b, "exchange_token", "datetime", "open", "high", "low", "close", "volume", "oi") == [
        (1, "2024-01-01 00:00:00", 10.0, 11.0, 9.0, 9.0, 8, 102),
        (1, "2024-01-02 00:00:00", 12.0, 12.0, 12.0, 12.0, 4, 103),
        (2, "2024-01-01 00:00:00", 50.0, 50.0, 50.0, 50.0, 10, 7),
    ]


def test_minute_bars_and_quotes(ticks):
    m = bars(ticks, "1minute")
    assert m.where("exchange_token = 1").count() == 3
    first = [r for r in m.collect() if r.datetime == "2024-01-01 09:15:00"][0]
    assert (first.open, first.close) == (10.0, 11.0)
    assert rows(ltp_quote(ticks), "exchange_token", "last_price", "last_time") == [
        (1, 12.0, "2024-01-02 00:30:00"), (2, 50.0, "2024-01-01 09:30:00")]
    o = {r.exchange_token: r for r in ohlc_quote(ticks, "1d").collect()}
    assert o[1].datetime == "2024-01-02 00:00:00" and o[1].last_price == 12.0
    with pytest.raises(ValueError):
        ohlc_quote(ticks, "5m")
    fq = {r.exchange_token: r for r in full_market_quote(ticks).collect()}
    assert fq[1].ohlc.open == 12.0 and fq[1].volume == 4 and fq[1].oi == 103
    assert str(fq[2].trade_date) == "2024-01-01"


@pytest.mark.parametrize("limit", ["67108864", "1"])
@pytest.mark.parametrize("interval", ["1d", "I1", "I30"])
def test_newest_bars_equal_the_last_of_all_bars(spark, limit, interval):
    """Both ways -- buckets broadcast, or all bars built -- with NULL keys, times and ties."""
    ticks = spark.sql("""SELECT IF(id % 7 = 0, NULL, id % 7) AS exchange_token, IF(id % 3 = 0, 'NSE', 'BSE') AS exchange,
        CASE WHEN id % 11 = 0 THEN NULL WHEN id % 7 = 6 THEN NULL
             ELSE timestamp_seconds(1704067200 + (id * 7919) % 300000) END AS ts,
        CAST(id AS DOUBLE) AS price, id % 5 AS qty, id AS oi, id - 50 AS event_id FROM range(2000)""")
    key = ["exchange", "exchange_token"]
    spark.conf.set("spark.tickforge.broadcastLimit", limit)
    try:
        got = newest_bars(ticks, interval, key=key)
        assert rows(got) == rows(latest_bar(bars(ticks, interval, key=key), key).select(got.columns))
        plan = got._jdf.queryExecution().toString()
        assert ("LeftSemi" in plan) == (limit != "1")
    finally:
        spark.conf.unset("spark.tickforge.broadcastLimit")
    assert newest_bars(ticks.limit(0), "day", key=key).count() == 0


def test_days_of_very_long_ranges(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, DATE'2024-01-30', DATE'2024-03-02'), (2, DATE'2024-05-05', DATE'2024-05-05'),
                      (3, DATE'2024-05-06', DATE'2024-05-05'), (4, DATE'0001-01-01', DATE'9999-12-31'),
                      (5, CAST(NULL AS DATE), DATE'2024-01-01') t(id, a, b)""")
    days = explode_days(df, F.col("a"), F.col("b"), out="day")
    assert days.columns == ["id", "a", "b", "day"]
    got = {r.id: (r.n, r.d, str(r.lo), str(r.hi)) for r in days.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("day").alias("d"), F.min("day").alias("lo"), F.max("day").alias("hi")).collect()}
    assert got == {1: (33, 33, "2024-01-30", "2024-03-02"), 2: (1, 1, "2024-05-05", "2024-05-05"),
                   4: (3652059, 3652059, "0001-01-01", "9999-12-31")}


@pytest.fixture()
def candles(spark):
    data = [(1, "2024-01-08 00:00:00", "2024-01-08"), (1, "2024-01-09 00:00:00", "2024-01-09"),
            (1, "2024-01-19 00:00:00", "2024-01-19"), (1, "2024-01-20 00:00:00", "2024-01-20"),
            (2, "2024-01-19 00:00:00", "2024-01-19"), (3, "2024-01-20 00:00:00", "2024-01-20")]
    df = spark.createDataFrame(data, "exchange_token long, datetime string, trade_date string")
    return (df.withColumn("trade_date", F.to_date("trade_date"))
            .withColumn("open", F.lit(1.0)).withColumn("high", F.lit(2.0)).withColumn("low", F.lit(0.5))
            .withColumn("close", F.lit(1.5)).withColumn("volume", F.lit(10).cast("long"))
            .withColumn("oi", F.lit(0).cast("long")))


def test_trailing_window(candles):
    out = trailing_window(candles, dt.date(2024, 1, 20), days=10)
    assert sorted(str(r.trade_date) for r in out.collect()) == ["2024-01-09", "2024-01-19", "2024-01-19"]


def test_historical_range(spark, candles):
    req = spark.createDataFrame([(10, 1, "2024-01-09", "2024-01-19"), (11, 1, "2024-01-19", "2024-01-09"),
                                 (12, 2, "2024-01-19", "2024-01-19"), (13, 9, "2024-01-01", "2024-01-31")],
                                "request_id long, exchange_token long, from_date string, to_date string")
    out = historical_data(req, candles)
    assert rows(out, "request_id", "datetime") == [(10, "2024-01-09 00:00:00"), (10, "2024-01-19 00:00:00"),
                                                   (12, "2024-01-19 00:00:00")]
    assert out.columns == ["request_id", "exchange_token", "datetime", "open", "high", "low", "close",
                           "volume", "oi"]


def test_backfill_today(spark, candles):
    quotes = spark.createDataFrame([
        (1, (1.0, 2.0, 0.5, 1.5), 99, 3, "2024-01-20 05:00:00"),     # has today's bar already
        (2, (5.0, 6.0, 4.0, 5.5), 7, 1, "2024-01-20 05:00:00"),      # gets a bar
        (3, (5.0, 6.0, 4.0, 5.5), 7, 1, None),                       # has today's bar anyway
        (4, (5.0, 6.0, 4.0, 5.5), 7, 1, "2024-01-20 05:00:00"),      # no candles: nothing added
    ], "exchange_token long, ohlc struct<open:double,high:double,low:double,close:double>, volume long, "
       "oi long, timestamp string").withColumn("timestamp", F.to_timestamp("timestamp"))
    c2 = candles.where("exchange_token != 3")
    out = backfill_today(c2, quotes.where("exchange_token != 3"), "2024-01-20")
    added = out.where("datetime = '2024-01-20 10:30:00'")
    assert rows(added, "exchange_token", "open", "close", "volume") == [(2, 5.0, 5.5, 7)]
    assert out.count() == c2.count() + 1
    assert backfill_today(c2, quotes, "2024-01-20", range_ends_today=False).count() == c2.count()
    no_ts = quotes.where("exchange_token = 2").withColumn("timestamp", F.lit(None).cast("timestamp"))
    assert backfill_today(c2, no_ts, "2024-01-20").count() == c2.count()


def test_chunk_coverage(spark, candles):
    req = spark.createDataFrame([(10, 1, "2024-01-08", "2024-01-13"), (11, 3, "2024-01-01", "2024-01-02")],
                                "request_id long, exchange_token long, from_date string, to_date string")
    cov = chunk_coverage(plan_date_chunks(req, days=3), candles)
    assert rows(cov, "request_id", "n_chunks", "empty_chunks", "n_candles", "retrieved") == [
        (10, 2, 1, 2, 1), (11, 1, 1, 0, 0)]


def test_chunk_coverage_failed_chunks(spark, candles):
    req = spark.createDataFrame([(10, 1, "2024-01-08", "2024-01-13")],
                                "request_id long, exchange_token long, from_date string, to_date string")
    failed = spark.createDataFrame([(10, 1), (10, 1)], "request_id long, chunk_no long")
    cov = chunk_coverage(plan_date_chunks(req, days=3), candles, failed=failed)
    assert rows(cov, "request_id", "n_chunks", "failed_chunks", "n_candles") == [(10, 2, 1, 2)]


KEYED = "exchange string, exchange_token long, interval_name string, datetime string, open double"


@pytest.fixture()
def two_venues(spark):
    data = [("NSE", 1, "day", "2024-01-08 00:00:00", 1.0), ("BSE", 1, "day", "2024-01-08 00:00:00", 2.0),
            ("NSE", 1, "day", "2024-01-20 00:00:00", 3.0), ("NSE", 1, "30minute", "2024-01-08 09:30:00", 4.0)]
    return spark.createDataFrame(data, KEYED).selectExpr(
        "*", "to_date(substring(datetime, 1, 10)) AS trade_date", "open AS high", "open AS low", "open AS close",
        "1L AS volume", "0L AS oi")


def test_stored_candles_keep_exchange_and_interval(spark, two_venues, tmp_path):
    from tickforge.sinks import save_candles, write_candles
    write_candles(two_venues, str(tmp_path / "files"))
    saved = save_candles(two_venues, "two_venues_candles", str(tmp_path / "table"), buckets=3)
    try:
        for stored in (spark.read.parquet(str(tmp_path / "files")), saved):
            assert rows(stored, "exchange", "interval_name", "open") == rows(two_venues, "exchange", "interval_name", "open")
            req = spark.createDataFrame([(1, "NSE", 1, "2024-01-01", "2024-01-31"), (2, "BSE", 1, "2024-01-08", "2024-01-08")],
                                        "request_id long, exchange string, exchange_token long, from_date string, to_date string")
            day = stored.where("interval_name = 'day'")
            assert rows(historical_data(req, day), "request_id", "exchange", "open") == [
                (1, "NSE", 1.0), (1, "NSE", 3.0), (2, "BSE", 2.0)]
        # One day saved again replaces that day only; another layout is refused.
        again = two_venues.where("trade_date = DATE'2024-01-20'").withColumn("open", F.lit(9.0))
        assert rows(save_candles(again, "two_venues_candles", buckets=3), "open") == [(1.0,), (2.0,), (4.0,), (9.0,)]
        with pytest.raises(ValueError, match="bucketed"):
            save_candles(again, "two_venues_candles", buckets=4)
        with pytest.raises(ValueError, match="bucketed"):
            save_candles(again, "two_venues_candles", key="exchange_token", buckets=3)
    finally:
        spark.sql("DROP TABLE IF EXISTS two_venues_candles")


def test_composite_keys_everywhere(spark, two_venues):
    key = ["exchange", "exchange_token"]
    q = spark.createDataFrame([(x, 1, (7.0, 8.0, 6.0, 7.5), 3, 4, "2024-01-20 05:00:00") for x in ("NSE", "BSE")],
                              "exchange string, exchange_token long, ohlc struct<open:double,high:double,low:double,close:double>, "
                              "volume long, oi long, timestamp string").withColumn("timestamp", F.to_timestamp("timestamp"))
    for k in (None, key):
        out = backfill_today(two_venues, q, "2024-01-20", key=k).where("open = 7.0")
        assert rows(out, "exchange", "interval_name") == [("BSE", "day"), ("NSE", "30minute")]
    req = spark.createDataFrame([(5, "NSE", 1, "2024-01-08", "2024-01-20"), (5, "BSE", 1, "2024-01-08", "2024-01-20")],
                                "request_id long, exchange string, exchange_token long, from_date string, to_date string")
    chunks = plan_date_chunks(req, days=5)
    failed = spark.createDataFrame([(5, 1, "BSE", 1)], "request_id long, chunk_no long, exchange string, exchange_token long")
    day = two_venues.where("interval_name = 'day'")
    each = chunk_coverage(chunks, day, key=key, failed=failed, per_instrument=True, requests=req)
    assert rows(each, "exchange", "n_chunks", "empty_chunks", "n_candles", "failed_chunks", "retrieved") == [
        ("BSE", 3, 2, 1, 1, 1), ("NSE", 3, 1, 2, 0, 1)]
    whole = chunk_coverage(chunks, day, failed=failed)
    assert rows(whole, "n_chunks", "empty_chunks", "n_candles", "failed_chunks", "retrieved") == [(6, 3, 3, 1, 2)]


def test_rolled_bars_equal_bars_of_ticks(spark):
    from tickforge.operators import bar_partials, roll_up
    ticks = spark.sql("""SELECT id - 1000 AS event_id, IF(id % 4 = 0, NULL, id % 4) AS exchange_token, IF(id % 3 = 0, 'NSE', 'BSE') AS exchange,
        CASE WHEN id % 13 = 0 THEN NULL ELSE timestamp_seconds((id * 7919) % 300000 DIV 30 * 30 - 100000) END AS ts,
        CAST(IF(id % 17 = 0, NULL, id) AS DOUBLE) AS price, id % 5 AS qty, IF(id % 7 = 0, NULL, id) AS oi FROM range(4000)""")
    stored = bar_partials(ticks).repartition(7)
    for interval in ("1minute", "5minute", "30minute", "day", "15 minutes"):
        want = bars(ticks, interval)
        assert rows(roll_up(stored, interval).select(want.columns)) == rows(want)
    with pytest.raises(ValueError, match="do not make"):
        roll_up(bar_partials(ticks, "30minute"), "5minute", source="30minute")


def test_bar_store_equals_a_rebuild(spark, tmp_path):
    """The same batch twice, a late one, one for an old day, corrections, ticks without a time."""
    from tickforge.operators import bar_partials
    from tickforge.sinks import BarStore
    ticks = spark.sql("""SELECT id AS event_id, id % 3 AS exchange_token, IF(id % 2 = 0, 'NSE', 'BSE') AS exchange,
        CASE WHEN id % 50 = 0 THEN NULL ELSE timestamp_seconds(1704067200 + (id * 7919) % 400000) END AS ts,
        CAST(id AS DOUBLE) AS price, id % 5 AS qty, id AS oi FROM range(800)""")
    store = BarStore(spark, str(tmp_path / "store"))
    wrong = ticks.withColumn("price", F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("price")))
    store.merge(wrong.where("event_id < 500"), first=True)
    kept = {str(r.trade_date) for r in store.bars.select("trade_date").distinct().collect()}
    for batch in (ticks.where("event_id >= 300"), ticks.where("event_id >= 300"), ticks.where("event_id < 400"),
                  ticks.where("event_id IN (1, 2, 50)")):
        store.merge(batch)
    want = bar_partials(ticks)
    assert rows(store.bars.select(want.columns)) == rows(want)
    assert rows(store.ticks.select(ticks.columns)) == rows(ticks)
    assert kept <= {str(r.trade_date) for r in store.bars.select("trade_date").distinct().collect()}

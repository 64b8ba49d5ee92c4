"""Instruments of two exchanges, big tokens, whole masters, file order, exact tick order."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL, rows
from tickforge.operators import bars, enrich_quotes, ltp_quote, merge_quote_batches, unify_masters
from tickforge.operators.endpoints import historical_for_requests, ltp_for_requests, ohlc_for_requests
from tickforge.operators.resolve import first_match, resolve_instruments
from tickforge.plans import catalog
from tickforge.sources import parse_candles, parse_quotes, read_master_a, read_requests
from tickforge.streaming.live import stream_bars, zone_offset_seconds

MASTER = "instrument_key string, exchange_token long, exchange string, tradingsymbol string, src_pos long"
TICKS = "event_id long, exchange string, exchange_token long, ts string, price double, qty long, oi long"
REQ = "request_id long, pos long, exchange_token string, exchange string, instrument_type string, interval_name string"
BIG = 3_000_000_000


@pytest.fixture()
def master(spark):
    return spark.createDataFrame([("NSE_EQ|A", 5, "NSE_EQ", "A", 0), ("BSE_EQ|B", 5, "BSE_EQ", "B", 1),
                                  ("NSE_EQ|C", BIG, "NSE_EQ", "C", 2)], MASTER)


@pytest.fixture()
def ticks(spark):
    t = spark.createDataFrame([(1, "NSE", 5, "2024-01-02 04:00:00", 10.0, 1, 0),
                               (2, "NSE", BIG, "2024-01-02 04:00:00", 30.0, 1, 0)], TICKS)
    return t.withColumn("ts", F.to_timestamp("ts"))


def test_price_stays_on_its_exchange(spark, master, ticks):
    req = spark.createDataFrame([(1, 0, "5", "NSE", "EQ", "1d"), (2, 0, "5", "BSE", "EQ", "1d"),
                                 (3, 0, str(BIG), "NSE", "EQ", "1d"), (4, 0, "5", "NSE", "EQ", "5m")], REQ)
    got, bad = ltp_for_requests(req, master, ticks)
    assert rows(got, "request_id", "last_price") == [(1, 10.0), (3, 30.0), (4, 10.0)]
    assert bad.count() == 0
    got, bad = ohlc_for_requests(req, master, ticks)
    assert rows(got, "request_id", "close") == [(1, 10.0), (3, 30.0)]
    assert rows(bad, "request_id", "reason") == [(4, "bad_interval")]
    keyed = ticks.withColumn("instrument_key", F.when(F.col("exchange_token") == 5, "NSE_EQ|A").otherwise("NSE_EQ|C"))
    assert rows(ltp_for_requests(req, master, keyed)[0], "request_id", "last_price") == [(1, 10.0), (3, 30.0), (4, 10.0)]


def test_history_stays_on_its_exchange(spark, master, ticks):
    candles = bars(ticks, "day", key=["exchange", "exchange_token"])
    req = spark.createDataFrame([(k, 0, "5", x, "EQ", "day") for k, x in ((1, "NSE"), (2, "BSE"))], REQ) \
        .withColumns({"from_date": F.lit("2024-01-01"), "to_date": F.lit("2024-01-03")})
    got, _ = historical_for_requests(req, master, candles)
    assert rows(got, "request_id", "exchange", "open") == [(1, "NSE", 10.0)]


def test_enriched_quotes_merge_per_exchange(spark, master):
    q = spark.createDataFrame([(0, 0, "NSE_EQ|A", 1.0), (0, 1, "BSE_EQ|B", 2.0)],
                              "batch_no long, entry_pos long, instrument_token string, last_price double")
    ok, _ = enrich_quotes(q, master)
    assert rows(merge_quote_batches(ok), "exchange", "last_price") == [("BSE", 2.0), ("NSE", 1.0)]
    unified, _ = enrich_quotes(q, unify_masters({"feed_a": master}))
    assert rows(unified, "broker", "exchange", "instrument_type") == [("feed_a", "BSE", "EQ"), ("feed_a", "NSE", "EQ")]
    with pytest.raises(ValueError, match="merge key"):
        merge_quote_batches(ok.drop("exchange"))


def test_unified_master_keeps_contract_columns(spark, master):
    a = master.withColumns({"expiry": F.lit("2024-02-29"), "strike": F.lit("100.5"), "option_type": F.lit("CE"),
                            "instrument_type": F.lit("OPTIDX")})
    b = spark.createDataFrame([(7, BIG, "X", "EQ", "NSE", "NSE", 50, 0)],
                              "instrument_token long, exchange_token long, tradingsymbol string, instrument_type string, "
                              "segment string, exchange string, lot_size long, src_pos long").withColumn("name", F.lit("N"))
    u = unify_masters({"feed_a": a, "feed_b": b})
    got = {r.instrument_key: r for r in u.collect()}
    assert got["7"].exchange_token == BIG and got["7"].lot_size == 50 and got["7"].expiry is None
    assert (str(got["NSE_EQ|A"].expiry), got["NSE_EQ|A"].strike, got["NSE_EQ|A"].option_type) == ("2024-02-29", 100.5, "CE")
    assert (got["NSE_EQ|A"].instrument_type, got["NSE_EQ|A"].feed_instrument_type) == ("EQ", "OPTIDX")


def test_endpoints_take_the_unified_master(spark, master, ticks):
    b = spark.createDataFrame([(7, BIG + 1, "X", "EQ", "NSE", "NSE", 0)],
                              "instrument_token long, exchange_token long, tradingsymbol string, instrument_type string, "
                              "segment string, exchange string, src_pos long").withColumn("name", F.lit("N"))
    u = unify_masters({"feed_a": master, "feed_b": b})
    req = spark.createDataFrame([(1, 0, "5", "NSE", "EQ", "1d"), (2, 0, str(BIG + 1), "NSE", "EQ", "1d")], REQ)
    ok, bad = resolve_instruments(req, u)
    assert rows(ok, "request_id", "instrument_key") == [(1, "NSE_EQ|A"), (2, "7")] and bad.count() == 0
    assert rows(ltp_for_requests(req, u, ticks)[0], "request_id", "last_price") == [(1, 10.0)]


def test_first_match_follows_file_order(spark, tmp_path):
    head = "instrument_key,exchange_token,tradingsymbol,exchange\n"
    (tmp_path / "part-0.csv").write_text(head + "FIRST,1,A,NSE_EQ\n")
    (tmp_path / "part-1.csv").write_text(head + "".join(f"LATER{k},1,A,NSE_EQ\n" for k in range(500)))
    m = read_master_a(spark, str(tmp_path))
    assert first_match(m, ["exchange_token"]).first().instrument_key == "FIRST"
    req = spark.createDataFrame([(1, 0, "1", "NSE", "EQ", None)], REQ)
    assert resolve_instruments(req, m)[0].first().instrument_key == "FIRST"


def test_history_bodies_and_files_without_ids(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(json.dumps(
            {"exchange_token": 5, "interval": "day", "from_date": "2024-01-01", "to_date": "2024-01-02"}) + "\n")
    got = read_requests(spark, str(tmp_path)).collect()
    assert {(r.interval_name, r.from_date, r.to_date) for r in got} == {("day", "2024-01-01", "2024-01-02")}
    assert len({r.request_id for r in got}) == 2


def test_payload_numbers_and_times(spark):
    q = spark.createDataFrame([('{"status":"success","data":{"K":{"volume":1200.0,"oi":"x"}}}',)], "payload string")
    assert [(r.volume, r.oi) for r in parse_quotes(q)[0].collect()] == [(1200, None)]
    c = spark.createDataFrame([('{"status":"success","data":{"candles":[["nope",1,1,1,1,1,1],'
                                '["2024-01-02T09:15:00+05:30",1,1,1,1,1e30,"NaN"]]}}',)], "payload string")
    good, bad = parse_candles(c)
    assert [(r.volume, r.oi) for r in good.collect()] == [(None, None)]
    assert [r.reason for r in bad.collect()] == ["bad_candle_time"]


def test_tick_order_is_exact(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    t = spark.createDataFrame([(low, 1, "2024-01-02 04:00:00", 1.0, 1, 1), (high, 1, "2024-01-02 04:00:00", 2.0, 1, 2),
                               (low, 1, "2024-01-02 04:00:00.000001", 3.0, 1, 3), (5, 1, None, 9.0, 1, 9)],
                              "event_id long, exchange_token long, ts string, price double, qty long, oi long")
    t = t.withColumn("ts", F.to_timestamp("ts"))
    assert rows(bars(t, "day"), "open", "close", "oi") == [(1.0, 3.0, 3)]
    assert rows(ltp_quote(t), "last_price") == [(3.0,)]
    assert rows(ltp_quote(t, since="2024-01-03")) == []


@pytest.mark.parametrize("job", ["q_ltp", "q_full_quote_for_requests"])
def test_tick_aggregates_hash(spark, job):
    df = getattr(catalog, job)(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    tick = [ln for ln in plan.splitlines() if "Aggregate" in ln and ("max_by(price" in ln or "min_by(price" in ln)]
    assert tick and not any("SortAggregate" in ln for ln in tick)


def test_every_status_occurs(spark):
    got = {r.status_code for r in E.queries()["request_status"](spark, SF_SMALL).select("status_code").distinct().collect()}
    assert got == {200, 400, 404, 500}


def test_stream_bars_need_a_fixed_offset(spark):
    assert zone_offset_seconds("Asia/Kolkata") == 19800
    with pytest.raises(ValueError, match="offset"):
        stream_bars(spark.createDataFrame([], TICKS), tz="America/New_York")

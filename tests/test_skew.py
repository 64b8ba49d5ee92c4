"""A hot instrument holding ~40% of all ticks: results must equal a brute-force
pandas computation, whatever the partitioning."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickforge.operators import bars, historical_data, ltp_quote, plan_key_batches


@pytest.fixture(scope="module")
def skewed(spark):
    n = 20000
    ids = spark.range(0, n, numPartitions=8)
    tok = F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(F.col("id") % 37 + 1)
    # Coarse timestamps force many equal-ts ties inside the hot instrument.
    ts = F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") * 7919 % 86400 / 60) * 60)
    return ids.select(F.col("id").alias("event_id"), tok.cast("long").alias("exchange_token"), ts.alias("ts"),
                      ((F.col("id") * 31 % 1000) / 10.0).alias("price"), (F.col("id") % 9).alias("qty"),
                      (F.col("id") % 13).alias("oi"))


def _pdf(df):
    return df.toPandas()


def test_hot_instrument_bars_match_brute_force(skewed):
    got = _pdf(bars(skewed, "30minute").select("exchange_token", "datetime", "open", "high", "low", "close",
                                                "volume", "oi"))
    t = _pdf(skewed)
    t["local"] = t["ts"] + pd.Timedelta(minutes=330)
    t["bucket"] = t["local"].dt.floor("30min").dt.strftime("%Y-%m-%d %H:%M:%S")
    t = t.sort_values(["ts", "event_id"])
    g = t.groupby(["exchange_token", "bucket"])
    want = pd.DataFrame({"open": g["price"].first(), "high": g["price"].max(), "low": g["price"].min(),
                         "close": g["price"].last(), "volume": g["qty"].sum(), "oi": g["oi"].last()}).reset_index()
    want = want.rename(columns={"bucket": "datetime"})
    key = ["exchange_token", "datetime"]
    m = got.merge(want, on=key, suffixes=("", "_w"))
    assert len(m) == len(got) == len(want)
    for c in ["open", "high", "low", "close", "volume", "oi"]:
        assert (m[c] == m[c + "_w"]).all(), c
    assert (got["exchange_token"] == 0).sum() == 48        # the hot instrument: one bar per 30 minutes


def test_hot_instrument_ltp(skewed):
    got = {r.exchange_token: r.last_price for r in ltp_quote(skewed).collect()}
    t = _pdf(skewed).sort_values(["ts", "event_id"])
    want = t.groupby("exchange_token")["price"].last().to_dict()
    assert got == want


def test_hot_request_batches(spark, skewed):
    keys = skewed.select(F.when(F.col("exchange_token") == 0, F.lit("hot")).otherwise(F.lit("cold"))
                         .alias("request_id"), F.col("event_id").alias("pos"),
                         F.col("event_id").cast("string").alias("instrument_key"))
    out = {(r.request_id, r.batch_no): r for r in plan_key_batches(keys, 450).collect()}
    t = _pdf(keys).sort_values(["request_id", "pos"])
    for rid, grp in t.groupby("request_id"):
        ks = list(grp["instrument_key"])
        chunks = [ks[i:i + 450] for i in range(0, len(ks), 450)]
        assert len([k for k in out if k[0] == rid]) == len(chunks)
        for i, c in enumerate(chunks):
            assert out[(rid, i)].keys == ",".join(c) and out[(rid, i)].n_keys == len(c)


def test_hot_instrument_history(spark, skewed):
    candles = bars(skewed, "1minute")
    req = spark.createDataFrame([(1, 0, "2024-01-01", "2024-01-01"), (2, 0, "2024-01-02", "2024-01-02"),
                                 (3, 5, "2023-12-31", "2024-01-02")],
                                "request_id long, exchange_token long, from_date string, to_date string")
    got = historical_data(req, candles)
    counts = {r.request_id: r["count"] for r in got.groupBy("request_id").count().collect()}
    c = _pdf(candles)
    c["d"] = c["trade_date"].astype(str)
    assert counts.get(1, 0) == ((c.exchange_token == 0) & (c.d == "2024-01-01")).sum()
    assert counts.get(2, 0) == ((c.exchange_token == 0) & (c.d == "2024-01-02")).sum()
    assert counts.get(3, 0) == (c.exchange_token == 5).sum()

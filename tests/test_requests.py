"""Request validation, resolution and batching."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickforge.functions.intervals import QUOTE_INTERVALS
from tickforge.operators import (
    ordinal_within, plan_key_batches, resolve_instruments, resolve_symbols,
    unresolved_requests, validate_requests,
)
from tickforge.schemas import REQUEST
from tickforge.sources import read_requests


@pytest.fixture()
def master(spark):
    # Two rows for key (21195, NSE_EQ): the first in file order wins.
    # Token 500 exists on two exchanges.
    return spark.createDataFrame([
        ("NSE_EQ|INE1", 21195, "NSE_EQ", "ABC", 2),
        ("NSE_EQ|INE1-dup", 21195, "NSE_EQ", "ABCX", 5),
        ("NSE_FUTIDX|NIFTY", 9305, "NSE_FUTIDX", "NIFTYFUT", 3),
        ("BSE_EQ|INE2", 500, "BSE_EQ", "XYZ", 4),
        ("NSE_EQ|INE3", 500, "NSE_EQ", "PQR", 6),
    ], "instrument_key string, exchange_token int, exchange string, tradingsymbol string, src_pos long")


@pytest.fixture()
def requests(spark):
    return spark.createDataFrame([
        (1, 0, "21195", "NSE", "EQ", "1d"),
        (1, 1, "9305", "NSE", "FUTIDX", "I1"),
        (1, 2, "", "NSE", "EQ", "1d"),
        (1, 3, None, "NSE", "EQ", "1d"),
        (2, 0, "abc", "NSE", "EQ", "1d"),
        (2, 1, "500", "BSE", "EQ", "5m"),
        (2, 2, "500", None, "EQ", "I30"),
        (2, 3, "777", "NSE", "EQ", "1d"),
        (3, 0, "21195", "NSE", None, "1d"),
    ], REQUEST)


def test_validate_reasons(requests):
    ok, bad = validate_requests(requests, intervals=QUOTE_INTERVALS)
    assert rows(bad, "request_id", "pos", "reason") == sorted([
        (1, 2, "missing_token"), (1, 3, "missing_token"), (2, 0, "bad_token"), (2, 1, "bad_interval"),
    ], key=repr)
    assert ok.count() == 5


def test_validate_without_interval_check(requests):
    _, bad = validate_requests(requests)
    assert {r.reason for r in bad.collect()} == {"missing_token", "bad_token"}


def test_resolve_first_match_and_defaults(requests, master):
    ok, bad = resolve_instruments(requests, master)
    assert rows(ok, "request_id", "pos", "instrument_key") == sorted([
        (1, 0, "NSE_EQ|INE1"),          # first of two master rows
        (1, 1, "NSE_FUTIDX|NIFTY"),
        (2, 1, "BSE_EQ|INE2"),          # same token, other exchange
        (2, 2, "NSE_EQ|INE3"),          # exchange defaults to NSE
    ], key=repr)
    reasons = {(r.request_id, r.pos): r.reason for r in bad.collect()}
    assert reasons[(2, 3)] == "not_in_master"
    assert reasons[(3, 0)] == "not_in_master"   # type missing -> 'NSE_' matches nothing
    assert reasons[(1, 3)] == "missing_token"


def test_resolve_symbols(spark, requests, master):
    mb = master.select("exchange_token", F.split("exchange", "_")[0].alias("exchange"),
                       "tradingsymbol", "src_pos")
    mb = mb.unionByName(spark.createDataFrame([(777, "NSE", None, 9)],
                                              "exchange_token int, exchange string, tradingsymbol string, "
                                              "src_pos long"))
    ok, bad = resolve_symbols(requests, mb)
    got = {(r.request_id, r.pos): r.symbol_key for r in ok.collect()}
    assert got[(1, 0)] == "NSE:ABC"
    assert got[(2, 1)] == "BSE:XYZ"
    assert (2, 3) not in got               # no symbol, so nothing to ask for
    assert {(r.request_id, r.pos): r.reason for r in bad.collect()}[(2, 3)] == "missing_symbol"
    assert got[(3, 0)] == "NSE:ABC"        # feed B ignores the type


def test_unresolved_can_fail_the_job(requests, master):
    assert unresolved_requests(requests, master).count() == 5
    with pytest.raises(Exception, match="unresolved request item"):
        unresolved_requests(requests, master, fail=True).collect()


def test_read_requests_defaults(spark, tmp_path):
    p = tmp_path / "req.json"
    p.write_text('{"exchange_token": 21195, "exchange": "NSE", "instrument_type": "EQ"}\n'
                 '{"exchange_token": "9305"}\n'
                 '{"exchange": "BSE", "instrument_type": "EQ"}\n')
    df = read_requests(spark, str(p))
    got = sorted((r.exchange_token, r.exchange, r.instrument_type) for r in df.collect())
    assert got == [("", "BSE", "EQ"), ("21195", "NSE", "EQ"), ("9305", "NSE", "")]


def test_ordinal_within_spreads_hot_group(spark):
    # One group holds most rows; positions must equal a plain row_number.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
        .alias("g"), (F.col("id") * 7919 % 3001).alias("pos"))
    got = ordinal_within(df, ["g"], ["pos"], out="o", n_ranges=6)
    from pyspark.sql import Window
    want = df.withColumn("o", F.row_number().over(Window.partitionBy("g").orderBy("pos")))
    assert rows(got, "g", "pos", "o") == rows(want, "g", "pos", "o")


def test_key_batches(spark):
    df = spark.range(0, 1001).select(F.lit("r1").alias("request_id"), (1000 - F.col("id")).alias("pos"),
                                     F.concat(F.lit("K"), F.col("id").cast("string")).alias("instrument_key"))
    out = {r.batch_no: r for r in plan_key_batches(df, 750).collect()}
    assert sorted(out) == [0, 1]
    assert out[0].n_keys == 750 and out[1].n_keys == 251
    first = out[0].keys.split(",")
    assert first[0] == "K1000" and first[-1] == "K251"
    assert out[1].keys.split(",")[-1] == "K0"
    with pytest.raises(ValueError):
        plan_key_batches(df, 0)


def test_ordinal_within_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "g string, pos long")
    got = ordinal_within(df, ["g"], ["pos"], out="o", n_ranges=2)
    assert rows(got, "g", "pos", "o") == sorted([(None, 1, 1), (None, 2, 2), ("a", 1, 1)], key=repr)

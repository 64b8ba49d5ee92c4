"""Master readers and operators, sinks, response envelope."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickforge.functions.index_keys import INDEX_KEYS
from tickforge.operators import backfill_index_symbols, index_symbol_map, resolve_instruments, unify_masters
from tickforge.sinks import list_master, request_status, write_candles, write_master
from tickforge.schemas import MASTER_JSON_TYPES
from tickforge.sources import read_master_a, read_master_b, read_master_json


def test_index_keys_fixed_values():
    assert len(INDEX_KEYS) == 116 and len(set(INDEX_KEYS)) == 116
    assert INDEX_KEYS[0] == "NSE_INDEX|Nifty 50" and INDEX_KEYS[-1] == "BSE_INDEX|SENSEX50"
    assert sum(k.startswith("NSE_INDEX|") for k in INDEX_KEYS) == 77
    assert sum(k.startswith("BSE_INDEX|") for k in INDEX_KEYS) == 38


def test_read_master_a_gzip_first_match(spark, tmp_path):
    p = tmp_path / "complete.csv.gz"
    with gzip.open(p, "wt") as f:
        f.write("instrument_key,exchange_token,tradingsymbol,lot_size,exchange\n"
                "NSE_EQ|A,21195,ABC,1,NSE_EQ\n"
                "NSE_EQ|A2,21195,ABC2,1,NSE_EQ\n"
                "NSE_INDEX|Nifty 50,,,0,NSE_INDEX\n"
                "BSE_EQ|B,x12,XYZ,5,BSE_EQ\n")
    m = read_master_a(spark, str(p))
    assert dict(m.dtypes)["exchange_token"] == "bigint" and dict(m.dtypes)["lot_size"] == "string"
    assert rows(m, "instrument_key", "exchange_token", "tradingsymbol") == sorted([
        ("NSE_EQ|A", 21195, "ABC"), ("NSE_EQ|A2", 21195, "ABC2"), ("NSE_INDEX|Nifty 50", None, None),
        ("BSE_EQ|B", None, "XYZ")], key=repr)
    req = spark.createDataFrame([(0, 0, "21195", "NSE", "EQ")],
                                "request_id long, pos long, exchange_token string, exchange string, "
                                "instrument_type string")
    ok, _ = resolve_instruments(req, m)
    assert [r.instrument_key for r in ok.collect()] == ["NSE_EQ|A"]      # first row of the file


def test_read_master_b_types(spark, tmp_path):
    p = tmp_path / "instruments.csv"
    p.write_text("instrument_token,exchange_token,tradingsymbol,name,last_price,expiry,strike,tick_size,"
                 "lot_size,instrument_type,segment,exchange\n"
                 "408065,1594,INFY,INFOSYS,0,,0,0.05,1,EQ,NSE,NSE\n"
                 "12345,48,NIFTY24FEB22000CE,NIFTY,0,2024-02-29,22000,0.05,50,CE,NFO-OPT,NFO\n")
    m = read_master_b(spark, str(p))
    t = dict(m.dtypes)
    assert t["strike"] == "double" and t["expiry"] == "date" and t["instrument_token"] == "bigint"
    assert rows(m, "tradingsymbol", "strike") == [("INFY", 0.0), ("NIFTY24FEB22000CE", 22000.0)]


def test_json_master_declares_its_fields(spark, tmp_path):
    """Unknown fields are readable, odd values are NULL, no schema is inferred, bad files fail."""
    data = [{"instrument_key": "A", "exchange_token": 5, "lot": {"size": [1, 2]}, "exchange": "NSE_EQ"},
            {"instrument_key": "B", "exchange_token": "x", "trading_symbol": 7, "strike": 1.5},
            {"a}b,{": ";},{", "instrument_key": None}, {}]
    for k, part in enumerate((data[:2], data[2:], [])):
        with gzip.open(tmp_path / f"m{k}.json.gz", "wt") as f:
            json.dump(part, f, indent=k)
    m = read_master_json(spark, str(tmp_path))
    assert m.columns == ["instrument_key", "trading_symbol", "exchange_token", "exchange", "record", "src_file", "src_pos"]
    assert rows(m, "instrument_key", "trading_symbol", "exchange_token", "exchange") == sorted([
        ("A", None, 5, "NSE_EQ"), ("B", "7", None, None), (None, None, None, None), (None, None, None, None)], key=repr)
    got = m.selectExpr("record:lot.size[1]::int AS lot", "record:strike::double AS strike", "record:`a}b,{`::string AS odd")
    assert rows(got) == sorted([(2, None, None), (None, 1.5, None), (None, None, ";},{"), (None, None, None)], key=repr)
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "m.json").write_text("\n".join(json.dumps(x) for x in data) + "\n")
    assert rows(read_master_json(spark, str(lines), multi_line=False), "instrument_key", "exchange_token") == \
        rows(m, "instrument_key", "exchange_token")
    from pyspark.sql import types as T
    own = read_master_json(spark, str(tmp_path), fields={"instrument_key": T.StringType(), "strike": T.DoubleType()})
    assert rows(own.where("strike IS NOT NULL"), "instrument_key", "strike") == [("B", 1.5)]
    (tmp_path / "bad.json").write_text('[{"instrument_key": "A"')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_master_json(spark, str(tmp_path / "bad.json")).collect()


def test_json_arrays_have_a_fixed_size(spark, monkeypatch):
    from tickforge.plans import staging
    monkeypatch.setattr(staging, "ROWS_PER_ARRAY", 7)
    df = spark.range(30).selectExpr("CAST(id AS STRING) AS instrument_key", "IF(id % 2 = 0, 'same', 'same') AS trading_symbol")
    path = staging.stage_json_arrays(df, "arrays", "instrument_key")
    sizes = [len(json.loads(r.value)) for r in spark.read.text(path, wholetext=True).collect()]
    assert sorted(sizes) == [2, 7, 7, 7, 7]
    assert rows(read_master_json(spark, path), "instrument_key") == rows(df, "instrument_key")


def test_read_master_json_and_backfill(spark, tmp_path):
    p = tmp_path / "complete.json.gz"
    data = [{"instrument_key": "NSE_INDEX|Nifty Bank", "trading_symbol": ""},
            {"instrument_key": "NSE_INDEX|India VIX", "trading_symbol": None},
            {"instrument_key": "BSE_INDEX|SENSEX", "trading_symbol": "SENSEX"},
            {"instrument_key": "NSE_EQ|X", "trading_symbol": ""}]
    with gzip.open(p, "wt") as f:
        json.dump(data, f, indent=1)
    m = read_master_json(spark, str(p))
    out = backfill_index_symbols(m)
    assert rows(out, "instrument_key", "trading_symbol") == sorted([
        ("NSE_INDEX|Nifty Bank", "NIFTY BANK"),     # '' filled from the key
        ("NSE_INDEX|India VIX", None),              # NULL stays NULL
        ("BSE_INDEX|SENSEX", "SENSEX"),             # kept
        ("NSE_EQ|X", None),                         # '' without a map entry becomes NULL
    ], key=repr)
    assert set(out.columns) == set(m.columns) == {*MASTER_JSON_TYPES, "record", "src_file", "src_pos"}


def test_index_symbol_map_custom_keys(spark):
    keys = spark.createDataFrame([(" NSE_INDEX| nifty it ",), ("NOPIPE",)], "instrument_key string")
    got = {r._map_key: r._map_symbol for r in index_symbol_map(keys).collect()}
    assert got[" NSE_INDEX| nifty it "] == "NIFTY IT" and got["NOPIPE"] is None


def test_unify_masters(spark):
    a = spark.createDataFrame([("NSE_EQ|A", 1, "NSE_EQ", "A", 0)],
                              "instrument_key string, exchange_token int, exchange string, tradingsymbol string, "
                              "src_pos long")
    b = spark.createDataFrame([(408065, 1594, "INFY", "INFOSYS", "EQ", "NSE", "NSE", 0)],
                              "instrument_token long, exchange_token int, tradingsymbol string, name string, "
                              "instrument_type string, segment string, exchange string, src_pos long")
    u = unify_masters({"Upper": a, "lower": b}, layouts={"UPPER": "FEED_A", "lower": "feed_b"})
    assert rows(u, "broker", "instrument_key", "exchange", "instrument_type", "name") == [
        ("lower", "408065", "NSE", "EQ", "INFOSYS"), ("upper", "NSE_EQ|A", "NSE", "EQ", None)]
    with pytest.raises(ValueError, match="unsupported broker"):
        unify_masters({"other": a})


def test_write_master_and_candles(spark, tmp_path):
    m = spark.createDataFrame([("feed_a", "K1", 1), ("feed_b", "K2", 2)],
                              "broker string, instrument_key string, exchange_token int")
    write_master(list_master(m), str(tmp_path / "master"))
    back = spark.read.parquet(str(tmp_path / "master"))
    assert rows(back, "broker", "instrument_key") == [("feed_a", "K1"), ("feed_b", "K2")]
    assert (tmp_path / "master" / "broker=feed_a").is_dir()
    c = spark.createDataFrame([(1, "2024-01-02 09:16:00", 1.0, 2.0, 0.5, 1.5, 10, 0, "2024-01-02"),
                               (1, "2024-01-02 09:15:00", 1.0, 2.0, 0.5, 1.5, 10, 0, "2024-01-02"),
                               (2, "2024-01-03 09:15:00", 1.0, 2.0, 0.5, 1.5, 10, 0, "2024-01-03")],
                              "exchange_token long, datetime string, open double, high double, low double, "
                              "close double, volume long, oi long, trade_date string")
    c = c.withColumn("trade_date", F.to_date("trade_date")).withColumn("extra", F.lit("dropped"))
    write_candles(c, str(tmp_path / "candles"))
    back = spark.read.parquet(str(tmp_path / "candles"))
    assert "extra" not in back.columns and back.count() == 3
    assert (tmp_path / "candles" / "trade_date=2024-01-02").is_dir()


def test_request_status_codes(spark):
    reqs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "request_id long")
    rejects = spark.createDataFrame([(2, "bad_token")], "request_id long, reason string")
    results = spark.createDataFrame([(1, "q"), (1, "q2"), (2, "q"), (4, "q")], "request_id long, v string")
    errors = spark.createDataFrame([(4, "batch failed")], "request_id long, e string")
    out = request_status(reqs, rejects, results, errors)
    assert rows(out, "request_id", "status_code", "status", "n_items") == [
        (1, 200, "success", 2), (2, 400, "invalid", 1), (3, 404, "no data", 0), (4, 500, "error", 1)]


def test_resolve_on_unified_master(spark):
    a = spark.createDataFrame([("NSE_EQ|A", 1, "NSE_EQ", "A", 0)],
                              "instrument_key string, exchange_token int, exchange string, tradingsymbol string, "
                              "src_pos long")
    u = unify_masters({"feed_a": a})
    req = spark.createDataFrame([(0, 0, "1", "NSE", "EQ")],
                                "request_id long, pos long, exchange_token string, exchange string, "
                                "instrument_type string")
    ok, _ = resolve_instruments(req, u, segment_col="segment")
    assert [r.instrument_key for r in ok.collect()] == ["NSE_EQ|A"]


def test_first_match_ties_break_on_broker(spark):
    a = spark.createDataFrame([("NSE_EQ|FROM-A", 7, "NSE_EQ", "A", 0)],
                              "instrument_key string, exchange_token int, exchange string, tradingsymbol string, "
                              "src_pos long")
    b = spark.createDataFrame([("NSE_EQ|FROM-B", 7, "NSE_EQ", "B", 0)],
                              "instrument_key string, exchange_token int, exchange string, tradingsymbol string, "
                              "src_pos long")
    u = unify_masters({"zeta": b, "alpha": a}, layouts={"zeta": "feed_a", "alpha": "feed_a"})
    req = spark.createDataFrame([(0, 0, "7", "NSE", "EQ")],
                                "request_id long, pos long, exchange_token string, exchange string, "
                                "instrument_type string")
    for _ in range(3):
        ok, _ = resolve_instruments(req, u, segment_col="segment")
        assert [r.instrument_key for r in ok.collect()] == ["NSE_EQ|FROM-A"]

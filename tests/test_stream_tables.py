"""Stream tables: committed batches, compacted state, late rows, fresh masters, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickforge.operators import ltp_quote
from tickforge.streaming import (
    FreshEnrich, LateSplit, LiveTable, committed, latest_result, run_batches, stream_bars, stream_ltp,
)

TICKS = "event_id long, exchange string, exchange_token long, ts timestamp, price double, qty long, oi long"


def _drop(spark, folder, data):
    df = spark.createDataFrame(data, TICKS.replace("ts timestamp", "ts string")).withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.mode("append").parquet(folder)


def test_compacted_state_stays_bounded(spark, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "live")
    table = LiveTable(spark, root, ["exchange", "exchange_token"], every=3)
    os.makedirs(inbox)
    stream = spark.readStream.schema(TICKS).parquet(inbox)
    with pytest.raises(ValueError, match="nothing"):
        table.read()
    for k in range(11):
        _drop(spark, inbox, [(10 * k + i, x, i % 2, f"2024-01-01 0{k // 4 + 1}:{k:02d}:0{i}", float(k + i), 1, 0)
                             for i, x in enumerate(("NSE", "BSE", "NSE") if k % 2 else ("NSE",))])
        run_batches(stream_ltp(stream), table.write, str(tmp_path / "ck"), "update")
        want = ltp_quote(spark.read.schema(TICKS).parquet(inbox))
        assert rows(table.read(), "exchange", "exchange_token", "last_price") == rows(want, "exchange", "exchange_token", "last_price")
        assert len(committed(spark, f"{root}/snapshots", "upto")) <= 2
        assert len(committed(spark, f"{root}/changes", "batch")) <= 6
    # A batch that is only half written is not read.
    spark.createDataFrame([("NSE", 0, -1.0, None)], "exchange string, exchange_token long, last_price double, last_ts timestamp") \
        .write.parquet(f"{root}/changes/batch=99")
    os.remove(f"{root}/changes/batch=99/_SUCCESS")
    assert -1.0 not in {r.last_price for r in table.read().collect()}


def test_latest_result_reads_committed_versions(spark, tmp_path):
    path = str(tmp_path / "versions")
    for k in range(2):
        spark.range(k + 1).write.parquet(f"{path}/_batch_id={k}")
    assert latest_result(spark, path).count() == 2
    os.remove(f"{path}/_batch_id=1/_SUCCESS")
    assert latest_result(spark, path).count() == 1
    with pytest.raises(ValueError, match="committed"):
        latest_result(spark, str(tmp_path / "none"))


def test_late_rows_are_kept_across_restarts_and_retries(spark, tmp_path):
    split = LateSplit(spark, str(tmp_path / "split"))
    def batch(*data):
        df = spark.createDataFrame([(i, "NSE", 1, t, 1.0, 1, 0) for i, t in data], TICKS.replace("ts timestamp", "ts string"))
        return df.withColumn("ts", F.to_timestamp("ts"))
    batches = [batch((1, "2024-01-01 10:00:00"), (2, "2024-01-01 09:00:00")),
               batch((3, "2024-01-01 09:50:00"), (4, "2024-01-01 09:50:01"), (5, None), (6, "2024-01-01 11:00:00")),
               batch((7, "2024-01-01 10:40:00"), (1, "2024-01-01 10:00:00")), batch().limit(0),
               batch((8, "2024-01-01 10:50:01"))]
    for k, b in enumerate(batches):
        split.write(b, k)
    want = [(1, 3), (1, 5), (2, 1), (2, 7)]
    assert rows(split.late(), "batch", "event_id") == want
    assert rows(split.on_time(), "event_id") == [(1,), (2,), (4,), (6,), (8,)]
    again = LateSplit(spark, str(tmp_path / "split"))
    again.write(batches[2], 2)                              # a batch that comes again is split alike
    assert rows(again.late(), "batch", "event_id") == want
    assert {str(r.mark) for r in again.late().where("batch = 2").collect()} == {"2024-01-01 10:50:00"}


def test_master_lands_between_batches(spark, tmp_path):
    masters, root, inbox = (str(tmp_path / x) for x in ("masters", "out", "in"))
    schema = "instrument_key string, exchange_token long, exchange string, tradingsymbol string, src_pos long"
    def land(version, data):
        spark.createDataFrame(data, schema).write.parquet(f"{masters}/version={version}")
    job = FreshEnrich(spark, masters, root)
    os.makedirs(inbox)
    quotes = spark.readStream.schema("instrument_token string, last_price double").json(inbox)
    def send(k, *tokens):
        spark.createDataFrame([(t, float(k)) for t in tokens], "instrument_token string, last_price double") \
            .coalesce(1).write.mode("append").json(inbox)
        run_batches(quotes, job.write, str(tmp_path / "ck"))
    land(1, [("A", 1, "NSE_EQ", "OLD", 0)])
    send(0, "A", "B")
    spark.createDataFrame([("A", 1, "NSE_EQ", "HALF", 0)], schema).write.parquet(f"{masters}/version=9")
    os.remove(f"{masters}/version=9/_SUCCESS")              # still being written
    send(1, "A")
    land(2, [("A", 1, "NSE_EQ", "NEW", 0), ("B", 2, "BSE_EQ", "BEE", 1)])
    send(2, "A", "B")
    assert rows(job.read(), "batch", "instrument_token", "trading_symbol", "master_version") == [
        (0, "A", "OLD", 1), (1, "A", "OLD", 1), (2, "A", "NEW", 2), (2, "B", "BEE", 2)]
    assert rows(job.read("rejects"), "batch", "instrument_token", "reason", "master_version") == [(0, "B", "unknown_instrument", 1)]
    # Batch 0 again, after version 2 has landed: it keeps the version it used.
    job.write(spark.createDataFrame([("A", 0.0)], "instrument_token string, last_price double"), 0)
    assert rows(job.read().where("batch = 0"), "trading_symbol") == [("OLD",)]


def test_stream_keys_take_the_exchange(spark, tmp_path):
    inbox = str(tmp_path / "in")
    _drop(spark, inbox, [(1, "NSE", 5, "2024-01-01 04:00:00", 1.0, 1, 0), (2, "BSE", 5, "2024-01-01 04:00:01", 2.0, 1, 0),
                         (3, "NSE", 5, "2024-01-01 06:00:00", 3.0, 1, 0)])
    stream = spark.readStream.schema(TICKS).parquet(inbox)
    got = []
    for key in (None, ["exchange", "exchange_token"]):
        run_batches(stream_bars(stream, "1minute", key=key), lambda df, k: got.extend(df.collect()), str(tmp_path / f"ck{key}"))
    assert sorted((r.exchange, r.exchange_token, r.open) for r in got) == [("BSE", 5, 2.0)] * 2 + [("NSE", 5, 1.0)] * 2

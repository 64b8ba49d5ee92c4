"""Streaming jobs equal their batch counterparts on ordered files; late rows and
re-sent ticks are handled by the watermark (O30-O32)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickforge.operators import bars, ltp_quote
from tickforge.streaming import latest_result, run_to_table, stream_bars, stream_enrich, stream_ltp, tick_stream

SCHEMA = "event_id long, exchange_token long, ts timestamp, price double, qty long, oi long"


def _land(spark, folder, batches):
    """Write each batch as its own parquet file, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    for i, data in enumerate(batches):
        df = spark.createDataFrame(data, "event_id long, exchange_token long, ts string, price double, qty long, "
                                         "oi long").withColumn("ts", F.to_timestamp("ts"))
        tmp = f"{folder}_tmp{i}"
        df.coalesce(1).write.mode("overwrite").parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        dst = os.path.join(folder, f"ticks-{i:03d}.parquet")
        os.replace(os.path.join(tmp, part), dst)
        os.utime(dst, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


BATCHES = [
    [(1, 1, "2024-01-01 03:45:10", 10.0, 1, 1), (2, 2, "2024-01-01 03:45:20", 20.0, 2, 1),
     (3, 1, "2024-01-01 03:46:05", 11.0, 1, 2)],
    [(4, 1, "2024-01-01 03:50:00", 12.0, 3, 3), (3, 1, "2024-01-01 03:46:05", 11.0, 1, 2),   # re-sent tick
     (5, 2, "2024-01-01 04:10:00", 21.0, 1, 2)],
    [(7, 1, "2024-01-01 05:00:00", 13.0, 1, 4)],
    # Late: Spark drops rows behind the watermark the previous batch ran with (04:00 here).
    [(6, 1, "2024-01-01 03:40:00", 99.0, 9, 9)],
]


@pytest.fixture()
def landed(spark, tmp_path):
    folder = str(tmp_path / "ticks")
    _land(spark, folder, BATCHES)
    return folder


def test_stream_bars_watermark_and_dedup(spark, landed, tmp_path):
    s = tick_stream(spark, landed, SCHEMA, max_files_per_trigger=1)
    out = str(tmp_path / "bars")
    run_to_table(stream_bars(s, "1minute", "10 minutes"), out, str(tmp_path / "ck1"), "append")
    got = spark.read.parquet(out)
    # Final watermark is 04:50 UTC; the 05:00 bar is still open.  The late tick
    # (03:40 UTC) is dropped, the re-sent one counted once.
    assert rows(got, "exchange_token", "datetime", "open", "close", "volume") == [
        (1, "2024-01-01 09:15:00", 10.0, 10.0, 1), (1, "2024-01-01 09:16:00", 11.0, 11.0, 1),
        (1, "2024-01-01 09:20:00", 12.0, 12.0, 3),
        (2, "2024-01-01 09:15:00", 20.0, 20.0, 2), (2, "2024-01-01 09:40:00", 21.0, 21.0, 1)]


def test_stream_ltp_equals_batch(spark, landed, tmp_path):
    s = tick_stream(spark, landed, SCHEMA, max_files_per_trigger=1)
    out = str(tmp_path / "ltp")
    run_to_table(stream_ltp(s), out, str(tmp_path / "ck2"), "complete")
    got = latest_result(spark, out)
    batch = ltp_quote(spark.read.schema(SCHEMA).parquet(landed))  # no watermark: same rows
    assert rows(got, "exchange_token", "last_price") == rows(batch, "exchange_token", "last_price")


def test_stream_day_bars_equal_batch_on_ordered_files(spark, landed, tmp_path):
    s = tick_stream(spark, landed, SCHEMA)
    out = str(tmp_path / "day")
    # One batch, generous lateness: nothing dropped; day windows start at local midnight.
    run_to_table(stream_bars(s, "day", "1 day", dedup=False), out, str(tmp_path / "ck3"), "complete")
    got = latest_result(spark, out)
    batch = bars(spark.read.schema(SCHEMA).parquet(landed), "day")
    assert rows(got, "exchange_token", "datetime", "high", "volume") == \
        rows(batch, "exchange_token", "datetime", "high", "volume")


def test_stream_enrich(spark, landed, tmp_path):
    master = spark.createDataFrame([("K1", 1, "NSE_EQ", "ONE", 0), ("K2", 2, "BSE_EQ", "TWO", 1)],
                                   "instrument_key string, exchange_token int, exchange string, "
                                   "tradingsymbol string, src_pos long")
    s = tick_stream(spark, landed, SCHEMA).select(
        "event_id", F.concat(F.lit("K"), F.col("exchange_token").cast("string")).alias("instrument_token"),
        F.col("price").alias("last_price"))
    ok, _ = stream_enrich(s, master)
    out = str(tmp_path / "enrich")
    run_to_table(ok, out, str(tmp_path / "ck4"), "append")
    got = spark.read.parquet(out)
    assert got.count() == sum(len(b) for b in BATCHES)
    assert {(r.instrument_token, r.trading_symbol, r.instrument_type) for r in got.collect()} == {
        ("K1", "ONE", "EQ"), ("K2", "TWO", "EQ")}


def test_stream_merged_quotes_last_write_wins(spark, tmp_path):
    from tickforge.streaming import payload_stream, stream_merged_quotes
    master = spark.createDataFrame([("K1", 1, "NSE_EQ", "ONE", 0), ("K2", 2, "BSE_EQ", "TWO", 1)],
                                   "instrument_key string, exchange_token int, exchange string, "
                                   "tradingsymbol string, src_pos long")
    folder = tmp_path / "payloads"
    folder.mkdir()
    files = [
        '{"batch_no": 0, "payload": "{\\"status\\":\\"success\\",\\"data\\":{\\"a\\":{\\"instrument_token\\":\\"K1\\",'
        '\\"last_price\\":1.0},\\"b\\":{\\"instrument_token\\":\\"K2\\",\\"last_price\\":2.0}}}"}',
        '{"batch_no": 1, "payload": "{\\"status\\":\\"success\\",\\"data\\":{\\"c\\":{\\"instrument_token\\":\\"K1\\",'
        '\\"last_price\\":3.0},\\"d\\":{\\"instrument_token\\":\\"K1\\",\\"last_price\\":4.0}}}"}',
        '{"batch_no": 2, "payload": "{\\"status\\":\\"error\\"}"}',
    ]
    for i, line in enumerate(files):
        p = folder / f"p{i}.json"
        p.write_text(line + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    s = payload_stream(spark, str(folder), "batch_no long, payload string", max_files_per_trigger=1)
    out = str(tmp_path / "merged")
    run_to_table(stream_merged_quotes(s, master, key_cols=["exchange_token"]), out, str(tmp_path / "ck5"),
                 "complete")
    got = latest_result(spark, out)
    assert rows(got, "exchange_token", "last_price", "batch_no", "quote_key") == [(1, 4.0, 1, "d"),
                                                                                (2, 2.0, 0, "b")]


def test_update_mode_changelog(spark, landed, tmp_path):
    from tickforge.streaming import latest_state
    s = tick_stream(spark, landed, SCHEMA, max_files_per_trigger=1)
    out = str(tmp_path / "ltp_updates")
    run_to_table(stream_ltp(s), out, str(tmp_path / "ck6"), "update")
    log = spark.read.parquet(out)
    assert log.select("_batch_id").distinct().count() > 1          # several batches of changes
    got = latest_state(spark, out, ["exchange_token"])
    batch = ltp_quote(spark.read.schema(SCHEMA).parquet(landed))
    assert rows(got, "exchange_token", "last_price") == rows(batch, "exchange_token", "last_price")


def test_state_partitions_leave_session_conf(spark, landed, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = tick_stream(spark, landed, SCHEMA)
    run_to_table(stream_ltp(s), str(tmp_path / "sp"), str(tmp_path / "ck7"), "complete", state_partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert latest_result(spark, str(tmp_path / "sp")).count() == 2


def test_complete_mode_keeps_earlier_versions_readable(spark, landed, tmp_path):
    s = tick_stream(spark, landed, SCHEMA, max_files_per_trigger=1)
    out = str(tmp_path / "versions")
    run_to_table(stream_ltp(s), out, str(tmp_path / "ck8"), "complete")
    versions = spark.read.parquet(out)
    assert versions.select("_batch_id").distinct().count() == len(BATCHES)
    assert latest_result(spark, out).count() == versions.select("exchange_token").distinct().count()

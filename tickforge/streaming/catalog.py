"""Registered streaming jobs: ``events`` read as a file stream, results landed
under the shared checkpoint root and read back as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.exprs import format_local, to_market_time
from tickforge.operators.joins import broadcast_if_small
from tickforge.plans import views as V
from tickforge.session import staging_dir
from tickforge.plans.staging import stage_json_lines
from tickforge.streaming.live import (
    latest_result, payload_stream, run_to_table, stream_bars, stream_enrich, stream_ltp, stream_merged_quotes,
    tick_stream,
)
from tickforge.streaming.tables import LateSplit, LiveTable, run_batches

LATENESS = "10 minutes"


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    events = tick_stream(spark, d, V.table(spark, d, "events").schema, file_glob="events.parquet")
    return events.select("event_id", F.col("user_id").alias("exchange_token"),
                         F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"),
                         F.get_json_object("props", "$.k").cast("long").alias("qty"),
                         (F.col("event_id") % 1000).alias("oi"))


def _run(spark, stream, name, mode) -> DataFrame:
    sink = staging_dir(spark, f"{name}-out")
    # State partitions sized to the cluster's cores, not the batch default.
    run_to_table(stream, sink, staging_dir(spark, f"{name}-ckpt"), mode,
                 state_partitions=spark.sparkContext.defaultParallelism)
    return latest_result(spark, sink) if mode == "complete" else spark.read.parquet(sink)


def q_stream_enrich(spark, d):
    t = _ticks(spark, d)
    m = V.listed_master_view(spark, d)
    keys = V.quote_keys(spark, d)
    eid = F.col("event_id")
    quotes = (t.join(broadcast_if_small(keys), t["exchange_token"] == keys["_mt"])
              .select(eid.alias("pos"),
                      V.quote_token().alias("instrument_token"),
                      F.col("price").alias("last_price"), F.col("qty").alias("volume"), "oi"))
    enriched, _ = stream_enrich(quotes, m)
    out = _run(spark, enriched, "stream_enrich", "append")
    return out.select("pos", "instrument_token", "exchange_token", "trading_symbol", "instrument_type",
                      "last_price", "volume", "oi")


def q_stream_ltp(spark, d):
    out = _run(spark, stream_ltp(_ticks(spark, d)), "stream_ltp", "complete")
    return out.select("exchange_token", "last_price",
                      format_local(to_market_time("last_ts")).alias("last_time"))


def q_stream_ltp_compacted(spark, d):
    """Changes of each batch kept as a compacted table; ticks come in five drops by event type, a
    snapshot after every second batch."""
    root, inbox = staging_dir(spark, "ltp-live"), staging_dir(spark, "ltp-drops")
    table = LiveTable(spark, root, ["exchange", "exchange_token"], every=2)
    ticks = V.exchange_ticks_view(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    kind = V.table(spark, d, "events").select(F.col("event_id").alias("_id"), "event_type")
    ticks = ticks.join(kind, F.col("event_id") == F.col("_id")).drop("_id")
    for k, drop in enumerate(EVENT_DROPS):
        here = F.col("event_type").isin(*drop) if drop else ~F.col("event_type").isin(*[x for p in EVENT_DROPS for x in p])
        ticks.where(F.coalesce(here, F.lit(not drop))).drop("event_type").write.parquet(f"{inbox}/drop={k}")
        stream = spark.readStream.schema(ticks.drop("event_type").schema).parquet(f"{inbox}/*")
        run_batches(stream_ltp(stream), table.write, f"{root}/checkpoint", "update")
    return table.read().select("exchange", "exchange_token", "last_price", format_local(to_market_time("last_ts")).alias("last_time"))


#: Event types of each drop; the last takes all others.
EVENT_DROPS = [("click",), ("view",), ("purchase",), ("signup",), ()]

#: Days at which a drop of the late-tick run begins; ticks of large quantity come one drop late.
DROP_DAYS = ["2024-01-08", "2024-01-15", "2024-01-22"]
LATE_QTY = 90


def _late_run(spark, d) -> tuple[LateSplit, str]:
    """Four drops in order of time, each landed and run as a job of its own that goes on from
    the checkpoint of the one before.  Ticks of large quantity come a drop late; those traded in the last
    hour of a drop come again with the next one."""
    root, inbox = staging_dir(spark, "late-ticks"), staging_dir(spark, "tick-drops")
    split = LateSplit(spark, root, LATENESS)
    ticks = V.ticks_view(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    starts = [F.lit(x).cast("timestamp") for x in DROP_DAYS]
    due = F.lit(0)
    again = F.lit(False)
    for s in starts:
        due = due + F.when(F.col("ts") >= s, 1).otherwise(0)
        again = again | ((F.col("ts") >= s - F.expr("INTERVAL 1 HOUR")) & (F.col("ts") < s))
    last = len(starts)
    ticks = ticks.withColumns({"_due": F.least(due + F.when(F.col("qty") > LATE_QTY, 1).otherwise(0), F.lit(last)), "_again": again})
    for k in range(last + 1):
        mine = (F.col("_due") == k) | ((F.col("_due") == k - 1) & F.col("_again"))
        ticks.where(mine).drop("_due", "_again").write.parquet(f"{inbox}/drop={k}")
        landed, on_time = (spark.readStream.schema(ticks.drop("_due", "_again").schema).parquet(f"{folder}/*")
                           for folder in (inbox, f"{root}/on_time"))
        run_batches(landed, split.write, f"{root}/checkpoint-split")
        run_to_table(stream_bars(on_time, "1minute", LATENESS), f"{root}/bars", f"{root}/checkpoint-bars",
                     state_partitions=spark.sparkContext.defaultParallelism)
    return split, f"{root}/bars"


def q_stream_late_ticks(spark, d):
    split, _ = _late_run(spark, d)
    return split.late().select("batch", "event_id", "exchange_token", format_local(to_market_time("mark")).alias("mark"))


def q_stream_bars_restarted(spark, d):
    _, path = _late_run(spark, d)
    return spark.read.parquet(path).select("exchange_token", "datetime", "open", "high", "low", "close", "volume", "oi")


def q_stream_bars(spark, d):
    out = _run(spark, stream_bars(_ticks(spark, d), "1minute", LATENESS), "stream_bars", "append")
    return out.select("exchange_token", "datetime", "open", "high", "low", "close", "volume", "oi")


def q_stream_quotes_merged(spark, d):
    """Quote payloads of every batch landed as JSON lines, merged live."""
    landed = stage_json_lines(V.quote_payloads(spark, d), "quote-payloads")
    s = payload_stream(spark, landed, "batch_no long, payload string")
    cols = ["exchange", "exchange_token", "batch_no", "entry_pos", "quote_key", "instrument_token",
            "trading_symbol", "instrument_type", "last_price", "volume", "oi"]
    merged = stream_merged_quotes(s, V.listed_master_view(spark, d))
    out = _run(spark, merged, "stream_quotes_merged", "complete")
    return out.select(*[c for c in cols if c != "entry_pos"])


def queries():
    return {"stream_ltp_compacted": q_stream_ltp_compacted, "stream_late_ticks": q_stream_late_ticks,
            "stream_bars_restarted": q_stream_bars_restarted, "stream_enrich": q_stream_enrich, "stream_ltp": q_stream_ltp, "stream_bars": q_stream_bars,
            "stream_quotes_merged": q_stream_quotes_merged}

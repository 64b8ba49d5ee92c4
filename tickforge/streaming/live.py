"""Streaming operators.

* ``stream_enrich`` -- quote rows joined to the static master (stream-static join);
* ``stream_ltp``    -- last price per instrument, update/complete mode;
* ``stream_bars``   -- event-time bars with a watermark, append mode, duplicates
  dropped within the watermark.

Event time must be TIMESTAMP (``withWatermark`` rejects TIMESTAMP_NTZ), so the
tick reader casts it with the session zone set to UTC.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.exprs import MARKET_TZ, format_local
from tickforge.functions.intervals import INTERVALS
from tickforge.operators.bars import keys_of, ohlc_aggs, ohlc_out, tick_order
from tickforge.operators.quotes import enrich_quotes, merge_quote_batches
from tickforge.sources.payloads import parse_quotes
from tickforge.streaming.tables import committed

_SECONDS = {"minute": 60, "minutes": 60, "hour": 3600, "hours": 3600, "day": 86400, "days": 86400}


def _duration_seconds(dur: str) -> int:
    n, unit = dur.split()
    return int(n) * _SECONDS[unit]


def zone_offset_seconds(tz: str) -> int:
    """UTC offset of ``tz``.  A window's start offset is fixed for the whole stream, so a
    zone whose clock changes over the year is refused."""
    offsets = {ZoneInfo(tz).utcoffset(_dt.datetime(2024, m, 1)) for m in range(1, 13)}
    if len(offsets) > 1:
        raise ValueError(f"{tz} changes its UTC offset over the year; stream bars need a fixed one")
    return int(offsets.pop().total_seconds())


def tick_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """Parquet files landing in folder ``path`` as a stream (``file_glob``
    restricts which file names belong to it)."""
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def stream_enrich(quote_stream: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """O17 on a stream: the master side is static and broadcast when small."""
    return enrich_quotes(quote_stream, master)


def payload_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed payload records (JSON lines, e.g. ``batch_no, payload``) as a stream."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def stream_merged_quotes(payloads: DataFrame, master: DataFrame,
                         key_cols: list[str] | None = None) -> DataFrame:
    """O04 + O17 + O20 live: parse each landed payload, enrich from the static
    master and keep the last write per key (state: one row per key; run in
    update or complete mode)."""
    rows, _ = parse_quotes(payloads)
    enriched, _ = enrich_quotes(rows, master)
    return merge_quote_batches(enriched, key_cols=key_cols)


def stream_ltp(ticks: DataFrame, key: str | list[str] | None = None) -> DataFrame:
    """Running last price per instrument (state: one row per instrument); ``key`` is by default
    what identifies one in ``ticks``."""
    return ticks.groupBy(*keys_of(ticks, key)).agg(F.max_by("price", tick_order()).alias("last_price"),
                                  F.max(F.col("ts").cast("timestamp")).alias("last_ts"))


def stream_bars(ticks: DataFrame, interval: str = "1minute", lateness: str = "10 minutes",
                tz: str = MARKET_TZ, key: str | list[str] | None = None, dedup: bool = True) -> DataFrame:
    """Bars in event time, emitted once their window is behind the watermark.

    Windows are laid on UTC instants with a start offset so that they begin on
    the market-zone clock (day bars at local midnight).  Rows later than the
    watermark are dropped by Spark; re-sent ticks (same ``event_id``) are
    dropped within the watermark.
    """
    dur = INTERVALS.get(interval, interval)
    secs = _duration_seconds(dur)
    offset = (-zone_offset_seconds(tz)) % secs
    s = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    if dedup:
        s = s.dropDuplicatesWithinWatermark(["event_id"])
    w = F.window("ts", dur, dur, f"{offset} seconds")
    keys = keys_of(ticks, key)
    agg = s.groupBy(*keys, w.alias("_w")).agg(*ohlc_aggs())
    local = F.from_utc_timestamp(F.col("_w.start"), tz)
    return agg.select(*keys, format_local(local).alias("datetime"),
                      *ohlc_out(with_last_ts=False),
                      F.col("_w.end").alias("window_end"))


def run_to_table(stream: DataFrame, sink_path: str, checkpoint: str,
                 mode: str = "append", timeout_s: float | None = None,
                 state_partitions: int | None = None) -> None:
    """Run a stream over everything available now, then stop.

    * ``append``   -- parquet file sink (finalised rows only);
    * ``complete`` -- the whole result table, a version in a folder of its own per
      micro-batch, so that readers keep the last one while the next is written; read
      it back with ``latest_result``;
    * ``update``   -- changed rows appended as a changelog with ``_batch_id``;
      read it back with ``latest_state``.

    Each batch write is idempotent (file sink commit log, or a batch-id folder
    replaced on retry), and checkpoints live under the
    shared checkpoint root, so a lost executor or a restarted query does not
    duplicate rows.  ``state_partitions`` sets the number of state-store
    partitions of a new query (fixed in its checkpoint from then on); by
    default the session's ``spark.sql.shuffle.partitions`` applies.
    """
    if mode == "append":
        w = (stream.writeStream.format("parquet").option("path", sink_path)
             .option("checkpointLocation", checkpoint).outputMode("append"))
    elif mode == "complete":
        def write_all(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink_path}/_batch_id={batch_id}")
        w = (stream.writeStream.foreachBatch(write_all)
             .option("checkpointLocation", checkpoint).outputMode("complete"))
    elif mode == "update":
        def write_changes(batch: DataFrame, batch_id: int) -> None:
            (batch.withColumn("_batch_id", F.lit(batch_id).cast("long")).write
             .mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_batch_id").parquet(sink_path))
        w = (stream.writeStream.foreachBatch(write_changes)
             .option("checkpointLocation", checkpoint).outputMode("update"))
    else:
        raise ValueError(f"unknown output mode {mode!r}")
    spark = stream.sparkSession
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = w.trigger(availableNow=True).start()   # the query keeps its own copy of the conf
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish in time")
    if q.exception() is not None:
        raise q.exception()


def latest_result(spark: SparkSession, sink_path: str) -> DataFrame:
    """The newest version that a ``complete``-mode stream has committed (its folder's ``_SUCCESS``);
    one that is being written is not seen."""
    versions = committed(spark, sink_path, "_batch_id")
    if not versions:
        raise ValueError(f"no version has been committed to {sink_path}")
    return spark.read.parquet(versions[max(versions)])


def latest_state(spark: SparkSession, sink_path: str, key_cols: list[str]) -> DataFrame:
    """Current result of an ``update``-mode changelog: the newest row per key
    (an aggregate, combined map-side)."""
    log = spark.read.parquet(sink_path)
    others = [c for c in log.columns if c not in key_cols and c != "_batch_id"]
    picked = F.max_by(F.struct(*[F.col(c) for c in others]), F.col("_batch_id")).alias("_r")
    return log.groupBy(*key_cols).agg(picked).select(*key_cols, "_r.*")

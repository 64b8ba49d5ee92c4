"""Stored candles, ticks and bars: a bucketed candle table (O08) and bars kept up to date.

Everything is partitioned by market day (``trade_date``) and keeps the columns that identify an
instrument, so two exchanges that use one token stay apart.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.exprs import MARKET_TZ, to_market_time
from tickforge.operators.bars import bar_partials, keys_of
from tickforge.operators.joins import broadcast_if_small
from tickforge.schemas import CANDLE_COLUMNS
from tickforge.session import staging_dir

#: Columns that tell one instrument or series of candles from another, where a table has them.
IDENTITY = ["broker", "exchange", "exchange_token", "instrument_key", "interval_name"]


def candle_layout(candles: DataFrame, key=None) -> tuple[list[str], list[str]]:
    """(key columns, all stored columns): the key, every identity column present, the record columns
    and the day."""
    keys = keys_of(candles, key)
    names = [*keys, *[c for c in IDENTITY if c in candles.columns and c not in keys]]
    return keys, [*names, *CANDLE_COLUMNS, "trade_date"]


def save_candles(candles: DataFrame, table: str, path: str | None = None, key=None, buckets: int = 16) -> DataFrame:
    """Keep candles in the catalog table ``table``: Parquet under ``path`` (by default the warehouse),
    a partition per day, bucketed by the instrument within it, and return the table (O08).

    A history join of the table then reads it in its buckets and does not shuffle it -- only the
    requests are dealt out -- in a session with ``session.keep_buckets``.  ``buckets`` is fixed when the table is
    made: choose it so that a bucket of the days usually read together fits a task.  One day's bucket
    is one file.  Saving to a table that exists replaces the days written and keeps the others;
    its key and buckets must be those it was made with.
    """
    spark = candles.sparkSession
    keys, cols = candle_layout(candles, key)
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    rows = candles.select(*cols).repartition("trade_date", bucket)
    if not spark.catalog.tableExists(table):
        w = (rows.write.format("parquet").partitionBy("trade_date").bucketBy(buckets, *keys)
             .sortBy(*keys, "datetime"))
        (w.option("path", path) if path else w).saveAsTable(table)
        return spark.table(table)
    made = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    have = re.findall(r"`([^`]+)`", made.get("Bucket Columns", ""))
    if have != keys or int(made["Num Buckets"]) != buckets:
        raise ValueError(f"{table} is bucketed by {have} into {made.get('Num Buckets')}, not by {keys} into {buckets}")
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
    return spark.table(table)


def _by_day(df: DataFrame, path: str) -> None:
    """Write days, each replacing the stored one."""
    (df.hint("rebalance", "trade_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("trade_date").parquet(path))


class BarStore:
    """Ticks by market day under ``root``/ticks and their partial bars under ``root``/bars.

    ``merge`` takes new and corrected ticks.  A tick is known by its market day and ``event_id``; one
    that comes again replaces the stored one, so a batch may be sent twice, late or for an old
    day.  Only days that the batch touches are read and rewritten, and their bars made anew from
    their ticks; the result is that of a rebuild from all ticks.  The new days are first written
    to the shared staging folder and only then replace the old ones, so nothing is read from what is being
    replaced; one merge runs at a time.
    """

    def __init__(self, spark: SparkSession, root: str, interval: str = "1minute", tz: str = MARKET_TZ, key=None):
        self.spark, self.root, self.interval, self.tz, self.key = spark, root, interval, tz, key

    @property
    def ticks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/ticks")

    @property
    def bars(self) -> DataFrame:
        """Partial bars, which ``roll_up`` makes into longer ones."""
        return self.spark.read.parquet(f"{self.root}/bars")

    def merge(self, batch: DataFrame, first: bool = False) -> None:
        """Merge a batch of ticks; ``first`` says that the store is still empty.

        Of rows with one day and ``event_id`` inside a batch, the one with the greatest other
        columns (in column order) stays.  A tick without a time has no bar but is kept.
        """
        rows = batch.withColumn("trade_date", F.to_date(to_market_time("ts", self.tz)))
        others = [c for c in batch.columns if c != "event_id"]
        staged = staging_dir(self.spark, "bar-store")
        (rows.groupBy("trade_date", "event_id").agg(F.max(F.struct(*others)).alias("_t"))
         .select("event_id", "_t.*", "trade_date").write.parquet(f"{staged}/batch"))
        new = self.spark.read.parquet(f"{staged}/batch")
        merged = new
        if not first:
            days = broadcast_if_small(new.select(F.col("trade_date").alias("_day")).distinct())
            again = new.select(F.col("trade_date").alias("_day"), F.col("event_id").alias("_id"))
            old = self.ticks
            old = old.join(days, F.col("trade_date").eqNullSafe(F.col("_day")), "left_semi")
            old = old.join(again, F.col("trade_date").eqNullSafe(F.col("_day"))
                           & F.col("event_id").eqNullSafe(F.col("_id")), "left_anti")
            merged = old.select(new.columns).unionByName(new)
        merged.write.parquet(f"{staged}/ticks")
        days = self.spark.read.parquet(f"{staged}/ticks")
        _by_day(days, f"{self.root}/ticks")
        keys = keys_of(days, self.key)
        _by_day(bar_partials(days, self.interval, self.tz, keys), f"{self.root}/bars")

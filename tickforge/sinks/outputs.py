"""Sinks and the per-request response envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import MARKET_TZ, to_market_time
from tickforge.sinks.stores import candle_layout


def list_master(master: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The complete master as records (O07): a projection, in a fixed column order."""
    return master.select(*(columns or master.columns))


def write_master(master: DataFrame, path: str, partition_col: str = "broker",
                 mode: str = "overwrite") -> None:
    """Store the master once as Parquet, partitioned by broker."""
    w = master.write.mode(mode)
    if partition_col in master.columns:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def write_candles(candles: DataFrame, path: str, key: str | list[str] | None = None,
                  fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write candles with the record columns and every column that identifies their series
    (``key``, and of broker, exchange, token, instrument key and interval those present),
    partitioned by ``trade_date`` and sorted by instrument and time inside each file (O08).

    Rebalancing on ``trade_date`` gives each day few files, and AQE splits only a
    day too large for one task.  Overwriting replaces the days written and keeps
    the others.  ``save_candles`` keeps a bucketed table instead.
    """
    keys, cols = candle_layout(candles, key)
    out = (candles.select(*cols)
           .hint("rebalance", "trade_date")
           .sortWithinPartitions("trade_date", *keys, "datetime"))
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("trade_date").format(fmt).save(path)


def write_ticks(ticks: DataFrame, path: str, tz: str = MARKET_TZ, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Store ticks by market day (``trade_date``), which ``since`` then prunes.

    A tick without a time goes to Spark's default partition.  Overwriting replaces
    the days written and keeps the others.
    """
    out = ticks.withColumn("trade_date", F.to_date(to_market_time("ts", tz))).hint("rebalance", "trade_date")
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("trade_date").format(fmt).save(path)


# Response codes of the service (fixed values).
STATUS_OK, STATUS_BAD_REQUEST, STATUS_NOT_FOUND, STATUS_ERROR = 200, 400, 404, 500


def request_status(requests: DataFrame, rejects: DataFrame, results: DataFrame,
                   errors: DataFrame | None = None, request_col: str = "request_id") -> DataFrame:
    """One envelope row per request.

    * 400 ``invalid`` -- any item was rejected or not found in the master;
    * 500 ``error``   -- a batch of the request failed (``errors`` rows);
    * 404 ``no data`` -- nothing came back (the service meant 404 here, but its
      generic handler turned it into 500);
    * 200 ``success`` with ``n_items`` result rows otherwise.

    ``results`` and ``rejects`` are keyed by ``request_col``; each side is
    counted per request first, so the joins are between small per-request rows.
    """
    reqs = requests.select(request_col).distinct()

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(request_col).alias(f"{name}_id")).agg(F.count(F.lit(1)).alias(name))

    j = reqs
    sides = [(rejects, "_bad"), (results, "_got")] + ([(errors, "_err")] if errors is not None else [])
    for df, name in sides:
        # Null-safe: a request without an id still gets its own envelope.
        c = counted(df, name)
        j = j.join(c, j[request_col].eqNullSafe(c[f"{name}_id"]), "left").drop(f"{name}_id")
    if errors is None:
        j = j.withColumn("_err", F.lit(None).cast("long"))
    code = (F.when(F.col("_bad") > 0, F.lit(STATUS_BAD_REQUEST))
            .when(F.col("_err") > 0, F.lit(STATUS_ERROR))
            .when(F.coalesce(F.col("_got"), F.lit(0)) == 0, F.lit(STATUS_NOT_FOUND))
            .otherwise(F.lit(STATUS_OK)))
    label = (F.when(code == STATUS_OK, "success").when(code == STATUS_BAD_REQUEST, "invalid")
             .when(code == STATUS_NOT_FOUND, "no data").otherwise("error"))
    return j.select(request_col, code.alias("status_code"), label.alias("status"),
                    F.coalesce(F.col("_got"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce(F.col("_bad"), F.lit(0)).cast("long").alias("n_rejected"))

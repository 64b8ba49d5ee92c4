"""Ordered positions within groups, key batches (O27) and date chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.exprs import lenient_date
from tickforge.operators.joins import broadcast_if_small
from tickforge.session import checkpoint_root


def ordinal_within(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   out: str = "ordinal", n_ranges: int | None = None,
                   checkpoint: bool = True) -> DataFrame:
    """1-based position of each row inside its group, ordered by ``order_cols``.

    Same result as ``row_number() OVER (PARTITION BY group ORDER BY order)`` but
    no group is ever held by one task, so a request holding a third of all rows
    still spreads over the cluster:

    1. range-partition on ``(group, order)`` -- a hot group spans many ranges --
       and number rows inside each sorted range with ``monotonically_increasing_id``
       (increasing within a partition), tagging the range with ``spark_partition_id``;
    2. per (group, range): first id and row count (a tiny table: at most
       ranges + groups rows);
    3. running sum of counts over the ranges of a group gives each range's offset;
    4. join the offsets back (broadcast when small) and add.

    ``order_cols`` must order rows of a group totally (add a tie-breaker).
    Range bounds come from sampling and ids from row order, so the numbered
    rows are checkpointed (reliably, under ``spark.checkpoint.dir``) before
    the two branches read them: ids and counts then agree, and a lost
    executor cannot renumber rows.  ``checkpoint=False`` skips that for
    inputs known to be deterministic.
    """
    spark = df.sparkSession
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    ranged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumns({"_mid": F.monotonically_increasing_id(), "_rng": F.spark_partition_id()}))
    if checkpoint:
        checkpoint_root(spark)
        ranged = ranged.checkpoint(eager=True)
    stats = (ranged.groupBy(*group_cols, "_rng")
             .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt")))
    before = (Window.partitionBy(*group_cols).orderBy("_rng")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = stats.select(*[F.col(c).alias(f"_o_{i}") for i, c in enumerate(group_cols)],
                           F.col("_rng").alias("_o_rng"), "_first",
                           F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # Null-safe on the group columns: a NULL group is still a group.
    cond = [ranged[c].eqNullSafe(F.col(f"_o_{i}")) for i, c in enumerate(group_cols)]
    joined = ranged.join(broadcast_if_small(offsets), [*cond, ranged["_rng"] == F.col("_o_rng")])
    return joined.select(*df.columns,
                         (F.col("_mid") - F.col("_first") + F.col("_off") + 1).alias(out))


def plan_key_batches(keys: DataFrame, size: int, group_col: str = "request_id",
                     pos_col: str = "pos", key_col: str = "instrument_key",
                     sep: str = ",") -> DataFrame:
    """Split each request's ordered key list into batches of ``size``.

    Feed A sends 750 keys per LTP call and 450 per OHLC / full-quote call; the
    batch string is the keys joined with ``,`` in request order.  Output: one row
    per (request, batch) with ``batch_no`` (0-based), ``n_keys``, ``keys``.
    Every batch holds at most ``size`` keys, so the final collect is bounded.
    """
    if size <= 0:
        raise ValueError("batch size must be positive")
    ranked = ordinal_within(keys.select(group_col, pos_col, key_col), [group_col],
                            [pos_col, key_col], out="_ord")
    batched = ranked.withColumn("batch_no", F.floor((F.col("_ord") - 1) / size).cast("long"))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(pos_col), F.col(key_col))))
    return (batched.groupBy(group_col, "batch_no")
            .agg(F.count(F.lit(1)).alias("n_keys"),
                 F.array_join(F.transform(ordered, lambda s: s[key_col]), sep).alias("keys")))


def plan_date_chunks(requests: DataFrame, from_col: str = "from_date", to_col: str = "to_date",
                     days: int = 1000, legacy: bool = False) -> DataFrame:
    """Split ``[from, to]`` into consecutive inclusive chunks of at most ``days`` days.

    A chunk runs ``start .. min(start + days - 1, to)``; the next starts the day
    after.  Reversed ranges give no chunk.  ``legacy=True`` keeps only chunks
    whose start is strictly before ``to``: the original loop's ``start < to``,
    which drops a one-day range and a trailing one-day chunk.
    Output: input columns plus ``chunk_no`` (0-based), ``chunk_from``, ``chunk_to`` (DATE).
    """
    f = lenient_date(from_col)
    t = lenient_date(to_col)
    # Filter first: sequence() throws on reversed bounds; unparseable dates drop out.
    valid = requests.where(f <= t)
    step = F.expr(f"INTERVAL {int(days)} DAYS")
    chunks = valid.select("*", F.posexplode(F.sequence(f, t, step)).alias("chunk_no", "chunk_from"))
    chunks = chunks.withColumn("chunk_to", F.least(F.date_add("chunk_from", days - 1), t))
    if legacy:
        chunks = chunks.where(F.col("chunk_from") < t)
    return chunks.withColumn("chunk_no", F.col("chunk_no").cast("long"))


def explode_days(df: DataFrame, from_col: Column, to_col: Column, out: str = "trade_date") -> DataFrame:
    """One row per calendar day of ``[from, to]`` (empty for reversed ranges).

    Months first, then their days, so that no row ever holds an array of a whole
    range, however long.
    """
    ranged = df.withColumns({"_first": from_col, "_last": to_col}).where("_first <= _last")
    months = ranged.withColumn("_month", F.explode(F.sequence(F.trunc("_first", "MM"), F.col("_last"),
                                                              F.expr("INTERVAL 1 MONTH"))))
    days = F.sequence(F.greatest("_first", "_month"), F.least("_last", F.last_day("_month")))
    return months.withColumn(out, F.explode(days)).drop("_first", "_last", "_month")

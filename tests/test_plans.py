"""Physical-plan properties the jobs rely on at scale."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickforge.operators.joins import broadcast_if_small, estimate_is_upper_bound
from tickforge.plans import catalog
from tickforge.session import apply_conf


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_broadcast_on_exploded_estimates(spark):
    exploded = spark.range(10).withColumn("d", F.explode(F.sequence(F.lit(1), F.lit(5))))
    assert not estimate_is_upper_bound(exploded)
    assert broadcast_if_small(exploded) is exploded
    small = spark.range(10)
    assert broadcast_if_small(small) is not small
    assert broadcast_if_small(small, limit=1) is small


def test_master_lookup_is_broadcast(spark):
    plan = _plan(catalog.q_resolved(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_tick_scan_is_pruned(spark):
    plan = _plan(catalog.q_ltp(spark, SF_SMALL))
    read = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "props" not in read and "event_type" not in read
    assert "HashAggregate" in plan or "SortAggregate" in plan


def test_history_joins_on_instrument_day(spark):
    plan = _plan(catalog.q_historical(spark, SF_SMALL))
    assert "Generate explode(sequence" in plan
    joins = [ln for ln in plan.splitlines() if "Join [_unit" in ln]
    assert any("_c_trade_date" in ln and "trunc" not in ln for ln in joins)        # short ranges: (instrument, day)
    assert any("trunc(_c_trade_date" in ln for ln in joins)                        # long ones: (instrument, month)


def test_stored_candles_are_not_shuffled(spark):
    """A history job over the bucketed table deals out the requests only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.q_historical_stored(spark, SF_SMALL)
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        apply_conf(spark)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    lines = final.splitlines()
    scans = [i for i, ln in enumerate(lines) if "FileScan parquet spark_catalog" in ln and "Bucketed: true" in ln]
    assert len(scans) == 2                                                         # by day and by month
    for i in scans:
        join = max(k for k in range(i) if "SortMergeJoin" in lines[k])
        depth = [ln.index(ln.lstrip(" :+-")) for ln in lines]
        above = [k for k in range(join, i) if depth[k] < depth[i] and all(depth[m] > depth[k] for m in range(k + 1, i + 1))]
        assert not any("Exchange" in lines[k] for k in above)


def test_month_probes_follow_the_candles(spark):
    """A request for all time asks for as many rows as the candles have months."""
    from tickforge.operators import history
    candles = spark.sql("SELECT 1L AS exchange_token, date_add(DATE'2024-01-20', CAST(id AS INT)) AS trade_date FROM range(60)")
    for c in history.CANDLE_COLUMNS:
        candles = candles.withColumn(c, F.lit(c))
    items = spark.sql("SELECT 1L AS request_id, 1L AS exchange_token, DATE'0001-01-01' AS from_date, DATE'9999-12-31' AS to_date")
    df = history.historical_data(items, candles)
    assert df.count() == 60
    asked = items.selectExpr("from_date AS _from", "to_date AS _to")
    near, far = history._probes(asked, *(F.lit(x).cast("date") for x in ("2024-01-20", "2024-03-19")))
    assert (near.count(), far.count()) == (0, 3)
    assert history._probes(asked, *[F.lit(None).cast("date")] * 2)[1].count() == 0
    assert history.historical_data(items, candles.limit(0)).count() == 0


def test_coverage_spreads_no_days(spark):
    plan = _plan(catalog.q_chunk_coverage(spark, SF_SMALL))
    assert plan.count("Generate explode") <= plan.count("posexplode") and "reduce" in plan or "aggregate(" in plan


def test_rolled_bars_read_no_ticks(spark):
    for job in (catalog._rolled("day"), catalog._rolled("30minute")):
        df = job(spark, SF_SMALL)
        assert "events.parquet" not in df._jdf.queryExecution().executedPlan().toString()


def test_ohlc_endpoint_reads_ticks_once_more(spark):
    """The instruments' last ticks come from a checkpoint; the answer scans the ticks once."""
    plan = catalog.q_ohlc_for_requests(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1


def test_key_batches_read_checkpoint(spark):
    plan = _plan(catalog._key_batches(750)(spark, SF_SMALL))
    assert "rangepartitioning" not in plan        # numbered rows come from the checkpoint
    assert "ExistingRDD" in plan


def test_stored_history_prunes_date_partitions(spark):
    plan = _plan(catalog.q_historical_stored(spark, SF_SMALL))
    assert "dynamicpruning" in plan


def test_stored_quotes_and_windows_prune_date_partitions(spark):
    for job in (catalog.q_full_quote_stored, catalog.q_trailing_window_stored):
        df = job(spark, SF_SMALL)
        filters = [ln for ln in _plan(df).splitlines() if "PartitionFilters: [" in ln]
        assert any("trade_date" in ln.split("PartitionFilters: [")[1].split("]")[0] for ln in filters)


def test_latest_bars_read_only_the_last_bucket(spark):
    plan = _plan(catalog._ohlc("I1")(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "SortAggregate" not in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1       # one bar per instrument is shuffled

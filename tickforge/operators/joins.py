"""Join-side helpers: broadcast a side only when its size is checked."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound (bytes, optimizer estimate) for sides we broadcast explicitly.
# Above it we leave the join to the planner: sort-merge with AQE, which can still
# demote it to a broadcast from measured shuffle sizes, and splits skewed keys.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
# File-based estimates count compressed bytes on disk; a broadcast relation
# is held decoded in memory, typically several times larger.  The estimate is
# multiplied by this allowance before it is compared with the limit.
COMPRESSION_ALLOWANCE = 4

_UNITS = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40,
          "PiB": 1 << 50, "EiB": 1 << 60}
_SIZE = re.compile(r"Statistics\(sizeInBytes=([0-9.]+(?:E[0-9]+)?)\s*([KMGTPE]?i?B)")


def optimized_plan_with_costs(df: DataFrame) -> str:
    """The optimized logical plan with Catalyst's size estimate per node, from
    ``EXPLAIN COST`` (plan text only; no data is read)."""
    spark = df.sparkSession
    name = f"_tickforge_cost_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        text = spark.sql(f"EXPLAIN COST SELECT * FROM {name}").first()[0]
    finally:
        spark.catalog.dropTempView(name)
    return text.split("== Physical Plan ==")[0]


def estimated_bytes(df: DataFrame, plan: str | None = None) -> int:
    """Catalyst's size estimate of ``df`` (its top node in ``EXPLAIN COST``).

    For file scans it is the bytes of the selected columns; filters and
    aggregates keep it as an upper estimate.  Unknown -> a huge number.
    """
    m = _SIZE.search(plan if plan is not None else optimized_plan_with_costs(df))
    if not m:
        return 1 << 62
    return int(float(m.group(1)) * _UNITS[m.group(2)])


def estimate_is_upper_bound(df: DataFrame, plan: str | None = None) -> bool:
    """False when the plan holds a node whose estimate can fall below its real
    size: ``Generate`` (explode) keeps its child's row count in the estimate."""
    text = plan if plan is not None else optimized_plan_with_costs(df)
    return not any(line.lstrip(" :+-").startswith("Generate ") for line in text.splitlines())


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.tickforge.broadcastLimit`` in bytes, or 64 MiB."""
    conf = spark.conf.get("spark.tickforge.broadcastLimit", None)
    return int(conf) if conf else DEFAULT_BROADCAST_LIMIT


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is a safe bound and, with the
    compression allowance, within ``limit``; else ``df`` unchanged (AQE then
    decides from measured sizes).

    ``limit`` defaults to ``spark.tickforge.broadcastLimit`` or 64 MiB.
    """
    if limit is None:
        limit = broadcast_limit(df.sparkSession)
    plan = optimized_plan_with_costs(df)
    if estimate_is_upper_bound(df, plan) and estimated_bytes(df, plan) * COMPRESSION_ALLOWANCE <= limit:
        return F.broadcast(df)
    return df

"""Instrument-master operators: one broker-agnostic master (O10) and the
index-symbol back-fill (O11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import exchange_segment, nth_part
from tickforge.functions.index_keys import INDEX_KEYS
from tickforge.operators.joins import broadcast_if_small
from tickforge.schemas import MASTER_B_TYPES

# Leading columns of the unified master, in order; a feed's other columns follow.
UNIFIED_COLUMNS = ["broker", "instrument_key", "exchange_token", "exchange", "segment",
                   "instrument_type", "tradingsymbol", "name", "src_pos"]


def _rest(df: DataFrame, used: set[str]) -> list:
    """The feed's other columns.  Contract details get one type in every feed; a name
    that the unified master computes itself is kept as ``feed_<name>``."""
    out = []
    for c in df.columns:
        if c in used:
            continue
        col = F.col(f"`{c}`")
        if c in UNIFIED_COLUMNS:
            out.append(col.alias(f"feed_{c}"))
        elif c in MASTER_B_TYPES:
            out.append(col.try_cast(MASTER_B_TYPES[c]).alias(c))
        else:
            out.append(col)
    return out


def _feed_a(df: DataFrame) -> DataFrame:
    # Feed A encodes the type in the exchange column: NSE_EQ -> exchange NSE, type EQ.
    name = F.col("name") if "name" in df.columns else F.lit(None)
    return df.select(
        F.col("instrument_key"),
        F.col("exchange_token").try_cast("long").alias("exchange_token"),
        nth_part("exchange", "_", 1).alias("exchange"),
        F.col("exchange").alias("segment"),
        exchange_segment("exchange").alias("instrument_type"),
        F.col("tradingsymbol"),
        name.cast("string").alias("name"),
        F.col("src_pos").cast("long").alias("src_pos"),
        *_rest(df, {"instrument_key", "exchange_token", "exchange", "tradingsymbol", "name", "src_pos"}),
    )


def _feed_b(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("instrument_token").cast("string").alias("instrument_key"),
        F.col("exchange_token").try_cast("long").alias("exchange_token"),
        F.col("exchange"),
        F.col("segment"),
        F.col("instrument_type"),
        F.col("tradingsymbol"),
        F.col("name"),
        F.col("src_pos").cast("long").alias("src_pos"),
        *_rest(df, {"instrument_token", "exchange_token", "exchange", "segment", "instrument_type",
                    "tradingsymbol", "name", "src_pos"}),
    )


# Known feed layouts: feed name -> projection to the unified columns.
FEED_LAYOUTS = {"feed_a": _feed_a, "feed_b": _feed_b}


def unify_masters(feeds: dict[str, DataFrame], layouts: dict[str, str] | None = None) -> DataFrame:
    """One master over several feeds.

    ``feeds`` maps a broker name (case-insensitive) to its master; ``layouts``
    maps the broker to ``feed_a`` / ``feed_b`` (default: the broker name
    itself).  An unknown broker or layout raises before any job runs.  Every
    column of every feed is kept (expiry, strike, lot size, ...); the union is by
    name, so a feed's missing columns come out NULL.
    """
    layouts = {k.lower(): v.lower() for k, v in (layouts or {}).items()}
    parts = []
    for broker, df in feeds.items():
        b = broker.lower()
        layout = layouts.get(b, b)
        if layout not in FEED_LAYOUTS:
            raise ValueError(f"unsupported broker {broker!r}; known layouts: {sorted(FEED_LAYOUTS)}")
        parts.append(FEED_LAYOUTS[layout](df).withColumn("broker", F.lit(b)))
    if not parts:
        raise ValueError("no feeds given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*UNIFIED_COLUMNS, *[c for c in out.columns if c not in UNIFIED_COLUMNS])


def index_symbol_map(keys: DataFrame | None = None, spark=None, key_col: str = "instrument_key") -> DataFrame:
    """``instrument_key -> symbol`` with symbol = upper(trim(part after '|')).

    Default keys are the fixed index list; pass a DataFrame of keys to use others.
    """
    if keys is None:
        if spark is None:
            raise ValueError("spark is required for the default index keys")
        keys = spark.createDataFrame([(k,) for k in INDEX_KEYS], [key_col])
    return (keys.select(F.col(key_col).alias("_map_key"))
            .where(F.col("_map_key").isNotNull())
            .dropDuplicates(["_map_key"])
            .withColumn("_map_symbol", F.upper(F.trim(nth_part("_map_key", "|", 2)))))


def backfill_index_symbols(master: DataFrame, symbol_map: DataFrame | None = None,
                           key_col: str = "instrument_key",
                           symbol_col: str = "trading_symbol") -> DataFrame:
    """Fill empty symbols from the index map.

    Left join on the key; where the symbol is ``''`` it takes the mapped value
    (NULL when the key has no entry); a NULL symbol stays NULL; other symbols are
    kept.  The helper columns are dropped.
    """
    m = symbol_map if symbol_map is not None else index_symbol_map(spark=master.sparkSession)
    joined = master.join(broadcast_if_small(m), master[key_col] == m["_map_key"], "left")
    filled = F.when(F.col(symbol_col) == "", F.col("_map_symbol")).otherwise(F.col(symbol_col))
    return joined.withColumn(symbol_col, filled).drop("_map_key", "_map_symbol")

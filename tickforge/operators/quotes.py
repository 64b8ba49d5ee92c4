"""Quote payload rows: enrichment from the master (O17), batch merge (O20) and
the field-by-instrument matrix (O26)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import exchange_segment, nth_part
from tickforge.operators.joins import broadcast_if_small
from tickforge.operators.resolve import first_match


def enrich_quotes(quotes: DataFrame, master: DataFrame,
                  token_col: str = "instrument_token") -> tuple[DataFrame, DataFrame]:
    """Attach ``trading_symbol``, ``instrument_type``, ``exchange`` and the new key
    ``exchange_token`` to quote rows whose ``instrument_token`` is a master
    ``instrument_key`` (O17).  A master with a ``segment`` column (feed B, or the
    unified master, which also gives ``broker``) names exchange and type itself;
    feed A encodes both in ``exchange``.

    Returns ``(enriched, rejects)``: rows with a NULL token
    (``missing_instrument_token``) or no master row (``unknown_instrument``) are
    set aside instead of failing the batch.
    """
    plain = {"segment", "instrument_type"} <= set(master.columns)
    kind = F.col("instrument_type") if plain else exchange_segment("exchange")
    venue = F.col("exchange") if plain else nth_part("exchange", "_", 1)
    wanted = {"trading_symbol": F.col("tradingsymbol"), "instrument_type": kind, "exchange": venue,
              "exchange_token": F.col("exchange_token")}
    if "broker" in master.columns:
        wanted["broker"] = F.col("broker")
    order = [F.col(c) for c in ("src_file", "src_pos", "broker") if c in master.columns]
    m = first_match(master.select(F.col("instrument_key").alias("_m_key"), *order,
                                  *[c.alias(f"_m_{n}") for n, c in wanted.items()]), ["_m_key"])
    m = m.select("_m_key", *[f"_m_{n}" for n in wanted])
    joined = quotes.join(broadcast_if_small(m), quotes[token_col] == m["_m_key"], "left")
    enriched = (joined.where(F.col("_m_key").isNotNull())
                .withColumns({n: F.col(f"_m_{n}") for n in wanted})
                .drop("_m_key", *[f"_m_{n}" for n in wanted]))
    reason = (F.when(F.col(token_col).isNull(), F.lit("missing_instrument_token"))
              .otherwise(F.lit("unknown_instrument")))
    rejects = (joined.where(F.col("_m_key").isNull())
               .drop("_m_key", *[f"_m_{n}" for n in wanted])
               .withColumn("reason", reason))
    return enriched, rejects


def merge_quote_batches(quotes: DataFrame, key_cols: list[str] | None = None,
                        order_cols: tuple[str, str] = ("batch_no", "entry_pos")) -> DataFrame:
    """Merge per-batch quote rows; for one key the last one written wins.

    "Last" is the largest ``(batch_no, entry_pos)``: later batches overwrite
    earlier ones, and within a batch later entries overwrite earlier ones.  The
    default key is ``(exchange, exchange_token)``, with ``broker`` where the
    quotes carry it (a single feed has none); without an exchange it raises.  Pass
    ``['exchange_token']`` for the service's original key, under which equal
    tokens of two exchanges overwrite each other.
    """
    if key_cols is None:
        lacking = {"exchange", "exchange_token"} - set(quotes.columns)
        if lacking:
            raise ValueError(f"the default merge key needs {sorted(lacking)}; name key_cols")
        key_cols = [c for c in ("broker", "exchange", "exchange_token") if c in quotes.columns]
    others = [c for c in quotes.columns if c not in key_cols]
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_q")
    return quotes.groupBy(*key_cols).agg(picked).select(*key_cols, "_q.*")


def quote_matrix(quotes: DataFrame, tokens: list, fields: list[str],
                 key: str = "exchange_token", prefix: str = "tok_") -> DataFrame:
    """Wide view: one row per field, one column per instrument.

    ``tokens`` must be an explicit, bounded list: it fixes the output columns and
    lets ``pivot`` skip its distinct-values job.  Values are cast to DOUBLE.
    """
    if not tokens:
        raise ValueError("quote_matrix needs an explicit list of instruments")
    long = quotes.where(F.col(key).isin(*tokens)).select(
        F.col(key),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"),
                                     F.col(f).cast("double").alias("value")) for f in fields])).alias("_kv"))
    wide = (long.select(key, "_kv.field", "_kv.value")
            .groupBy("field").pivot(key, tokens).agg(F.first("value", ignorenulls=True)))
    return wide.select("field", *[F.col(str(t)).alias(f"{prefix}{t}") for t in tokens])

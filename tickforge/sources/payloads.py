"""Quote and candle payloads landed as JSON text.

Input frames hold one payload per row in a string column.  A payload that is
not JSON, not ``status == 'success'`` or has no ``data`` becomes a reject row;
nothing is raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.exprs import MARKET_TZ, lenient_long
from tickforge.operators.history import normalise_candle_time
from tickforge.schemas import CANDLE_PAYLOAD, QUOTE_ENTRY, QUOTE_PAYLOAD

# Envelope value of a good response (fixed value).
SUCCESS = "success"


def _envelope_reason(parsed: str, data_present) -> F.Column:
    # from_json on garbage gives a struct of NULLs, so test the fields.
    return (F.when(F.col(f"{parsed}.status").isNull() & data_present.isNull(), F.lit("not_json_or_empty"))
            .when(F.coalesce(F.col(f"{parsed}.status"), F.lit("")) != SUCCESS, F.lit("not_success"))
            .when(data_present.isNull(), F.lit("missing_data")))


def parse_quotes(payloads: DataFrame, payload_col: str = "payload",
                 keep_raw: bool = False, raw_as_variant: bool = False) -> tuple[DataFrame, DataFrame]:
    """Quote payloads -> one row per entry of ``data``.

    Returns ``(rows, rejects)``.  Rows carry the payload's other columns (e.g.
    ``batch_no``), ``entry_pos`` (order inside ``data``), ``quote_key`` and the
    typed entry fields.  ``keep_raw=True`` adds ``raw`` with the entry's JSON
    text, so fields outside the declared schema are not lost;
    ``raw_as_variant=True`` stores it as VARIANT (query with ``variant_get``).
    """
    carry = [c for c in payloads.columns if c != payload_col]
    p = payloads.withColumn("_p", F.from_json(F.col(payload_col), QUOTE_PAYLOAD))
    p = p.withColumn("_reason", _envelope_reason("_p", F.col("_p.data")))
    rejects = p.where(F.col("_reason").isNotNull()).select(*carry, F.col("_reason").alias("reason"))
    good = p.where(F.col("_reason").isNull())
    if keep_raw:
        raw_schema = "struct<data: map<string, string>>"
        good = good.withColumn("_raw", F.from_json(F.col(payload_col), raw_schema).getField("data"))
    rows = good.select(*carry, *(["_raw"] if keep_raw else []),
                       F.posexplode(F.col("_p.data")).alias("entry_pos", "quote_key", "_e"))
    counts = ("volume", "oi")
    fields = [(lenient_long(f"_e.{f.name}") if f.name in counts else F.col(f"_e.{f.name}")).alias(f.name)
              for f in QUOTE_ENTRY.fields]
    raw = F.element_at(F.col("_raw"), F.col("quote_key"))
    if raw_as_variant:
        raw = F.try_parse_json(raw)
    extra = [raw.alias("raw")] if keep_raw else []
    rows = rows.select(*carry, F.col("entry_pos").cast("long").alias("entry_pos"), "quote_key",
                       *fields, *extra)
    return rows, rejects


def parse_candles(payloads: DataFrame, payload_col: str = "payload",
                  tz: str = MARKET_TZ) -> tuple[DataFrame, DataFrame]:
    """Candle payloads -> typed candle rows (O05, with O29 applied).

    Each candle is ``[datetime, open, high, low, close, volume, oi]``; slots are
    read as strings and cast one by one, a missing slot (6-slot candles) gives
    NULL.  ``datetime`` is rendered in market time and ``trade_date`` added.
    An empty ``candles`` array gives no rows and no reject; a candle whose time
    cannot be read is a reject row (``bad_candle_time``).
    """
    carry = [c for c in payloads.columns if c != payload_col]
    p = payloads.withColumn("_p", F.from_json(F.col(payload_col), CANDLE_PAYLOAD))
    p = p.withColumn("_reason", _envelope_reason("_p", F.col("_p.data.candles")))
    rejects = p.where(F.col("_reason").isNotNull()).select(*carry, F.col("_reason").alias("reason"))
    c = p.where(F.col("_reason").isNull()).select(*carry, F.explode(F.col("_p.data.candles")).alias("_c"))

    def slot(i):
        return F.get(F.col("_c"), i)

    typed = c.select(*carry, slot(0).alias("datetime"),
                     slot(1).try_cast("double").alias("open"),
                     slot(2).try_cast("double").alias("high"),
                     slot(3).try_cast("double").alias("low"),
                     slot(4).try_cast("double").alias("close"),
                     lenient_long(slot(5)).alias("volume"), lenient_long(slot(6)).alias("oi"))
    timed = normalise_candle_time(typed, "datetime", tz)
    bad_time = timed.where(F.col("trade_date").isNull()).select(*carry, F.lit("bad_candle_time").alias("reason"))
    return timed.where(F.col("trade_date").isNotNull()), rejects.unionByName(bad_time)

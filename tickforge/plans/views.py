"""Market-data views derived from the driver's TPC-H-like tables.

``part`` -> instrument masters (M, MB), ``events`` -> ticks (T), ``orders`` ->
request items (R), history requests (H) and date ranges (DC).  Quote and candle
payloads (Q, C) are built from T so the parsers read text a vendor would send.
Every view grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators.bars import bars

# Fixed test parameters of the derived views.
TODAY = "2024-01-30"
AS_OF = "2024-01-20"
MARKET_OFFSET = "+05:30"


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table ``name``; the relation (not its data) is reused per
    session, so a job that reads a table twice lists and resolves it once."""
    key = (id(spark), sf_dir, name)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        _TABLES[key] = df
    return df


_VIEWS: dict = {}


def view(fn):
    """Memoize a view's DataFrame (its plan, not its data) per session and folder."""
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (fn.__name__, id(spark), sf_dir)
        df = _VIEWS.get(key)
        if df is None or df.sparkSession is not spark:
            df = fn(spark, sf_dir)
            _VIEWS[key] = df
        return df
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    return wrapped


def _venue(pk):
    return F.when(pk % 2 == 0, F.lit("NSE")).otherwise(F.lit("BSE"))


def _symbol(pk, name):
    return (F.when(pk % 7 == 0, F.lit(""))
            .when(pk % 11 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.upper(F.replace(name, F.lit(" "), F.lit(""))), pk.cast("string"))))


@view
def master_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: feed-A master, one instrument per part."""
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    venue = _venue(pk)
    return p.select(
        venue.alias("venue"),
        pk.cast("long").alias("exchange_token"),
        F.concat(venue, F.lit("_"), F.col("p_type")).alias("exchange"),
        F.concat(venue, F.lit("_"), F.col("p_type"), F.lit("|"), F.col("p_name"), F.lit(" "),
                 pk.cast("string")).alias("instrument_key"),
        _symbol(pk, F.col("p_name")).alias("tradingsymbol"),
        pk.cast("long").alias("src_pos"),
    )


@view
def master_b_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MB: feed-B master (full column list), one instrument per part."""
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    venue = _venue(pk)
    return p.select(
        (pk * 10 + 7).cast("long").alias("instrument_token"),
        pk.cast("long").alias("exchange_token"),
        _symbol(pk, F.col("p_name")).alias("tradingsymbol"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("last_price"),
        F.when(F.col("p_size") % 2 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit("2024-02-01").cast("date"), F.col("p_size"))).alias("expiry"),
        F.col("p_size").cast("double").alias("strike"),
        F.lit(0.05).alias("tick_size"),
        F.col("p_size").cast("long").alias("lot_size"),
        F.col("p_type").alias("instrument_type"),
        F.concat(venue, F.lit("-"), F.col("p_type")).alias("segment"),
        venue.alias("exchange"),
        pk.cast("long").alias("src_pos"),
    )


#: Tokens above the 32-bit range: a shifted copy of the smaller ones.
BIG = 3_000_000_000


@view
def listed_master_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MX: M plus one further listing per part -- the same token on the other exchange
    (which quotes may name), a later row for the same key, or a token above 2**31."""
    m = master_view(spark, sf_dir)
    tok, third = F.col("exchange_token"), F.col("exchange_token") % 3
    venue = F.when(third == 0, F.when(F.col("venue") == "NSE", "BSE").otherwise("NSE")).otherwise(F.col("venue"))
    segment = F.concat(venue, F.lit("_"), F.split_part("exchange", F.lit("_"), F.lit(2)))
    copy = m.select(
        venue.alias("venue"),
        F.when(third == 2, tok + BIG).otherwise(tok).alias("exchange_token"),
        segment.alias("exchange"),
        F.concat(segment, F.lit("|"), F.split_part("instrument_key", F.lit("|"), F.lit(2)), F.lit(" copy"))
         .alias("instrument_key"),
        F.concat("tradingsymbol", F.lit("C")).alias("tradingsymbol"),
        (F.col("src_pos") + BIG).alias("src_pos"))
    return m.unionByName(copy)


@view
def listed_master_b_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MBX: MB plus a later row or a big token per part, as in MX."""
    m = master_b_view(spark, sf_dir)
    tok, third = F.col("exchange_token"), F.col("exchange_token") % 3
    copy = m.withColumns({
        "exchange_token": F.when(third == 2, tok + BIG).otherwise(tok),
        "tradingsymbol": F.concat("tradingsymbol", F.lit("C")),
        "src_pos": F.col("src_pos") + BIG})
    return m.unionByName(copy)


@view
def ticks_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: ticks; ``ts`` stays as read (TIMESTAMP_NTZ, taken as UTC)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("exchange_token"),
        "ts",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("qty"),
        (F.col("event_id") % 1000).alias("oi"),
    )


@view
def exchange_ticks_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX: T of two exchanges that use the same tokens."""
    return ticks_view(spark, sf_dir).withColumn(
        "exchange", F.when(F.col("event_id") % 2 == 0, "NSE").otherwise("BSE"))


@view
def requests_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: request items; most resolve, others have empty, NULL, unknown, mismatched or
    very large tokens."""
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    ok = F.col("o_orderkey")
    n_tok = table(spark, sf_dir, "part").select(
        (F.count(F.lit(1)) * 11 / 10).cast("long")).scalar()
    o = o.select("o_orderkey", ((F.col("o_custkey") * 3) % n_tok).cast("long").alias("_tok"))
    o = o.join(p, F.col("_tok") == F.col("p_partkey"), "left")
    token = (F.when(ok % 97 == 0, F.lit(""))
             .when(ok % 101 == 0, F.lit(None).cast("string"))
             .otherwise((F.col("_tok") + F.when(ok % 10 == 7, BIG).otherwise(0)).cast("string")))
    exch = (F.when(ok % 9 == 0, F.lit(None).cast("string"))
            .when(ok % 4 == 0, F.lit("NSE")).when(ok % 4 == 1, F.lit("BSE"))
            .otherwise(_venue(F.col("_tok"))))
    other = (F.when(ok % 6 == 0, "ECONOMY").when(ok % 6 == 1, "MEDIUM").when(ok % 6 == 2, "STANDARD")
             .when(ok % 6 == 3, "PROMO").when(ok % 6 == 4, "SMALL").otherwise("LARGE"))
    itype = F.when(ok % 8 == 0, other).otherwise(F.coalesce("p_type", other))
    ivl = (F.when(ok % 5 == 0, "1d").when(ok % 5 == 1, "I1").when(ok % 5 == 2, "I30")
           .when(ok % 5 == 3, "5m").otherwise("1d"))
    return o.select((ok % 500).alias("request_id"), ok.alias("pos"), token.alias("exchange_token"),
                    exch.alias("exchange"), itype.alias("instrument_type"), ivl.alias("interval_name"))


def quote_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per token: its key in M and, where MX lists it on the other exchange, that key."""
    m, x = master_view(spark, sf_dir), listed_master_view(spark, sf_dir)
    home = m.select(F.col("exchange_token").alias("_mt"), F.col("exchange").alias("_home"), "instrument_key")
    away = x.select(F.col("exchange_token").alias("_xt"), F.col("exchange").alias("_away"),
                    F.col("instrument_key").alias("_away_key"))
    return (home.join(away, (F.col("_mt") == F.col("_xt")) & (F.col("_home") != F.col("_away")), "left")
            .select("_mt", "instrument_key", "_away_key"))


def quote_token():
    """Instrument token of a quote: some are NULL or unknown, some name the other exchange."""
    eid = F.col("event_id")
    return (F.when(eid % 50 == 0, F.lit(None).cast("string"))
            .when(eid % 77 == 0, F.concat(F.lit("NONE|"), F.col("exchange_token").cast("string")))
            .when(eid % 4 == 3, F.coalesce("_away_key", "instrument_key"))
            .otherwise(F.col("instrument_key")))


@view
def quotes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q: quote entries of T, 1,000 per batch."""
    t = ticks_view(spark, sf_dir)
    m = quote_keys(spark, sf_dir)
    eid = F.col("event_id")
    return (t.join(m, t["exchange_token"] == m["_mt"])
            .select(F.floor(eid / 1000).cast("long").alias("batch_no"), eid.alias("pos"),
                    quote_token().alias("instrument_token"), F.col("price").alias("ltp"),
                    F.col("qty").alias("volume"), F.col("oi")))


@view
def quote_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One LTP-style payload per batch: ``{status, data: {"<pos>": entry}}``.

    A batch holds at most 1,000 entries, so each collect is bounded.
    """
    q = quotes_view(spark, sf_dir)
    entry = F.struct(F.col("instrument_token"), F.col("ltp").alias("last_price"),
                     F.col("volume"), F.col("oi"))
    items = F.sort_array(F.collect_list(F.struct(F.col("pos"), entry.alias("v"))))
    data = F.map_from_entries(F.transform(items, lambda x: F.struct(x["pos"].cast("string"), x["v"])))
    return q.groupBy("batch_no").agg(
        F.to_json(F.struct(F.lit("success").alias("status"), data.alias("data"))).alias("payload"))


@view
def candles_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C: day bars of T in market time."""
    b = bars(ticks_view(spark, sf_dir), "day")
    return b.select("exchange_token", "datetime", "open", "high", "low", "close", "volume", "oi",
                    "trade_date")


def candle_payloads(spark: SparkSession, sf_dir: str, days_per_payload: int = 7) -> DataFrame:
    """Candle payloads of C, one per (instrument, run of ``days_per_payload`` days).

    Each candle is ``["yyyy-MM-ddTHH:mm:ss+05:30", open, high, low, close,
    volume, oi]`` with JSON numbers; a payload covers a bounded date run, as a
    vendor's date chunk does.
    """
    c = candles_view(spark, sf_dir)
    iso = F.concat(F.date_format(F.to_timestamp("datetime"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(MARKET_OFFSET))
    cell = F.concat(F.lit('["'), iso, F.lit('",'),
                    F.concat_ws(",", *[F.col(x).cast("string") for x in
                                       ("open", "high", "low", "close", "volume", "oi")]),
                    F.lit("]"))
    run = F.floor(F.datediff("trade_date", F.lit("2000-01-01").cast("date")) / days_per_payload)
    grouped = (c.groupBy("exchange_token", run.alias("run"))
               .agg(F.sort_array(F.collect_list(F.struct("datetime", cell.alias("cell")))).alias("_cs")))
    body = F.array_join(F.transform(F.col("_cs"), lambda x: x["cell"]), ",")
    return grouped.select("exchange_token", "run",
                          F.concat(F.lit('{"status":"success","data":{"candles":['), body,
                                   F.lit("]}}")).alias("payload"))


def n_tokens(spark: SparkSession, sf_dir: str):
    """Scalar subquery: number of distinct instruments with ticks."""
    return table(spark, sf_dir, "events").select(F.count_distinct("user_id")).scalar()


@view
def history_requests_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H: every order asks for a few days (0 to 11, some reversed) of one
    instrument's candles."""
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (ok % 30).cast("int"))
    end = F.date_add(start, ((ok * 37) % 12 - 1).cast("int"))
    return o.select(ok.alias("request_id"),
                    (F.col("o_custkey") % n_tokens(spark, sf_dir)).alias("exchange_token"),
                    start.alias("from_date"), end.alias("to_date"))


@view
def date_ranges_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC: one date range per order, up to ~7 years long, some reversed."""
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    start = F.to_date(F.col("o_orderdate"))
    return o.select(ok.alias("request_id"), start.alias("from_date"),
                    F.date_add(start, ((ok * 37) % 2600 - 1).cast("int")).alias("to_date"))


@view
def batch_keys_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RB: resolved keys of five large requests (one per event type)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("request_id"), F.col("event_id").alias("pos"),
                    F.concat(F.lit("NSE_EQ|"), F.col("user_id").cast("string")).alias("instrument_key"))


@view
def exchange_candles_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CX: day and 30-minute candles of TX, two exchanges that use the same tokens."""
    t = exchange_ticks_view(spark, sf_dir)
    out = None
    for name in ("day", "30minute"):
        b = bars(t, name).withColumn("interval_name", F.lit(name))
        b = b.select("exchange", "exchange_token", "interval_name", "datetime", "open", "high", "low", "close", "volume",
                     "oi", "trade_date")
        out = b if out is None else out.unionByName(b)
    return out


@view
def exchange_history_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HX: H's items over CX, four to a request; some ask for all time or for ten weeks."""
    h = history_requests_view(spark, sf_dir)
    ok = F.col("request_id")
    return h.select(
        F.floor(ok / 4).cast("long").alias("request_id"), ok.alias("pos"),
        F.when(ok % 2 == 0, "NSE").otherwise("BSE").alias("exchange"), "exchange_token",
        F.when(ok % 3 == 0, "30minute").otherwise("day").alias("interval_name"),
        F.when(ok % 16 == 0, F.lit("0001-01-01")).when(ok % 16 == 1, F.lit("2023-12-15"))
         .otherwise(F.date_format("from_date", "yyyy-MM-dd")).cast("date").alias("from_date"),
        F.when(ok % 16 == 0, F.lit("9999-12-31")).when(ok % 16 == 1, F.lit("2024-02-20"))
         .otherwise(F.date_format("to_date", "yyyy-MM-dd")).cast("date").alias("to_date"))


@view
def history_service_requests_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HR: H's items as the history endpoint receives them, four to a request -- strings, with the
    exchange and type from the master (or the token's other exchange), several names of one
    interval, instruments without candles, missing parameters, wrong types, unknown intervals."""
    h = history_requests_view(spark, sf_dir)
    m = master_view(spark, sf_dir).select(F.col("exchange_token").alias("_mt"), "venue",
                                          F.col("exchange").alias("_mx"))
    ok = F.col("request_id")
    h = h.withColumn("exchange_token", F.col("exchange_token") + F.when(ok % 11 == 3, n_tokens(spark, sf_dir)).otherwise(0))
    j = h.join(m, h["exchange_token"] == m["_mt"], "left")
    other = (F.col("exchange_token") % 3 == 0) & (ok % 2 == 0)
    return j.select(
        F.floor(ok / 4).cast("long").alias("request_id"), ok.alias("pos"),
        F.when(ok % 170 == 0, F.lit("")).otherwise(F.col("exchange_token").cast("string")).alias("exchange_token"),
        F.when(other, F.when(F.col("venue") == "NSE", "BSE").when(F.col("venue") == "BSE", "NSE"))
         .otherwise(F.col("venue")).alias("exchange"),
        F.when(ok % 13 == 0, F.lit("PROMO")).otherwise(F.split_part("_mx", F.lit("_"), F.lit(2)))
         .alias("instrument_type"),
        F.when(ok % 190 == 0, F.lit(None).cast("string")).when(ok % 23 == 0, "2hour").when(ok % 29 == 0, "5minute")
         .when(ok % 4 == 0, "day").when(ok % 4 == 1, "1day").when(ok % 4 == 2, "1d").otherwise("30minute").alias("interval_name"),
        F.date_format("from_date", "yyyy-MM-dd").alias("from_date"),
        F.date_format("to_date", "yyyy-MM-dd").alias("to_date"),
    )

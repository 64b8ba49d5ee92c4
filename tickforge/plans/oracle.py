"""DuckDB SQL for every registered job: the same derived views written as CTEs,
then the operator written plainly in SQL.  Column names match the Spark jobs."""

from __future__ import annotations

LOCAL = "INTERVAL 330 MINUTE"  # market zone offset, +05:30 (fixed value)
FMT = "'%Y-%m-%d %H:%M:%S'"

_VENUE = "CASE WHEN p_partkey % 2 = 0 THEN 'NSE' ELSE 'BSE' END"
_SYMBOL = ("CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN NULL "
           "ELSE upper(replace(p_name, ' ', '')) || CAST(p_partkey AS VARCHAR) END")


def _bars_cte(name: str, bucket: str, src: str = "T", keys: str = "exchange_token") -> str:
    b = bucket.format(ts=f"(ts + {LOCAL})")
    return f"""{name} AS (
  SELECT {keys}, {b} AS bucket,
         strftime({b}, {FMT}) AS datetime,
         CAST({b} AS DATE) AS trade_date,
         first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low,
         first(price ORDER BY ts DESC, event_id DESC) AS close,
         CAST(sum(qty) AS BIGINT) AS volume,
         first(oi ORDER BY ts DESC, event_id DESC) AS oi,
         max(ts) AS last_ts
  FROM {src} GROUP BY {keys}, {b})"""


BUCKETS = {
    "1 minute": "date_trunc('minute', {ts})",
    "5 minutes": "time_bucket(INTERVAL '5 minutes', {ts})",
    "30 minutes": "time_bucket(INTERVAL '30 minutes', {ts})",
    "1 day": "date_trunc('day', {ts})",
}

_RV = """RV AS (SELECT request_id, pos, coalesce(exchange_token, '') AS exchange_token,
                 coalesce(exchange, 'NSE') AS exchange, coalesce(instrument_type, '') AS instrument_type,
                 interval_name, try_cast(coalesce(exchange_token, '') AS BIGINT) AS token_int FROM R)"""

CTES = {
    "M": f"""M AS (SELECT {_VENUE} AS venue, CAST(p_partkey AS BIGINT) AS exchange_token,
  {_VENUE} || '_' || p_type AS exchange,
  {_VENUE} || '_' || p_type || '|' || p_name || ' ' || CAST(p_partkey AS VARCHAR) AS instrument_key,
  {_SYMBOL} AS tradingsymbol, CAST(p_partkey AS BIGINT) AS src_pos FROM part)""",
    "MD": """MD AS (SELECT * FROM (SELECT MX.*, row_number() OVER (PARTITION BY exchange_token, exchange
  ORDER BY src_pos) AS rn FROM MX) WHERE rn = 1)""",
    "MX": """MX AS (SELECT * FROM M UNION ALL
  SELECT v AS venue, exchange_token + CASE WHEN exchange_token % 3 = 2 THEN 3000000000 ELSE 0 END,
    v || '_' || split_part(exchange, '_', 2),
    v || '_' || split_part(exchange, '_', 2) || '|' || split_part(instrument_key, '|', 2) || ' copy',
    tradingsymbol || 'C', src_pos + 3000000000
  FROM (SELECT *, CASE WHEN exchange_token % 3 <> 0 THEN venue WHEN venue = 'NSE' THEN 'BSE' ELSE 'NSE' END AS v
        FROM M))""",
    "MB": f"""MB AS (SELECT CAST(p_partkey * 10 + 7 AS BIGINT) AS instrument_token,
  CAST(p_partkey AS BIGINT) AS exchange_token, {_SYMBOL} AS tradingsymbol, p_name AS name,
  p_retailprice AS last_price,
  CASE WHEN p_size % 2 = 0 THEN NULL ELSE DATE '2024-02-01' + CAST(p_size AS INTEGER) END AS expiry,
  CAST(p_size AS DOUBLE) AS strike, CAST(0.05 AS DOUBLE) AS tick_size, CAST(p_size AS BIGINT) AS lot_size,
  p_type AS instrument_type, {_VENUE} || '-' || p_type AS segment, {_VENUE} AS exchange,
  CAST(p_partkey AS BIGINT) AS src_pos FROM part)""",
    "MBD": """MBD AS (SELECT * FROM (SELECT MBX.*, row_number() OVER (PARTITION BY exchange_token, exchange
  ORDER BY src_pos) AS rn FROM MBX) WHERE rn = 1)""",
    "MBX": """MBX AS (SELECT * FROM MB UNION ALL
  SELECT * REPLACE (exchange_token + CASE WHEN exchange_token % 3 = 2 THEN 3000000000 ELSE 0 END AS exchange_token,
    tradingsymbol || 'C' AS tradingsymbol, src_pos + 3000000000 AS src_pos) FROM MB)""",
    "T": """T AS (SELECT event_id, user_id AS exchange_token, ts, value AS price,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty, event_id % 1000 AS oi FROM events)""",
    "TX": """TX AS (SELECT T.*, CASE WHEN event_id % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange FROM T)""",
    "R": """R AS (SELECT o_orderkey % 500 AS request_id, o_orderkey AS pos,
  CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 101 = 0 THEN NULL
       ELSE CAST(tok + CASE WHEN o_orderkey % 10 = 7 THEN 3000000000 ELSE 0 END AS VARCHAR) END AS exchange_token,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'NSE' WHEN o_orderkey % 4 = 1 THEN 'BSE'
       WHEN tok % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange,
  CASE WHEN o_orderkey % 8 = 0 THEN other ELSE coalesce(p_type, other) END AS instrument_type,
  CASE o_orderkey % 5 WHEN 0 THEN '1d' WHEN 1 THEN 'I1' WHEN 2 THEN 'I30' WHEN 3 THEN '5m' ELSE '1d' END
    AS interval_name
  FROM (SELECT o_orderkey, CAST((o_custkey * 3) % (SELECT CAST(count(*) * 11 / 10 AS BIGINT) FROM part) AS BIGINT) AS tok,
               CASE o_orderkey % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'STANDARD'
                 WHEN 3 THEN 'PROMO' WHEN 4 THEN 'SMALL' ELSE 'LARGE' END AS other FROM orders) o
  LEFT JOIN part ON p_partkey = tok)""",
    "RV": _RV,
    "Q": """Q AS (SELECT CAST(floor(T.event_id / 1000) AS BIGINT) AS batch_no, T.event_id AS pos,
  CASE WHEN T.event_id % 50 = 0 THEN NULL
       WHEN T.event_id % 77 = 0 THEN 'NONE|' || CAST(T.exchange_token AS VARCHAR)
       WHEN T.event_id % 4 = 3 THEN coalesce(X.instrument_key, M.instrument_key)
       ELSE M.instrument_key END AS instrument_token,
  T.price AS ltp, T.qty AS volume, T.oi AS oi
  FROM T JOIN M ON M.exchange_token = T.exchange_token
  LEFT JOIN MX X ON X.exchange_token = M.exchange_token AND X.exchange <> M.exchange)""",
    "E": """E AS (SELECT Q.batch_no, Q.pos, CAST(Q.pos AS VARCHAR) AS quote_key, Q.instrument_token,
  MX.venue AS exchange, MX.exchange_token, MX.tradingsymbol AS trading_symbol,
  split_part(MX.exchange, '_', 2) AS instrument_type,
  Q.ltp AS last_price, Q.volume, Q.oi FROM Q JOIN MX ON MX.instrument_key = Q.instrument_token)""",
    "QX": """QX AS (SELECT * FROM (SELECT E.*, row_number() OVER (PARTITION BY exchange, exchange_token
  ORDER BY batch_no DESC, pos DESC) AS rn FROM E) WHERE rn = 1)""",
    "QM": """QM AS (SELECT * FROM (SELECT E.*, row_number() OVER (PARTITION BY exchange_token
  ORDER BY batch_no DESC, pos DESC) AS rn FROM E) WHERE rn = 1)""",
    "B1": _bars_cte("B1", BUCKETS["1 minute"]),
    "B5": _bars_cte("B5", BUCKETS["5 minutes"]),
    "B30": _bars_cte("B30", BUCKETS["30 minutes"]),
    "C": _bars_cte("C", BUCKETS["1 day"]),
    "X1": _bars_cte("X1", BUCKETS["1 minute"], "TX", "exchange, exchange_token"),
    "X30": _bars_cte("X30", BUCKETS["30 minutes"], "TX", "exchange, exchange_token"),
    "XD": _bars_cte("XD", BUCKETS["1 day"], "TX", "exchange, exchange_token"),
    "LX": f"""LX AS (SELECT exchange, exchange_token, first(price ORDER BY ts DESC, event_id DESC) AS last_price,
  strftime(max(ts) + {LOCAL}, {FMT}) AS last_time FROM TX GROUP BY exchange, exchange_token)""",
    "FQ": """FQ AS (SELECT * FROM (SELECT C.*, row_number() OVER (PARTITION BY exchange_token
  ORDER BY bucket DESC) AS rn FROM C) WHERE rn = 1)""",
    "H": """H AS (SELECT o_orderkey AS request_id,
  o_custkey % (SELECT count(DISTINCT user_id) FROM events) AS exchange_token,
  DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS from_date,
  DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) + CAST((o_orderkey * 37) % 12 - 1 AS INTEGER) AS to_date
  FROM orders)""",
    "DC": """DC AS (SELECT o_orderkey AS request_id, CAST(o_orderdate AS DATE) AS from_date,
  CAST(o_orderdate AS DATE) + CAST((o_orderkey * 37) % 2600 - 1 AS INTEGER) AS to_date FROM orders)""",
    "L": f"""L AS (SELECT exchange_token, first(price ORDER BY ts DESC, event_id DESC) AS last_price,
  strftime(max(ts) + {LOCAL}, {FMT}) AS last_time FROM T GROUP BY exchange_token)""",
    "CX": """CX AS (SELECT exchange, exchange_token, 'day' AS interval_name, datetime, open, high, low, close, volume, oi,
  trade_date FROM XD UNION ALL SELECT exchange, exchange_token, '30minute', datetime, open, high, low, close, volume, oi,
  trade_date FROM X30)""",
    "FX": """FX AS (SELECT * FROM (SELECT XD.*, row_number() OVER (PARTITION BY exchange, exchange_token
  ORDER BY bucket DESC) AS rn FROM XD) WHERE rn = 1)""",
    "HX": """HX AS (SELECT CAST(request_id // 4 AS BIGINT) AS request_id, request_id AS pos,
  CASE WHEN request_id % 2 = 0 THEN 'NSE' ELSE 'BSE' END AS exchange, exchange_token,
  CASE WHEN request_id % 3 = 0 THEN '30minute' ELSE 'day' END AS interval_name,
  CASE WHEN request_id % 16 = 0 THEN DATE '0001-01-01' WHEN request_id % 16 = 1 THEN DATE '2023-12-15'
       ELSE from_date END AS from_date,
  CASE WHEN request_id % 16 = 0 THEN DATE '9999-12-31' WHEN request_id % 16 = 1 THEN DATE '2024-02-20'
       ELSE to_date END AS to_date FROM H)""",
    "HR": """HR AS (SELECT CAST(ok // 4 AS BIGINT) AS request_id, ok AS pos,
  CASE WHEN ok % 170 = 0 THEN '' ELSE CAST(tok AS VARCHAR) END AS exchange_token,
  CASE WHEN tok % 3 = 0 AND ok % 2 = 0 THEN CASE M.venue WHEN 'NSE' THEN 'BSE' WHEN 'BSE' THEN 'NSE' END
       ELSE M.venue END AS exchange,
  CASE WHEN ok % 13 = 0 THEN 'PROMO' ELSE split_part(M.exchange, '_', 2) END AS instrument_type,
  CASE WHEN ok % 190 = 0 THEN NULL WHEN ok % 23 = 0 THEN '2hour' WHEN ok % 29 = 0 THEN '5minute' WHEN ok % 4 = 0 THEN 'day'
       WHEN ok % 4 = 1 THEN '1day' WHEN ok % 4 = 2 THEN '1d' ELSE '30minute' END AS interval_name,
  strftime(from_date, '%Y-%m-%d') AS from_date, strftime(to_date, '%Y-%m-%d') AS to_date
  FROM (SELECT H.request_id AS ok, from_date, to_date, H.exchange_token + CASE WHEN H.request_id % 11 = 3
          THEN (SELECT count(DISTINCT user_id) FROM events) ELSE 0 END AS tok FROM H) H2
  LEFT JOIN M ON M.exchange_token = tok)""",
    "U": """U AS (SELECT 'feed_a' AS broker, instrument_key, exchange_token,
  split_part(exchange, '_', 1) AS exchange, exchange AS segment, split_part(exchange, '_', 2) AS instrument_type,
  tradingsymbol, CAST(NULL AS VARCHAR) AS name, src_pos, CAST(NULL AS DOUBLE) AS last_price,
  CAST(NULL AS DATE) AS expiry, CAST(NULL AS DOUBLE) AS strike, CAST(NULL AS DOUBLE) AS tick_size,
  CAST(NULL AS BIGINT) AS lot_size FROM M
UNION ALL
SELECT 'feed_b' AS broker, CAST(instrument_token AS VARCHAR), exchange_token, exchange, segment, instrument_type,
  tradingsymbol, name, src_pos, last_price, expiry, strike, tick_size, lot_size FROM MB)""",
    "MP": """MP AS (SELECT DISTINCT instrument_key AS k, upper(trim(split_part(instrument_key, '|', 2))) AS sym
  FROM M WHERE split_part(exchange, '_', 2) IN ('PROMO', 'SMALL'))""",
    "RB": """RB AS (SELECT event_type AS request_id, event_id AS pos,
  'NSE_EQ|' || CAST(user_id AS VARCHAR) AS instrument_key FROM events)""",
}

# CTE dependencies, so a query names only what it reads.
DEPS = {"CX": ["XD", "X30"], "FX": ["XD"], "HX": ["H"], "U": ["M", "MB"], "MP": ["M"], "L": ["T"], "HR": ["H", "M"], "MX": ["M"], "MBX": ["MB"], "MD": ["MX"], "MBD": ["MBX"], "RV": ["R"], "Q": ["T", "M", "MX"],
        "E": ["Q", "MX"], "QM": ["E"], "QX": ["E"], "TX": ["T"], "X1": ["TX"], "X30": ["TX"], "XD": ["TX"], "LX": ["TX"],
        "B1": ["T"], "B5": ["T"], "B30": ["T"], "C": ["T"], "FQ": ["C"]}


def with_views(body: str, *names: str, extra: tuple[str, ...] = ()) -> str:
    """``WITH`` the named views (and their dependencies), then ``extra`` CTEs, then ``body``."""
    order: list[str] = []

    def add(n):
        for dep in DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join([*(CTES[n] for n in order), *extra]) + "\n" + body


CANDLE_SEL = "exchange_token, datetime, open, high, low, close, volume, oi"


def _latest(b: str) -> str:
    return with_views(f"""SELECT exchange_token, datetime, open, high, low, close, volume, close AS last_price
FROM (SELECT {b}.*, row_number() OVER (PARTITION BY exchange_token ORDER BY bucket DESC) AS rn FROM {b})
WHERE rn = 1""", b)


def _key_batches(size: int) -> str:
    return with_views(f"""SELECT request_id, batch_no, count(*) AS n_keys,
  string_agg(instrument_key, ',' ORDER BY pos, instrument_key) AS keys
FROM (SELECT RB.*, CAST((row_number() OVER (PARTITION BY request_id ORDER BY pos, instrument_key) - 1)
      // {size} AS BIGINT) AS batch_no FROM RB)
GROUP BY request_id, batch_no""", "RB")


def _date_chunks(legacy: bool) -> str:
    extra = "WHERE from_date + CAST(k * 1000 AS INTEGER) < to_date" if legacy else ""
    return with_views(f"""SELECT request_id, k AS chunk_no,
  strftime(from_date + CAST(k * 1000 AS INTEGER), '%Y-%m-%d') AS chunk_from,
  strftime(least(from_date + CAST(k * 1000 + 999 AS INTEGER), to_date), '%Y-%m-%d') AS chunk_to
FROM (SELECT DC.*, unnest(generate_series(0, CAST((to_date - from_date) // 1000 AS BIGINT))) AS k
      FROM DC WHERE from_date <= to_date) {extra}""", "DC")


_FULL_QUOTE = f"""SELECT exchange_token, strftime(trade_date, '%Y-%m-%d') AS trade_date, open, high, low, close,
  close AS last_price, volume, oi, strftime(last_ts + {LOCAL}, {FMT}) AS timestamp FROM FQ"""

_MATRIX = " UNION ALL ".join(
    "SELECT '{f}' AS field, ".format(f=f) + ", ".join(
        f"max(CASE WHEN exchange_token = {t} THEN CAST({f} AS DOUBLE) END) AS tok_{t}" for t in (1, 2, 3, 4, 5))
    + " FROM QM" for f in ("last_price", "volume", "oi"))

_MATCH = "MD.exchange_token = RV.token_int AND MD.exchange = RV.exchange || '_' || RV.instrument_type"

ORACLE = {
    "master_a_csv": with_views("""SELECT instrument_key, exchange_token, exchange,
  nullif(tradingsymbol, '') AS tradingsymbol, venue FROM M""", "M"),
    "master_b_csv": with_views("""SELECT instrument_token, exchange_token, nullif(tradingsymbol, '') AS tradingsymbol,
  name, last_price, strftime(expiry, '%Y-%m-%d') AS expiry, strike, tick_size, lot_size, instrument_type,
  segment, exchange FROM MB""", "MB"),
    "master_json": with_views("""SELECT instrument_key, tradingsymbol AS trading_symbol, exchange_token, exchange, venue
  FROM M""", "M"),
    "requests_json": with_views("""SELECT request_id, pos, coalesce(exchange_token, '') AS exchange_token,
  coalesce(exchange, 'NSE') AS exchange, coalesce(instrument_type, '') AS instrument_type, interval_name
  FROM R""", "R"),
    "quotes_parsed": with_views("""SELECT batch_no, CAST(pos AS VARCHAR) AS quote_key, instrument_token, ltp,
  volume, oi FROM Q""", "Q"),
    "candles_parsed": with_views(f"SELECT {CANDLE_SEL}, strftime(trade_date, '%Y-%m-%d') AS trade_date FROM C",
                                 "C"),
    "candle_time": with_views(f"""SELECT event_id, strftime(ts + {LOCAL}, {FMT}) AS datetime,
  strftime(CAST(ts + {LOCAL} AS DATE), '%Y-%m-%d') AS trade_date FROM T""", "T"),
    "master_list": with_views("""SELECT instrument_key, exchange_token, exchange, tradingsymbol, venue, src_pos
  FROM M""", "M"),
    "candles_written": with_views("SELECT * REPLACE (strftime(trade_date, '%Y-%m-%d') AS trade_date) FROM CX", "CX"),
    "request_status": with_views(f"""SELECT RV.pos AS request_id,
  CASE WHEN MD.instrument_key IS NULL THEN 400 WHEN RV.exchange_token LIKE '%9' THEN 500
       WHEN LX.exchange_token IS NULL THEN 404 ELSE 200 END AS status_code,
  CASE WHEN MD.instrument_key IS NULL THEN 'invalid' WHEN RV.exchange_token LIKE '%9' THEN 'error'
       WHEN LX.exchange_token IS NULL THEN 'no data' ELSE 'success' END AS status,
  CAST(CASE WHEN LX.exchange_token IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_items,
  CAST(CASE WHEN MD.instrument_key IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_rejected
FROM RV LEFT JOIN MD ON {_MATCH}
LEFT JOIN LX ON MD.instrument_key IS NOT NULL AND LX.exchange_token = RV.token_int
  AND LX.exchange = RV.exchange""", "RV", "MD", "LX"),
    "unified_master": with_views("SELECT * FROM U", "U"),
    "index_backfill": with_views("""SELECT M.instrument_key,
  CASE WHEN M.tradingsymbol = '' THEN mp.sym ELSE M.tradingsymbol END AS trading_symbol
FROM M LEFT JOIN (SELECT DISTINCT instrument_key AS k, upper(trim(split_part(instrument_key, '|', 2))) AS sym
                  FROM M WHERE split_part(exchange, '_', 2) IN ('PROMO', 'SMALL')) mp
  ON mp.k = M.instrument_key""", "M"),
    "rejected_requests": with_views("""SELECT request_id, pos, reason FROM (
  SELECT request_id, pos,
    CASE WHEN interval_name IS NULL OR interval_name NOT IN ('1d', 'I1', 'I30') THEN 'bad_interval'
         WHEN exchange_token IS NULL OR exchange_token = '' THEN 'missing_token'
         WHEN try_cast(exchange_token AS BIGINT) IS NULL THEN 'bad_token' END AS reason
  FROM R) WHERE reason IS NOT NULL""", "R"),
    "trailing_window": with_views(f"""SELECT {CANDLE_SEL} FROM C
  WHERE trade_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-19'""", "C"),
    "trailing_window_stored": with_views(f"""SELECT {CANDLE_SEL} FROM C
  WHERE trade_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-19'""", "C"),
    "resolved": with_views(f"""SELECT RV.request_id, RV.pos, RV.token_int AS exchange_token, MD.instrument_key
  FROM RV JOIN MD ON {_MATCH}""", "RV", "MD"),
    "resolved_symbol": with_views("""SELECT RV.request_id, RV.pos, RV.token_int AS exchange_token,
  RV.exchange || ':' || MBD.tradingsymbol AS symbol_key
  FROM RV JOIN MBD ON MBD.exchange_token = RV.token_int AND MBD.exchange = RV.exchange
  WHERE MBD.tradingsymbol IS NOT NULL""", "RV", "MBD"),
    "unresolved_symbol": with_views("""SELECT * FROM (
  SELECT request_id, pos, RV.exchange_token,
    CASE WHEN RV.exchange_token = '' THEN 'missing_token' WHEN token_int IS NULL THEN 'bad_token'
         WHEN MBD.exchange_token IS NULL THEN 'not_in_master'
         WHEN MBD.tradingsymbol IS NULL THEN 'missing_symbol' END AS reason
  FROM RV LEFT JOIN MBD ON MBD.exchange_token = RV.token_int AND MBD.exchange = RV.exchange)
  WHERE reason IS NOT NULL""", "RV", "MBD"),
    "unresolved": with_views(f"""SELECT request_id, pos, exchange_token, reason FROM (
  SELECT request_id, pos, exchange_token,
    CASE WHEN exchange_token = '' THEN 'missing_token' WHEN token_int IS NULL THEN 'bad_token'
         WHEN NOT EXISTS (SELECT 1 FROM MD WHERE {_MATCH}) THEN 'not_in_master' END AS reason
  FROM RV) WHERE reason IS NOT NULL""", "RV", "MD"),
    "quotes_enriched": with_views("""SELECT batch_no, quote_key, instrument_token, exchange, exchange_token,
  trading_symbol, instrument_type, last_price, volume, oi FROM E""", "E"),
    "historical": with_views(f"""SELECT H.request_id, C.exchange_token, C.datetime, C.open, C.high, C.low,
  C.close, C.volume, C.oi FROM H JOIN C ON C.exchange_token = H.exchange_token
  AND C.trade_date BETWEEN H.from_date AND H.to_date""", "H", "C"),
    "today_backfill": with_views(f"""
SELECT * REPLACE (strftime(trade_date, '%Y-%m-%d') AS trade_date) FROM C2
UNION ALL
SELECT FX.exchange, FX.exchange_token, S.interval_name, strftime(last_ts + {LOCAL}, {FMT}) AS datetime, open, high, low,
  close, volume, oi, strftime(CAST(last_ts + {LOCAL} AS DATE), '%Y-%m-%d') AS trade_date
FROM FX JOIN (SELECT exchange, exchange_token, interval_name FROM C2 GROUP BY 1, 2, 3
              HAVING count(*) FILTER (trade_date = DATE '2024-01-30') = 0) S
  ON S.exchange = FX.exchange AND S.exchange_token = FX.exchange_token
WHERE volume >= 50""", "CX", "FX",
        extra=("C2 AS (SELECT * FROM CX WHERE NOT (trade_date = DATE '2024-01-30' AND close < open))",)),
    "quotes_merged": with_views("""SELECT exchange, exchange_token, batch_no, quote_key, instrument_token,
  trading_symbol, instrument_type, last_price, volume, oi FROM QX""", "QX"),
    "quotes_merged_legacy": with_views("""SELECT exchange, exchange_token, batch_no, quote_key, instrument_token,
  trading_symbol, instrument_type, last_price, volume, oi FROM QM""", "QM"),
    "quote_matrix": with_views(_MATRIX, "QM"),
    "ltp": with_views(f"""SELECT exchange_token, first(price ORDER BY ts DESC, event_id DESC) AS last_price,
  strftime(max(ts) + {LOCAL}, {FMT}) AS last_time FROM T GROUP BY exchange_token""", "T"),
    "ohlc_1d": _latest("C"),
    "ohlc_i1": _latest("B1"),
    "ohlc_i30": _latest("B30"),
    "full_quote": with_views(_FULL_QUOTE, "FQ"),
    "full_quote_stored": with_views(f"{_FULL_QUOTE} WHERE trade_date >= DATE '2024-01-20'", "FQ"),
    "full_quote_enriched": with_views(f"""SELECT f.exchange_token, M.tradingsymbol AS trading_symbol,
  split_part(M.exchange, '_', 2) AS instrument_type, f.trade_date, f.open, f.high, f.low, f.close,
  f.last_price, f.volume, f.oi, f.timestamp
FROM ({_FULL_QUOTE}) f LEFT JOIN M ON M.exchange_token = f.exchange_token""", "FQ", "M"),
    "bars_1minute": with_views(f"SELECT {CANDLE_SEL} FROM B1", "B1"),
    "bars_5minute": with_views(f"SELECT {CANDLE_SEL} FROM B5", "B5"),
    "bars_30minute": with_views(f"SELECT {CANDLE_SEL} FROM B30", "B30"),
    "bars_day": with_views(f"SELECT {CANDLE_SEL} FROM C", "C"),
    "chunk_coverage": with_views("""SELECT H.request_id, count(n) AS n_chunks,
  CAST(coalesce(sum(CASE WHEN n = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS empty_chunks,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS n_candles, CASE WHEN sum(n) > 0 THEN 1 ELSE 0 END AS retrieved
FROM H LEFT JOIN (SELECT CH.request_id, CH.chunk_no, coalesce(sum(D.n), 0) AS n
      FROM (SELECT H.request_id, H.exchange_token, k AS chunk_no,
                   H.from_date + CAST(k * 3 AS INTEGER) AS chunk_from,
                   least(H.from_date + CAST(k * 3 + 2 AS INTEGER), H.to_date) AS chunk_to
            FROM (SELECT H.*, unnest(generate_series(0, CAST((to_date - from_date) // 3 AS BIGINT))) AS k
                  FROM H WHERE from_date <= to_date) H) CH
      LEFT JOIN (SELECT exchange_token, trade_date, count(*) AS n FROM C GROUP BY 1, 2) D
        ON D.exchange_token = CH.exchange_token AND D.trade_date BETWEEN CH.chunk_from AND CH.chunk_to
      GROUP BY CH.request_id, CH.chunk_no) G ON G.request_id = H.request_id
GROUP BY H.request_id""", "H", "C"),
    "key_batches_750": _key_batches(750),
    "key_batches_450": _key_batches(450),
    "date_chunks": _date_chunks(False),
    "date_chunks_legacy": _date_chunks(True),
}

# Streaming jobs: the enrich stream equals the batch join; the append-mode bar
# stream holds exactly the bars whose window closed behind the final watermark
# (latest event time minus the 10-minute lateness).
ORACLE["key_batches_symbols"] = with_views("""SELECT request_id, batch_no, count(*) AS n_keys,
  string_agg(symbol_key, ',' ORDER BY pos, symbol_key) AS keys
FROM (SELECT S.*, CAST((row_number() OVER (PARTITION BY request_id ORDER BY pos, symbol_key) - 1) // 750
      AS BIGINT) AS batch_no
      FROM (SELECT RV.request_id, RV.pos, RV.exchange || ':' || MBD.tradingsymbol AS symbol_key
            FROM RV JOIN MBD ON MBD.exchange_token = RV.token_int AND MBD.exchange = RV.exchange
            WHERE MBD.tradingsymbol IS NOT NULL) S)
GROUP BY request_id, batch_no""", "RV", "MBD")
_HERE = "{0}.exchange_token = RV.token_int AND {0}.exchange = RV.exchange"
_RESOLVED = f"FROM RV JOIN MD ON {_MATCH}"


def _last_bar(b: str) -> str:
    return f"""(SELECT * FROM (SELECT {b}.*, row_number() OVER (PARTITION BY exchange, exchange_token
      ORDER BY bucket DESC) AS rn FROM {b}) WHERE rn = 1)"""


def _ohlc_rows(b: str, extra: str = "", where: str = "") -> str:
    return f"""SELECT RV.request_id, RV.pos, MD.instrument_key, b.datetime, b.open, b.high, b.low, b.close,
  b.volume, b.close AS last_price{extra} {_RESOLVED} JOIN {_last_bar(b)} b ON {_HERE.format("b")} {where}"""


ORACLE["ltp_for_requests"] = with_views(f"""SELECT RV.request_id, RV.pos, MD.instrument_key, LX.last_price,
  LX.last_time {_RESOLVED} JOIN LX ON {_HERE.format("LX")}""", "RV", "MD", "LX")
ORACLE["ltp_for_symbols"] = with_views(f"""SELECT RV.request_id, RV.pos,
  RV.exchange || ':' || MBD.tradingsymbol AS symbol_key, LX.last_price, LX.last_time
FROM RV JOIN MBD ON {_HERE.format("MBD")} JOIN LX ON {_HERE.format("LX")}
WHERE MBD.tradingsymbol IS NOT NULL""", "RV", "MBD", "LX")
ORACLE["ohlc_for_requests_i30"] = with_views(_ohlc_rows("X30"), "RV", "MD", "X30")
ORACLE["ohlc_for_requests"] = with_views(" UNION ALL ".join(
    _ohlc_rows(b, ", RV.interval_name", f"WHERE RV.interval_name = '{i}'")
    for b, i in (("XD", "1d"), ("X1", "I1"), ("X30", "I30"))), "RV", "MD", "XD", "X1", "X30")
ORACLE["ohlc_rejects"] = with_views(f"""SELECT request_id, pos, reason FROM (
  SELECT request_id, pos,
    CASE WHEN interval_name IS NULL OR interval_name NOT IN ('1d', 'I1', 'I30') THEN 'bad_interval'
         WHEN exchange_token = '' THEN 'missing_token' WHEN token_int IS NULL THEN 'bad_token'
         WHEN NOT EXISTS (SELECT 1 FROM MD WHERE {_MATCH}) THEN 'not_in_master' END AS reason
  FROM RV) WHERE reason IS NOT NULL""", "RV", "MD")
ORACLE["full_quote_for_requests"] = with_views(f"""SELECT RV.request_id, RV.pos, MD.instrument_key,
  strftime(b.trade_date, '%Y-%m-%d') AS trade_date, b.open, b.high, b.low, b.close, b.close AS last_price,
  b.volume, b.oi, strftime(b.last_ts + {LOCAL}, {FMT}) AS timestamp
{_RESOLVED} JOIN {_last_bar("XD")} b ON {_HERE.format("b")}""", "RV", "MD", "XD")
ORACLE["history_requests_json"] = with_views("""SELECT request_id, pos, coalesce(exchange_token, '') AS exchange_token,
  coalesce(exchange, 'NSE') AS exchange, coalesce(instrument_type, '') AS instrument_type, interval_name,
  from_date, to_date FROM HR""", "H", "M", "HR")
ORACLE["master_data"] = with_views("""SELECT U.* REPLACE (
  CASE WHEN tradingsymbol = '' THEN MP.sym ELSE tradingsymbol END AS tradingsymbol)
FROM U LEFT JOIN MP ON MP.k = U.instrument_key""", "U", "MP")
_HR_NULL = " OR ".join(f"coalesce({c}, '') = ''" for c in (
    "HR.exchange_token", "HR.interval_name", "HR.from_date", "HR.to_date", "HR.instrument_type"))
_HR_MATCH = ("MD.exchange_token = try_cast(HR.exchange_token AS BIGINT) "
             "AND MD.exchange = coalesce(HR.exchange, 'NSE') || '_' || HR.instrument_type")
_HR_SERIES = "CASE WHEN HR.interval_name IN ('day', '1day', '1d') THEN 'day' WHEN HR.interval_name = '30minute' THEN '30minute' END"
ORACLE["historical_for_requests"] = with_views(f"""SELECT request_id, pos, exchange, exchange_token, interval_name, datetime,
  open, high, low, close, volume, oi FROM HIST
UNION ALL
SELECT RES.request_id, RES.pos, RES.exchange, RES.token_int, RES.interval_name, strftime(FX.last_ts + {LOCAL}, {FMT}) AS datetime,
  FX.open, FX.high, FX.low, FX.close, FX.volume, FX.oi
FROM RES JOIN FX ON FX.exchange_token = RES.token_int AND FX.exchange = RES.exchange
WHERE CAST(RES.to_date AS DATE) = DATE '2024-01-30'
  AND EXISTS (SELECT 1 FROM HIST WHERE HIST.pos = RES.pos)
  AND NOT EXISTS (SELECT 1 FROM HIST WHERE HIST.pos = RES.pos
                  AND HIST.trade_date = DATE '2024-01-30')""", "HR", "M", "MD", "CX", "FX", extra=(
    f"""RES AS (SELECT HR.* REPLACE (coalesce(HR.exchange, 'NSE') AS exchange), try_cast(HR.exchange_token AS BIGINT) AS token_int,
          {_HR_SERIES} AS series FROM HR JOIN MD ON {_HR_MATCH} WHERE NOT ({_HR_NULL}) AND {_HR_SERIES} IS NOT NULL)""",
    """HIST AS (SELECT RES.request_id, RES.pos, RES.exchange, CX.exchange_token, RES.interval_name, CX.datetime, CX.open, CX.high,
         CX.low, CX.close, CX.volume, CX.oi, CX.trade_date FROM RES JOIN CX ON CX.exchange_token = RES.token_int
         AND CX.exchange = RES.exchange AND CX.interval_name = RES.series
         AND CX.trade_date BETWEEN CAST(RES.from_date AS DATE) AND CAST(RES.to_date AS DATE))"""))
ORACLE["historical_rejects"] = with_views(f"""SELECT request_id, pos, reason FROM (SELECT request_id, pos,
  CASE WHEN {_HR_NULL} THEN 'missing_parameters' WHEN {_HR_SERIES} IS NULL THEN 'bad_interval'
       WHEN NOT EXISTS (SELECT 1 FROM MD WHERE {_HR_MATCH}) THEN 'not_in_master' END AS reason FROM HR)
WHERE reason IS NOT NULL""", "HR", "MD")
ORACLE["historical_stored"] = with_views("""SELECT HX.request_id, HX.pos, CX.exchange, CX.exchange_token, CX.datetime, CX.open,
  CX.high, CX.low, CX.close, CX.volume, CX.oi FROM HX JOIN CX ON CX.exchange = HX.exchange
  AND CX.exchange_token = HX.exchange_token AND CX.interval_name = HX.interval_name
  AND CX.trade_date BETWEEN HX.from_date AND HX.to_date""", "HX", "CX")
ORACLE["candles_saved"] = ORACLE["candles_written"]
for _name in ("5minute", "30minute", "day"):
    ORACLE[f"bars_{_name}_rolled"] = ORACLE[f"bars_{_name}"]
ORACLE["bars_incremental"] = ORACLE["bars_1minute"]
ORACLE["chunk_coverage_items"] = with_views("""SELECT R.request_id, R.exchange, R.exchange_token, count(n) AS n_chunks,
  CAST(coalesce(sum(CASE WHEN n = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS empty_chunks, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_candles,
  CAST(coalesce(sum(CASE WHEN chunk_no % 2 = 1 AND R.exchange_token % 10 = 3 THEN 1 ELSE 0 END), 0) AS BIGINT) AS failed_chunks,
  CASE WHEN sum(n) > 0 THEN 1 ELSE 0 END AS retrieved
FROM (SELECT DISTINCT request_id, exchange, exchange_token FROM HX) R LEFT JOIN (
  SELECT CH.request_id, CH.exchange, CH.exchange_token, CH.pos, CH.chunk_no, count(XD.trade_date) AS n
  FROM (SELECT HX.*, k AS chunk_no, from_date + CAST(k * 5 AS INTEGER) AS chunk_from,
               least(from_date + CAST(k * 5 + 4 AS INTEGER), to_date) AS chunk_to
        FROM (SELECT HX.*, unnest(generate_series(0, CAST((to_date - from_date) // 5 AS BIGINT))) AS k
              FROM HX WHERE from_date <= to_date AND to_date < DATE '9999-01-01') HX) CH
  LEFT JOIN XD ON XD.exchange = CH.exchange AND XD.exchange_token = CH.exchange_token
    AND XD.trade_date BETWEEN CH.chunk_from AND CH.chunk_to
  GROUP BY 1, 2, 3, 4, 5) G ON G.request_id = R.request_id AND G.exchange = R.exchange AND G.exchange_token = R.exchange_token
GROUP BY 1, 2, 3""", "HX", "XD")
ORACLE["stream_enrich"] = with_views("""SELECT pos, instrument_token, exchange_token, trading_symbol,
  instrument_type, last_price, volume, oi FROM E""", "E")
ORACLE["stream_ltp"] = ORACLE["ltp"]
ORACLE["master_written"] = ORACLE["unified_master"]
ORACLE["stream_quotes_merged"] = ORACLE["quotes_merged"]
ORACLE["stream_bars"] = with_views(f"""SELECT {CANDLE_SEL} FROM B1
WHERE bucket + INTERVAL 1 MINUTE - {LOCAL} <= (SELECT max(ts) FROM T) - INTERVAL 10 MINUTE""", "B1")

# Ticks in four drops: those of large quantity a drop late, the last hour before a drop's start twice.  A tick
# is late when its time is not after the latest of all earlier drops less ten minutes.
_STARTS = ("TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-15'", "TIMESTAMP '2024-01-22'")
_DUE = " + ".join(f"(CASE WHEN ts >= {s} THEN 1 ELSE 0 END)" for s in _STARTS)
_AGAIN = " OR ".join(f"(ts >= {s} - INTERVAL 1 HOUR AND ts < {s})" for s in _STARTS)
_DROPS = (
    f"TD AS (SELECT T.*, least({_DUE} + CASE WHEN qty > 90 THEN 1 ELSE 0 END, 3) AS due, ({_AGAIN}) AS again FROM T)",
    "DL AS (SELECT *, due AS drop_no FROM TD UNION ALL SELECT *, due + 1 AS drop_no FROM TD WHERE again AND due < 3)",
    "MK AS (SELECT k, (SELECT max(ts) FROM DL WHERE drop_no < k) - INTERVAL 10 MINUTE AS mark FROM range(4) r(k))",
    "OT AS (SELECT DISTINCT event_id, exchange_token, ts, price, qty, oi FROM DL JOIN MK ON k = drop_no WHERE mark IS NULL OR ts > mark)",
)
ORACLE["stream_late_ticks"] = with_views(f"""SELECT CAST(drop_no AS BIGINT) AS batch, event_id, exchange_token,
  strftime(mark + {LOCAL}, {FMT}) AS mark FROM DL JOIN MK ON k = drop_no WHERE ts <= mark""", "T", extra=_DROPS)
ORACLE["stream_bars_restarted"] = with_views(f"""SELECT {CANDLE_SEL} FROM BO
WHERE bucket + INTERVAL 1 MINUTE - {LOCAL} <= (SELECT max(ts) FROM OT) - INTERVAL 10 MINUTE""", "T",
                                             extra=(*_DROPS, _bars_cte("BO", BUCKETS["1 minute"], "OT")))
ORACLE["stream_ltp_compacted"] = with_views("SELECT exchange, exchange_token, last_price, last_time FROM LX", "LX")

"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the DataFrame code, from the operator semantics:
same column names, doubles rounded to 4 decimals, integers cast to the Spark
widths (DuckDB sums are HUGEINT, doubles cast to INTEGER round instead of
truncating, so ``trunc`` first).
"""

from __future__ import annotations

from tradewatch.plans.queries import AS_OF, CSV_AS_OF, DETECTED_AT, EARLIER_RUN_ID, HIGH_VOLUME_QUERY_MIN, LARGE_QUANTITY, NARROW_DAYS, RUN_ID

FLOAT_RE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INT_RE = r"^[+-]?[0-9]+$"

_RAW_TRADES = """
raw_trades AS (
  SELECT event_id AS trade_id,
         'T' || CAST(user_id AS VARCHAR) AS trader_id,
         event_type AS stock,
         CAST(round(value * 100) AS BIGINT) AS quantity,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS price,
         strftime(ts, '%H:%M') AS "timestamp",
         CAST(ts AS DATE) AS trade_date,
         ts AS trade_ts
  FROM events)"""

_TRADES = (
    _RAW_TRADES
    + """,
trades AS (
  SELECT * FROM raw_trades
  WHERE trader_id IS NOT NULL AND trader_id <> '' AND stock IS NOT NULL AND stock <> ''
    AND quantity > 0 AND price > 0)"""
)

_CLOSES = """,
closes AS (
  SELECT stock, price_date, close, close_ts FROM (
    SELECT stock, trade_date AS price_date, price AS close,
           max(trade_ts) OVER (PARTITION BY stock, trade_date) AS close_ts,
           row_number() OVER (PARTITION BY stock, trade_date ORDER BY trade_ts DESC, trade_id DESC) AS rn
    FROM trades) x
  WHERE rn = 1)"""

_NEXT = """,
nx AS (
  SELECT stock, price_date, close,
         lead(close) OVER (PARTITION BY stock ORDER BY price_date, close) AS next_close
  FROM closes)"""

_PAIR = """,
two AS (
  SELECT stock, price_date, close,
         row_number() OVER (PARTITION BY stock ORDER BY price_date DESC, close DESC) AS recency
  FROM closes),
pair0 AS (
  SELECT stock,
         max(CASE WHEN recency = 2 THEN close END) AS prev_close,
         max(CASE WHEN recency = 1 THEN close END) AS last_close
  FROM two WHERE recency <= 2 GROUP BY stock),
pair AS (
  SELECT stock, prev_close, last_close,
         CASE WHEN prev_close IS NOT NULL AND last_close IS NOT NULL AND prev_close > 0
              THEN (last_close - prev_close) / prev_close * 100 ELSE 0.0 END AS price_change_pct
  FROM pair0)"""


def _stats(name: str, spread: str) -> str:
    return f""",
{name} AS (
  SELECT stock, avg(quantity) AS avg_qty, stddev_{spread}(quantity) AS stddev_qty, count(*) AS trade_count
  FROM trades GROUP BY stock)"""


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts) + "\n"


def _scored(profile: str) -> str:
    """CTE ``scored`` for a profile: post_trade or latest_pair."""
    if profile == "post_trade":
        base = (
            _NEXT
            + """,
sj AS (
  SELECT t.trade_id, t.trader_id, t.stock, t.quantity, s.avg_qty, s.stddev_qty,
         CASE WHEN n.close IS NOT NULL AND n.next_close IS NOT NULL AND n.close > 0
              THEN (n.next_close - n.close) / n.close * 100 ELSE 0.0 END AS price_change_pct
  FROM trades t
  LEFT JOIN st s ON s.stock = t.stock
  LEFT JOIN nx n ON n.stock = t.stock AND n.price_date = t.trade_date),
sz AS (
  SELECT *,
         CASE WHEN stddev_qty IS NOT NULL AND stddev_qty > 0
              THEN least(60.0, greatest(0.0, (quantity - avg_qty) / stddev_qty * 15.0)) ELSE 0.0 END AS size_score,
         CASE WHEN price_change_pct > 2.0 THEN least(40.0, price_change_pct * 4.0) ELSE 0.0 END AS price_score
  FROM sj)"""
        )
    else:
        base = (
            _PAIR
            + """,
sj AS (
  SELECT t.trade_id, t.trader_id, t.stock, t.quantity, s.avg_qty,
         greatest(coalesce(s.stddev_qty, 0.0), s.avg_qty * 0.01, 1.0) AS stddev_qty,
         coalesce(p.price_change_pct, 0.0) AS price_change_pct
  FROM trades t
  LEFT JOIN st s ON s.stock = t.stock
  LEFT JOIN pair p ON p.stock = t.stock),
sz AS (
  SELECT *,
         least(60.0, greatest(0.0, (quantity - avg_qty) / stddev_qty * 15.0)) AS size_score,
         CASE WHEN price_change_pct > 2.0 THEN least(40.0, price_change_pct * 4.0) ELSE 0.0 END AS price_score
  FROM sj)"""
        )
    return (
        _stats("st", "samp")
        + base
        + """,
scored AS (
  SELECT trade_id, trader_id, stock, quantity, avg_qty, stddev_qty, price_change_pct, size_score, price_score,
         CAST(trunc(least(100.0, greatest(0.0, size_score + price_score))) AS INTEGER) AS suspicion_score
  FROM sz)"""
    )


# Reason texts (same as tradewatch.profiles).
_REASONS = {
    "post_trade": (
        3.0,
        70,
        "Large trade immediately before a price spike (probable insider trading)",
        "Abnormally large trade volume relative to stock average",
        "Trade followed by significant price increase (>5%)",
        "Combined volume and price anomaly detected",
    ),
    "latest_pair": (
        2.0,
        50,
        "Large trade before price spike (probable insider trading)",
        "Abnormally large trade volume relative to stock average",
        "Trade followed by significant price increase (>5%)",
        "Combined volume and price anomaly",
    ),
}


def _flagged(profile: str) -> str:
    sigma, threshold, both, large, spike, other = _REASONS[profile]
    return (
        _scored(profile)
        + f""",
flagged AS (
  SELECT trade_id, trader_id, stock, quantity,
         CASE WHEN coalesce(quantity > avg_qty + {sigma} * stddev_qty, false) AND price_change_pct > 5.0 THEN '{both}'
              WHEN coalesce(quantity > avg_qty + {sigma} * stddev_qty, false) THEN '{large}'
              WHEN price_change_pct > 5.0 THEN '{spike}'
              ELSE '{other}' END AS reason,
         suspicion_score
  FROM scored WHERE suspicion_score > {threshold})"""
    )


_RESULTS = """,
res AS (
  SELECT sha256(concat_ws('|', CAST(trade_id AS VARCHAR), trader_id, stock)) AS id,
         trader_id, stock, quantity, reason, suspicion_score,
         TIMESTAMP '{ts}' AS detected_at
  FROM flagged)""".replace("{ts}", DETECTED_AT)


# --- dirty text (same construction as sources.events.dirty_lines) ----------

_PIECES = """
pieces AS (
  SELECT event_id, event_id % 16 AS ov, event_id % 7 AS pv,
         'T' || CAST(user_id AS VARCHAR) AS tr,
         event_type AS st,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS q,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS VARCHAR) || '.'
           || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') AS px,
         strftime(ts, '%H:%M') AS tm,
         strftime(ts, '%Y-%m-%d') AS dt
  FROM events),
order_lines AS (
  SELECT CASE ov
    WHEN 0 THEN ' ' || tr || ' , ' || st || ' ,' || q || ', ' || px || ' ,' || tm || ' '
    WHEN 1 THEN tr || ',' || st || ',0,' || px || ',' || tm
    WHEN 2 THEN tr || ',' || st || ',-' || q || ',' || px || ',' || tm
    WHEN 3 THEN tr || ',' || st || ',' || q || '.5,' || px || ',' || tm
    WHEN 4 THEN tr || ',,' || q || ',' || px || ',' || tm
    WHEN 5 THEN ',' || st || ',' || q || ',' || px || ',' || tm
    WHEN 6 THEN tr || ',' || st || ',' || q || ',abc,' || tm
    WHEN 7 THEN tr || ',' || st || ',' || q || ',' || px || ','
    WHEN 8 THEN tr || ',' || st || ',' || q || ',' || px || ',' || tm || ',extra'
    WHEN 9 THEN tr || ',' || st || ',' || q || ',nan,' || tm
    WHEN 10 THEN 'trader_id,stock,quantity,price,timestamp'
    WHEN 11 THEN '   '
    WHEN 12 THEN tr || ',' || st || ',' || q || ',' || px || ',25:99'
    WHEN 13 THEN tr || ',' || st
    WHEN 14 THEN 'DateTime,stock,price'
    ELSE tr || ',' || st || ',' || q || ',' || px || ',' || tm END AS value
  FROM pieces),
price_lines AS (
  SELECT CASE pv
    WHEN 0 THEN ' ' || dt || ' , ' || st || ' , ' || px || ' '
    WHEN 1 THEN dt || ',' || st || ',0'
    WHEN 2 THEN dt || ',,' || px
    WHEN 3 THEN dt || ',' || st || ',x'
    WHEN 4 THEN ',' || st || ',' || px
    WHEN 6 THEN dt || ',' || st || ',-' || px
    ELSE dt || ',' || st || ',' || px END AS value
  FROM pieces),
raw_lines AS (SELECT value FROM order_lines UNION ALL SELECT value FROM price_lines)"""

_CLEAN = (
    _PIECES
    + f""",
split_lines AS (
  SELECT string_split(trim(value), ',') AS parts FROM raw_lines WHERE trim(value) <> ''),
body AS (
  SELECT parts FROM split_lines WHERE lower(trim(parts[1])) NOT IN ('trader_id', 'datetime')),
o5 AS (
  SELECT trim(parts[1]) AS trader_id, trim(parts[2]) AS stock, trim(parts[3]) AS q, trim(parts[4]) AS p,
         trim(parts[5]) AS "timestamp"
  FROM body WHERE len(parts) = 5),
clean_o AS (
  SELECT trader_id, stock, TRY_CAST(q AS BIGINT) AS quantity, TRY_CAST(p AS DOUBLE) AS price, "timestamp"
  FROM o5
  WHERE regexp_matches(q, '{INT_RE}') AND TRY_CAST(q AS BIGINT) > 0
    AND regexp_matches(p, '{FLOAT_RE}') AND TRY_CAST(p AS DOUBLE) > 0 AND isfinite(TRY_CAST(p AS DOUBLE))
    AND stock <> '' AND trader_id <> ''),
p3 AS (
  SELECT trim(parts[1]) AS datetime, trim(parts[2]) AS stock, trim(parts[3]) AS p
  FROM body WHERE len(parts) = 3),
clean_p AS (
  SELECT datetime, stock, TRY_CAST(p AS DOUBLE) AS price FROM p3
  WHERE regexp_matches(p, '{FLOAT_RE}') AND TRY_CAST(p AS DOUBLE) > 0 AND isfinite(TRY_CAST(p AS DOUBLE)) AND stock <> ''),
tagged AS (
  SELECT 'ORDER' || chr(9) || trader_id || ',' || stock || ',' || CAST(quantity AS VARCHAR) || ','
         || printf('%.4f', price) || ',' || coalesce("timestamp", '') AS value FROM clean_o
  UNION ALL
  SELECT 'PRICE' || chr(9) || coalesce(datetime, '') || ',' || stock || ',' || printf('%.4f', price) FROM clean_p)"""
)


def _r(c: str, alias: str | None = None) -> str:
    return f"round({c}, 4) AS {alias or c.split('.')[-1]}"


ORACLE: dict[str, str] = {}

# --- statistics, large trades ------------------------------------------------

for key, spread in (("stock_stats", "samp"), ("stock_stats_pop", "pop")):
    ORACLE[key] = _with(_TRADES) + f"""
SELECT stock, round(avg(quantity), 4) AS avg_qty, round(stddev_{spread}(quantity), 4) AS stddev_qty,
       count(*) AS trade_count
FROM trades GROUP BY stock"""

for key, spread in (("large_trades", "pop"), ("large_trades_sample", "samp")):
    ORACLE[key] = _with(_TRADES, _stats("st", spread)) + """
SELECT t.trade_id, t.trader_id, t.stock, t.quantity, round(t.price, 4) AS price, t."timestamp",
       round(s.avg_qty, 4) AS avg_qty, round(s.stddev_qty, 4) AS stddev_qty
FROM trades t JOIN st s ON s.stock = t.stock
WHERE t.quantity > s.avg_qty + 3.0 * s.stddev_qty"""

ORACLE["trades_with_stats"] = _with(_TRADES, _stats("st", "samp")) + """
SELECT t.trade_id, t.trader_id, t.stock, t.quantity, round(s.avg_qty, 4) AS avg_qty,
       round(s.stddev_qty, 4) AS stddev_qty, s.trade_count
FROM trades t LEFT JOIN st s ON s.stock = t.stock"""

ORACLE["trade_zscore"] = _with(_TRADES, _stats("st", "samp")) + """
SELECT t.trade_id, t.stock, t.quantity, round(s.avg_qty, 4) AS avg_qty, round(s.stddev_qty, 4) AS stddev_qty,
       round(CASE WHEN s.stddev_qty IS NOT NULL AND s.stddev_qty > 0
                  THEN (t.quantity - s.avg_qty) / s.stddev_qty END, 4) AS z_score
FROM trades t LEFT JOIN st s ON s.stock = t.stock"""

ORACLE["stock_profile"] = _with(_TRADES) + """
SELECT stock, round(median(price), 4) AS median_price, max(quantity) AS max_qty,
       round(avg(quantity), 4) AS avg_qty, max(quantity) > avg(quantity) * 2 AS concentrated
FROM trades GROUP BY stock"""

# --- summaries ----------------------------------------------------------------

_TRADER_SUMMARY_SELECT = """
SELECT trader_id, count(*) AS trade_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       round(avg(price), 4) AS avg_price, round(max(price), 4) AS max_price
FROM trades GROUP BY trader_id"""

ORACLE["trader_summary"] = _with(_TRADES) + _TRADER_SUMMARY_SELECT
ORACLE["insert_overwrite_directory"] = ORACLE["trader_summary"]

for key, spread in (("stock_summary", "samp"), ("stock_summary_pop", "pop")):
    ORACLE[key] = _with(_TRADES) + f"""
SELECT stock, count(*) AS trade_count, round(avg(quantity), 4) AS avg_quantity,
       round(stddev_{spread}(quantity), 4) AS stddev_quantity, round(avg(price), 4) AS avg_price
FROM trades GROUP BY stock"""

ORACLE["high_volume_traders"] = _with(_TRADES) + f"""
SELECT trader_id, CAST(sum(quantity) AS BIGINT) AS total_volume
FROM trades GROUP BY trader_id HAVING sum(quantity) > {HIGH_VOLUME_QUERY_MIN}"""

ORACLE["traded_symbols"] = _with(_TRADES) + """
SELECT DISTINCT stock FROM trades WHERE stock IS NOT NULL"""

# --- prices -------------------------------------------------------------------

ORACLE["latest_price"] = _with(_TRADES, _CLOSES) + """
SELECT stock, price_date, round(close, 4) AS close FROM (
  SELECT *, row_number() OVER (PARTITION BY stock ORDER BY price_date DESC, close DESC) AS rn FROM closes) x
WHERE rn = 1"""

ORACLE["next_close"] = _with(_TRADES, _CLOSES, _NEXT) + """
SELECT stock, price_date, round(close, 4) AS close, round(next_close, 4) AS next_close FROM nx"""

ORACLE["last_two_prices"] = _with(_TRADES, _CLOSES, _PAIR) + """
SELECT stock, price_date, round(close, 4) AS close, CAST(recency AS INTEGER) AS recency
FROM two WHERE recency <= 2"""

ORACLE["price_change_latest_pair"] = _with(_TRADES, _CLOSES, _PAIR) + """
SELECT stock, round(prev_close, 4) AS prev_close, round(last_close, 4) AS last_close,
       round(price_change_pct, 4) AS price_change_pct
FROM pair"""

ORACLE["post_trade_change"] = _with(_TRADES, _CLOSES, _NEXT) + """
SELECT t.trade_id, t.stock, t.trade_date, round(n.close, 4) AS close, round(n.next_close, 4) AS next_close,
       round(CASE WHEN n.close IS NOT NULL AND n.next_close IS NOT NULL AND n.close > 0
                  THEN (n.next_close - n.close) / n.close * 100 ELSE 0.0 END, 4) AS price_change_pct
FROM trades t LEFT JOIN nx n ON n.stock = t.stock AND n.price_date = t.trade_date"""

ORACLE["trades_with_latest_price"] = _with(_TRADES, _CLOSES) + """,
latest AS (
  SELECT stock, price_date, close FROM (
    SELECT *, row_number() OVER (PARTITION BY stock ORDER BY price_date DESC, close DESC) AS rn FROM closes) x
  WHERE rn = 1)
SELECT t.trade_id, t.trader_id, t.stock, t.quantity, l.price_date AS latest_date, round(l.close, 4) AS current_close
FROM trades t LEFT JOIN latest l ON l.stock = t.stock"""

ORACLE["asof_next_price"] = _with(_TRADES, _CLOSES) + """
SELECT t.trade_id, t.stock, t.trade_ts, round(c.close, 4) AS next_price, c.close_ts AS next_price_ts
FROM trades t ASOF LEFT JOIN closes c ON t.stock = c.stock AND t.trade_ts < c.close_ts"""

_LOOKBACK = f""",
lookback AS (
  SELECT stock, price_date, close FROM closes
  WHERE price_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}'
    AND stock IN (SELECT stock FROM trades WHERE stock IS NOT NULL))"""

ORACLE["prices_lookback"] = _with(_TRADES, _CLOSES, _LOOKBACK) + """
SELECT stock, price_date, round(close, 4) AS close FROM lookback"""

ORACLE["price_store_lookback"] = ORACLE["prices_lookback"]

ORACLE["symbols_without_prices"] = _with(_TRADES) + f""",
s AS (SELECT stock || '/' || trader_id AS stock, trade_date FROM trades)
SELECT DISTINCT stock FROM s WHERE stock NOT IN (
  SELECT stock FROM s WHERE trade_date BETWEEN DATE '{AS_OF}' - {NARROW_DAYS} AND DATE '{AS_OF}')"""

_HALF = """,
halves AS (
  SELECT stock, price_date, close, close_ts FROM (
    SELECT stock, trade_date AS price_date, price AS close, trade_ts AS close_ts,
           row_number() OVER (PARTITION BY stock, trade_date, hour(trade_ts) >= 12 ORDER BY trade_ts DESC, trade_id DESC) AS rn
    FROM trades) x
  WHERE rn = 1),
ordered AS (
  SELECT stock, price_date, close, row_number() OVER (PARTITION BY stock ORDER BY close_ts DESC) AS recency,
         lead(close) OVER (PARTITION BY stock ORDER BY close_ts) AS next_close
  FROM halves)"""

ORACLE["latest_price_intraday"] = _with(_TRADES, _HALF) + """
SELECT stock, price_date, round(close, 4) AS close FROM ordered WHERE recency = 1"""

ORACLE["next_close_intraday"] = _with(_TRADES, _HALF) + """
SELECT stock, price_date, round(close, 4) AS close, round(next_close, 4) AS next_close FROM ordered"""

ORACLE["last_two_prices_intraday"] = _with(_TRADES, _HALF) + """
SELECT stock, price_date, round(close, 4) AS close, CAST(recency AS INTEGER) AS recency FROM ordered WHERE recency <= 2"""

ORACLE["price_change_intraday"] = _with(_TRADES, _HALF) + """
SELECT n.stock, round(p.close, 4) AS prev_close, round(n.close, 4) AS last_close,
       round(coalesce((n.close - p.close) / nullif(greatest(p.close, 0), 0) * 100, 0.0), 4) AS price_change_pct
FROM ordered n LEFT JOIN ordered p ON p.stock = n.stock AND p.recency = 2
WHERE n.recency = 1"""

ORACLE["union_prices"] = _with(_TRADES, _CLOSES, ",", _CLEAN) + """
SELECT CAST(price_date AS VARCHAR) AS datetime, stock, round(round(close, 2), 4) AS price FROM closes
UNION ALL
SELECT datetime, stock, round(round(price, 2), 4) AS price FROM clean_p"""

# --- scoring ----------------------------------------------------------------

for profile in ("post_trade", "latest_pair"):
    ORACLE[f"score_{profile}"] = _with(_TRADES, _CLOSES, _scored(profile)) + """
SELECT trade_id, trader_id, stock, quantity, round(avg_qty, 4) AS avg_qty, round(stddev_qty, 4) AS stddev_qty,
       round(price_change_pct, 4) AS price_change_pct, round(size_score, 4) AS size_score,
       round(price_score, 4) AS price_score, suspicion_score
FROM scored"""
    ORACLE[f"flagged_{profile}"] = _with(_TRADES, _CLOSES, _flagged(profile)) + """
SELECT * FROM flagged"""

_RES = _with(_TRADES, _CLOSES, _flagged("post_trade"), _RESULTS)

ORACLE["alerts_ranked"] = _RES + "SELECT * FROM res"

ORACLE["alert_stats"] = _RES + """
SELECT count(*) AS total, count(*) FILTER (WHERE suspicion_score >= 90) AS critical,
       count(*) FILTER (WHERE suspicion_score >= 70 AND suspicion_score < 90) AS moderate
FROM res"""

ORACLE["alerts_display"] = _RES + """
SELECT id, trader_id, stock, format('{:,}', quantity) AS quantity_display, reason,
       CAST(suspicion_score AS VARCHAR) || '%' AS score_label,
       CASE WHEN suspicion_score >= 90 THEN 'critical' WHEN suspicion_score >= 70 THEN 'moderate' ELSE 'low' END
         AS severity,
       coalesce(strftime(detected_at, '%Y-%m-%d %H:%M:%S'), '—') AS detected_display
FROM res"""

ORACLE["results_refresh"] = _RES + """
SELECT id, trader_id, stock, quantity, reason, suspicion_score FROM res"""

# uploads: the run's trades stand in place of all trades; closes come from all of them
_ALL = _TRADES.replace("\ntrades AS (", "\nall_trades AS (")
_ALL_CLOSES = _CLOSES.replace("FROM trades)", "FROM all_trades)")

ORACLE["file_arrival_run"] = _with(_ALL, _ALL_CLOSES, """,
trades AS (SELECT * FROM all_trades WHERE trade_id % 16 <> 7)""", _flagged("latest_pair")) + """
SELECT trader_id, stock, quantity, reason, suspicion_score FROM flagged"""

ORACLE["pipeline_from_csv"] = _with(_ALL, _ALL_CLOSES.replace("closes AS (", "every_close AS (", 1), f""",
trades AS (
  SELECT * REPLACE (CASE WHEN trade_id % 16 = 8 THEN CAST({LARGE_QUANTITY} AS BIGINT) ELSE quantity END AS quantity)
  FROM all_trades WHERE trade_id % 16 NOT IN (1, 2, 4, 5, 6, 7)),
closes AS (
  SELECT * FROM every_close
  WHERE price_date BETWEEN DATE '{CSV_AS_OF}' - 30 AND DATE '{CSV_AS_OF}' AND stock IN (SELECT stock FROM trades))""",
    _flagged("latest_pair")) + """
SELECT trader_id, stock, quantity, reason, suspicion_score FROM flagged"""

ORACLE["results_clear"] = _RES + """
SELECT (SELECT count(*) FROM res) AS rows_before, CAST(0 AS BIGINT) AS rows_after"""

ORACLE["alerts_export"] = _with(_TRADES, _CLOSES, _flagged("latest_pair")) + """
SELECT trader_id, stock, quantity, reason, suspicion_score FROM flagged"""

ORACLE["stage_counts"] = _with(_TRADES, _CLOSES, _flagged("post_trade"), _stats("stp", "pop")) + """
SELECT 'orders_in' AS stage, count(*) AS row_count FROM raw_trades
UNION ALL SELECT 'orders_clean', count(*) FROM trades
UNION ALL SELECT 'large_trades', count(*) FROM trades t JOIN stp s ON s.stock = t.stock
          WHERE t.quantity > s.avg_qty + 3.0 * s.stddev_qty
UNION ALL SELECT 'flagged', count(*) FROM flagged"""

# --- cleaning, tagging, parsing, times ------------------------------------

ORACLE["clean_orders"] = _with(_CLEAN) + """
SELECT trader_id, stock, quantity, price, "timestamp" FROM clean_o"""

ORACLE["clean_prices"] = _with(_CLEAN) + """
SELECT datetime, stock, price FROM clean_p"""

ORACLE["clean_typed_orders"] = _with(_PIECES) + f""",
typed_rows AS (
  SELECT nullif(trim(parts[1]), '') AS trader_id, nullif(trim(parts[2]), '') AS stock,
         nullif(trim(parts[3]), '') AS quantity, nullif(trim(parts[4]), '') AS price,
         nullif(trim(parts[5]), '') AS "timestamp"
  FROM (SELECT string_split(value, ',') AS parts FROM order_lines) x
  WHERE len(parts) = 5),
kept AS (
  SELECT *, CASE WHEN regexp_matches(quantity, '{FLOAT_RE}') AND isfinite(TRY_CAST(quantity AS DOUBLE))
                 THEN TRY_CAST(quantity AS DOUBLE) END AS qd,
            CASE WHEN regexp_matches(price, '{FLOAT_RE}') AND isfinite(TRY_CAST(price AS DOUBLE))
                 THEN TRY_CAST(price AS DOUBLE) END AS pd
  FROM typed_rows
  WHERE trader_id IS NOT NULL AND stock IS NOT NULL AND quantity IS NOT NULL AND price IS NOT NULL
    AND "timestamp" IS NOT NULL)
SELECT trader_id, stock, CAST(trunc(qd) AS BIGINT) AS quantity, pd AS price, "timestamp"
FROM kept WHERE qd > 0 AND pd > 0"""

ORACLE["clean_typed_prices"] = _with(_PIECES) + f""",
typed_prices AS (
  SELECT nullif(trim(parts[1]), '') AS datetime, nullif(trim(parts[2]), '') AS stock,
         nullif(trim(parts[3]), '') AS price
  FROM (SELECT string_split(value, ',') AS parts FROM price_lines) x)
SELECT datetime, stock, TRY_CAST(price AS DOUBLE) AS price
FROM typed_prices
WHERE datetime IS NOT NULL AND stock IS NOT NULL AND price IS NOT NULL
  AND regexp_matches(price, '{FLOAT_RE}') AND isfinite(TRY_CAST(price AS DOUBLE)) AND TRY_CAST(price AS DOUBLE) > 0"""

ORACLE["tagged_records"] = _with(_CLEAN) + "SELECT value FROM tagged"

ORACLE["parse_tagged"] = _with(_CLEAN) + """
SELECT trader_id, stock, quantity, CAST(printf('%.4f', price) AS DOUBLE) AS trade_price,
       coalesce("timestamp", '') AS trade_time
FROM clean_o"""

ORACLE["parse_tagged_regex"] = ORACLE["parse_tagged"]

ORACLE["parse_tagged_prices"] = _with(_CLEAN) + """
SELECT coalesce(datetime, '') AS price_date, stock, CAST(printf('%.4f', price) AS DOUBLE) AS close_price
FROM clean_p"""

ORACLE["trade_seconds"] = _with(_TRADES) + """
SELECT trade_id, "timestamp",
       CAST(split_part("timestamp", ':', 1) AS INTEGER) * 3600 + CAST(split_part("timestamp", ':', 2) AS INTEGER) * 60
         AS trade_seconds
FROM trades"""

ORACLE["order_timestamps"] = _with(_CLEAN) + f"""
SELECT trader_id, stock, quantity, "timestamp",
       try_strptime('{AS_OF} ' || "timestamp", '%Y-%m-%d %H:%M') AS order_ts
FROM clean_o"""

# --- sinks and round trips ------------------------------------------------------

ORACLE["raw_landing"] = _with(_PIECES) + "SELECT value FROM raw_lines"

ORACLE["orders_csv_roundtrip"] = _with(_TRADES) + """
SELECT trader_id, stock, quantity, round(price, 4) AS price, "timestamp" FROM trades"""

ORACLE["prices_csv_roundtrip"] = _with(_TRADES, _CLOSES) + """
SELECT price_date AS datetime, stock, round(close, 4) AS price FROM closes"""

ORACLE["large_trades_export"] = _with(_TRADES, _stats("st", "pop")) + """
SELECT t.trader_id, t.stock, t.quantity, round(t.price, 4) AS price, t."timestamp",
       round(s.avg_qty, 4) AS avg_qty, round(s.stddev_qty, 4) AS stddev_qty
FROM trades t JOIN st s ON s.stock = t.stock
WHERE t.quantity > s.avg_qty + 3.0 * s.stddev_qty"""

ORACLE["external_table_scan"] = _with(_TRADES) + """
SELECT 'ORDER' AS record_type, trader_id, stock, quantity, round(price, 4) AS price, "timestamp" AS trade_time
FROM trades"""

ORACLE["run_partitioned_write"] = _with(_TRADES) + f"""
SELECT trade_id, trader_id, stock, quantity, price, "timestamp", trade_date, trade_ts, run_id
FROM trades, (VALUES ('{EARLIER_RUN_ID}'), ('{RUN_ID}')) r(run_id)"""

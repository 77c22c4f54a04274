"""Research-data shapes out of the star-schema tables, in SQL that Spark and DuckDB both read.

``sql(body)`` puts the shapes that a query names before it as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SHAPES = {
    "ticks": """
SELECT CASE user_id % 4 WHEN 0 THEN CAST(600000 + user_id AS STRING) || '.SH' WHEN 1 THEN lpad(CAST(user_id AS STRING), 6, '0') || '.SZ'
            WHEN 2 THEN CAST(300000 + user_id AS STRING) || '.SZ' ELSE CAST(920000 + user_id AS STRING) || '.BJ' END AS symbol,
       user_id, event_id, CAST(ts AS DATE) AS trade_date, ts AS trade_time, value AS price, 1 + event_id % 100 AS volume, event_type AS direction,
       row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS tick_seq,
       row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS from_last
FROM {events}""",
    "bars": """
SELECT symbol, trade_date, max(CASE WHEN tick_seq = 0 THEN price END) AS open, max(price) AS high, min(price) AS low,
       max(CASE WHEN from_last = 1 THEN price END) AS close, CAST(sum(volume) AS BIGINT) AS volume,
       CAST(sum(CAST(round(price * 100) AS BIGINT) * volume) AS DOUBLE) / 100 AS amount
FROM ticks GROUP BY symbol, trade_date""",
    "bars_raw": """
SELECT *, 'vendor_a' AS source, 'v1' AS data_version, CAST(trade_date AS TIMESTAMP) + INTERVAL 16 HOUR AS fetched_at FROM bars
UNION ALL
SELECT symbol, trade_date, open, high + 1, low, close + 1, volume, amount, 'vendor_b', 'v1',
       CASE WHEN volume % 3 = 0 THEN NULL WHEN volume % 3 = 1 THEN CAST(trade_date AS TIMESTAMP) + INTERVAL 10 HOUR ELSE CAST(trade_date AS TIMESTAMP) + INTERVAL 16 HOUR END
FROM bars WHERE volume % 4 = 0
UNION ALL
SELECT symbol, trade_date, close, close, close, close, 0, CAST(0 AS DOUBLE), 'vendor_c', 'v2', CAST(trade_date AS TIMESTAMP) + INTERVAL 30 HOUR FROM bars WHERE volume % 9 = 0""",
    "calendar": """
SELECT trade_date, max(CASE WHEN tick_seq >= 0 THEN 1 ELSE 0 END) = 1 AS is_trading FROM ticks GROUP BY trade_date""",
    "factor_events": """
SELECT symbol, trade_date, max(n) AS n, CAST(100 + max(n) AS DOUBLE) / 100 AS factor
FROM (SELECT symbol, trade_date, row_number() OVER (PARTITION BY symbol ORDER BY trade_time, event_id) AS n FROM ticks WHERE direction = 'signup') s GROUP BY symbol, trade_date""",
    "instruments": """
SELECT DISTINCT symbol, CASE WHEN user_id % 7 = 0 THEN 'ST name ' || CAST(user_id AS STRING) ELSE 'name ' || CAST(user_id AS STRING) END AS name,
       split_part(symbol, '.', 2) AS exchange, 'stock' AS asset_type,
       CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 5 = 0 THEN DATE '2024-01-05' ELSE DATE '2020-06-01' END AS list_date,
       CASE WHEN user_id % 13 = 0 THEN DATE '2024-01-20' END AS delist_date
FROM ticks WHERE user_id % 17 <> 3""",
    "status": """
SELECT symbol, trade_date, CASE WHEN volume % 23 <> 0 THEN volume % 6 <> 0 END AS is_trading, CASE WHEN volume % 6 = 0 THEN 'suspended' WHEN volume % 5 = 0 THEN 'st' ELSE 'normal' END AS status,
       CASE WHEN volume % 7 = 0 THEN TRUE WHEN volume % 7 = 1 THEN FALSE END AS risk_warning,
       CASE WHEN volume % 2 = 0 THEN 'history' WHEN volume % 3 = 0 THEN 'gap' ELSE 'snapshot' END AS source, 'v1' AS data_version,
       CAST(trade_date AS TIMESTAMP) + INTERVAL 9 HOUR AS fetched_at
FROM bars WHERE volume % 10 <> 9""",
    # several sources a day: a snapshot of a later day, one of the closed session, a later gap row over history
    "status_raw": """
SELECT * FROM status
UNION ALL
SELECT symbol, trade_date, TRUE, 'normal', NULL, 'snapshot', 'v1', CAST(trade_date AS TIMESTAMP) + INTERVAL 40 HOUR FROM status WHERE source = 'gap'
UNION ALL
SELECT symbol, trade_date, TRUE, 'normal', FALSE, 'snapshot', 'v2', CAST(trade_date AS TIMESTAMP) + INTERVAL 450 MINUTE FROM status WHERE source = 'gap' AND day(trade_date) % 3 = 0
UNION ALL
SELECT symbol, trade_date, FALSE, 'suspended', NULL, 'gap', 'v1', CAST(trade_date AS TIMESTAMP) + INTERVAL 50 HOUR FROM status WHERE source = 'history' AND day(trade_date) % 2 = 0""",
    "codes": """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'SH' WHEN 1 THEN 'SZ' WHEN 2 THEN 'sh' ELSE NULL END AS exchange,
       CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE CAST(CASE WHEN p_partkey % 3 = 0 THEN 689000 + p_partkey % 40 WHEN p_partkey % 7 < 3 THEN 159990 + p_partkey % 60 WHEN p_partkey % 11 < 4 THEN 510000 + p_partkey ELSE 15 + p_partkey % 7000 END AS STRING) END AS code
FROM {part}""",
    "facts": """
SELECT CAST(o_custkey AS STRING) AS symbol, CAST(year(o_orderdate) AS STRING) || 'Q' || CAST(quarter(o_orderdate) AS STRING) AS report_period, 'income' AS statement_type,
       o_orderpriority AS item_code, o_totalprice AS item_value, CAST(o_orderdate AS DATE) AS announce_date, CASE o_orderstatus WHEN 'F' THEN 'history_backfill' WHEN 'O' THEN 'live' ELSE 'snapshot_store' END AS source, 'v1' AS data_version,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 20 HOUR AS fetched_at, o_orderkey AS fact_id
FROM {orders}""",
    "members": """
SELECT DISTINCT symbol, 'class_a' AS classification_system, CAST(240000 + (user_id % 5) * 10000 + (user_id % 3) * 100 + user_id % 2 AS STRING) AS industry_code, DATE '2024-01-03' AS as_of_date FROM ticks WHERE user_id % 19 <> 0
UNION ALL
SELECT DISTINCT symbol, 'class_a', CAST(240000 + (user_id % 4) * 10000 + (user_id % 3) * 100 + user_id % 2 AS STRING), DATE '2024-01-15' FROM ticks WHERE user_id % 23 <> 0""",
    "actions": """
SELECT symbol, trade_date AS ex_date, direction AS action_type, CAST(sum(event_id % 5) AS DOUBLE) / 10 AS cash_dividend, CAST(sum(event_id % 3) AS DOUBLE) / 10 AS bonus_ratio,
       CASE WHEN max(event_id) % 2 = 0 THEN CAST(0.1 AS DOUBLE) END AS transfer_ratio, CAST(max(event_id % 2) AS DOUBLE) / 10 AS allotment_ratio, CAST(5 AS DOUBLE) AS allotment_price
FROM ticks WHERE direction IN ('signup', 'error') GROUP BY symbol, trade_date, direction""",
    "other_bars": """
SELECT symbol, trade_date, open, high, low, CASE WHEN volume % 8 = 0 THEN close + 1 WHEN volume % 8 = 1 THEN NULL ELSE close END AS close, volume, amount FROM bars WHERE volume % 12 <> 5""",
    # sources with holes, as a failed fetch leaves them
    "thin_bars": """
SELECT * FROM bars WHERE volume % 5 <> 0""",
    "holed_ticks": """
SELECT * FROM ticks WHERE event_id % 17 <> 0""",
    "minutes": """
SELECT symbol, trade_date, date_trunc('minute', trade_time) AS bar_time, '1m' AS frequency, min_by(price, tick_seq) AS open, max_by(price, tick_seq) AS close, max(price) AS high, min(price) AS low, CAST(sum(volume) AS BIGINT) AS volume,
       CAST(sum(CAST(round(price * 100) AS BIGINT) * volume) AS DOUBLE) / 100 AS amount
FROM ticks GROUP BY symbol, trade_date, date_trunc('minute', trade_time)""",
    "headlines": """
SELECT conv_id, turn, lower(text) AS title, DATE '2024-01-01' + CAST(conv_id % 30 AS INT) AS trade_date,
       CAST(conv_id % 50 AS STRING) || '.sz;' || CAST(conv_id % 7 AS STRING) || '.sh, bad' AS related_symbols FROM {conversations}""",
    "probes": """
SELECT direction AS probe, CASE user_id % 2 WHEN 0 THEN 'north' ELSE 'south' END AS vantage, trade_time AS at, trade_date AS day, event_id,
       CASE WHEN event_id % 10 < 6 THEN 'ok' WHEN event_id % 10 < 9 THEN 'failed' ELSE 'skipped' END AS state, event_id % 4 <> 0 AS fresh FROM ticks""",
    "holders": """
SELECT CAST(l_suppkey AS STRING) AS symbol, CAST(l_shipdate AS DATE) AS record_date, CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_shipdate AS DATE) + 20 END AS announce_date,
       l_quantity AS holders, l_linestatus AS kind, l_orderkey, l_linenumber, l_partkey FROM {lineitem}""",
}


def _needed(body: str, found: list[str], stored: tuple[str, ...] = ()) -> list[str]:
    for name, text in SHAPES.items():
        if name not in found and re.search(rf"(?i)\b(?:from|join)\s+{name}\b", body):
            if name not in stored:
                _needed(text, found, stored)
            if name not in found:
                found.append(name)
    return found


def sql(body: str, first: str = "") -> str:
    """body with the shapes it reads as common table expressions, over tables named as such."""
    ctes = [f"{n} AS ({SHAPES[n]}\n)" for n in _needed(first + body, [])]
    text = ("WITH " + ",\n".join([*ctes, first] if first else ctes) + "\n" if ctes or first else "") + body
    return re.sub(r"\{(\w+)\}", r"\1", text)


def shape(spark: SparkSession, sf_dir: str, name: str, stored: dict[str, str] | None = None) -> DataFrame:
    """A shape as a DataFrame over the Parquet tables of a folder, and over those shapes that are stored, by their folders."""
    stored = stored or {}
    made = {n: f"SELECT * FROM parquet.`{path}`" for n, path in stored.items()}
    ctes = [f"{n} AS ({made.get(n, SHAPES[n])}\n)" for n in _needed(f"FROM {name}", [], tuple(stored))]
    text = "WITH " + ",\n".join(ctes) + f"\nSELECT * FROM {name}"
    return spark.sql(re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", text))

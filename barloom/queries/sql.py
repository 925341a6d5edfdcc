"""Pieces of oracle SQL (DuckDB dialect) used by more than one query."""
from __future__ import annotations


def half_up(x: str, d: int) -> str:
    """Round half away from zero on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def even(x: str, d: int) -> str:
    return f"(round_even(({x}) * 1e{d}, 0) / 1e{d})"


def pct(a: str, b: str) -> str:
    return f"(({a}) - ({b})) / nullif({b}, 0) * 100.0"


def mean(x: str, frame: str) -> str:
    """Mean of a frame with the values added left to right, like a running aggregate."""
    total = f"list_reduce(list_prepend(CAST(0 AS DOUBLE), list(CAST({x} AS DOUBLE)) OVER {frame}), lambda a, b: a + b)"
    return f"({total} / count({x}) OVER {frame})"


BARS_DAILY = """bars AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS event_date,
         arg_min(o_totalprice, o_orderkey) AS open_price, max(o_totalprice) AS high_price,
         min(o_totalprice) AS low_price, arg_max(o_totalprice, o_orderkey) AS close_price,
         count(*) AS volume
  FROM orders GROUP BY 1, 2)"""

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts AS event_time, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume FROM events)"""

BARS_5M = TICKS + """, bars AS (
  SELECT symbol, time_bucket(INTERVAL 5 MINUTE, event_time) AS event_time,
         arg_min(price, ticks.event_time) AS open_price, max(price) AS high_price,
         min(price) AS low_price, arg_max(price, ticks.event_time) AS close_price,
         CAST(sum(volume) AS BIGINT) AS volume
  FROM ticks GROUP BY 1, 2)"""

BARS_WIDE = """bars AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, ts AS event_time, value AS open_price, value AS high_price,
         value AS low_price, value AS close_price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events)"""

NEWS = """news AS (
  SELECT doc_id, ['click','error','purchase','signup','view'][CAST(doc_id % 5 AS INTEGER) + 1] AS symbol,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 7919 % 2592000) AS published_at,
         split_part(text, chr(10), 1) AS title, text AS body,
         'https://news/' || CAST(doc_id // 2 AS VARCHAR) AS url, source FROM documents)"""


def numbered(ts: str, source: str = "bars") -> str:
    return f"numbered AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {ts}) AS rn FROM {source})"


def gapped(ts: str) -> str:
    """Bars some of which lack a close, numbered."""
    given = "day(event_date) % 7 >= 2" if ts == "event_date" else "(hour(event_time) * 60 + minute(event_time)) % 35 >= 10"
    return (
        f"gapped AS (SELECT * REPLACE (CASE WHEN {given} THEN close_price END AS close_price) FROM bars), {numbered(ts, 'gapped')}"
    )


def ema_cte(spans, adjust: bool = False) -> str:
    """Recurrence over row numbers; a missing close repeats the average and ages the weight of the past.

    Adjusted weights carry numerator and denominator, the plain form its average and the weight of the past.
    """
    x = "b.close_price"
    if adjust:
        first = ", ".join(
            f"coalesce(close_price, 0) AS n{s}, CASE WHEN close_price IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS d{s}" for s in spans)
        step = ", ".join(
            f"coalesce({x}, 0) + (1 - 2.0::DOUBLE/{s + 1}) * e.n{s}, "
            f"CASE WHEN {x} IS NULL THEN 0 ELSE 1 END + (1 - 2.0::DOUBLE/{s + 1}) * e.d{s}" for s in spans
        )
    else:
        first = ", ".join(f"close_price AS e{s}, 1.0::DOUBLE AS m{s}" for s in spans)
        a, q = "(2.0::DOUBLE/{0})", "(1 - 2.0::DOUBLE/{0})"  # {0}: span + 1
        step = ", ".join(
            f"CASE WHEN {x} IS NULL THEN e.e{s} WHEN e.e{s} IS NULL THEN {x} WHEN e.m{s} = 1 THEN {a} * {x} + {q} * e.e{s} "
            f"ELSE ({a} * {x} + {q} * e.m{s} * e.e{s}) / ({a} + {q} * e.m{s}) END, "
            f"CASE WHEN {x} IS NULL THEN {q} * e.m{s} ELSE 1 END".format(s + 1)
            for s in spans
        )
    return f"""ema AS (
  SELECT symbol, rn, {first} FROM numbered WHERE rn = 1
  UNION ALL
  SELECT b.symbol, b.rn, {step} FROM ema e JOIN numbered b ON b.symbol = e.symbol AND b.rn = e.rn + 1)"""


def windows(ts: str) -> str:
    base = f"PARTITION BY symbol ORDER BY {ts}"
    back = ", ".join(f"w{n} AS ({base} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (9, 14, 20, 50))
    return (
        f"WINDOW w AS ({base}), {back}, "
        f"prior AS ({base} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), "
        f"ahead AS ({base} ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING)"
    )

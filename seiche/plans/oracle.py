"""The same results in DuckDB's SQL: segmentation as a recursive query over ticks, everything else over its events."""

from __future__ import annotations

#: For each source: ticker, time (ns), price and the order of rows of equal time.
SOURCES = {
    "events_by_user": "SELECT CAST(user_id AS VARCHAR) AS ticker, epoch_us(ts) * 1000 AS time, CAST(value AS DOUBLE) AS price, 1.0::DOUBLE AS quantity, event_id AS o1, 0 AS o2 FROM events",
    "events_by_type": "SELECT CAST(event_type AS VARCHAR) AS ticker, epoch_us(ts) * 1000 AS time, CAST(value AS DOUBLE) AS price, 1.0::DOUBLE AS quantity, event_id AS o1, 0 AS o2 FROM events",
    "orders_by_priority": "SELECT CAST(o_orderpriority AS VARCHAR) AS ticker, epoch_us(CAST(o_orderdate AS TIMESTAMP)) * 1000 AS time, CAST(o_totalprice AS DOUBLE) AS price, 1.0::DOUBLE AS quantity, o_orderkey AS o1, 0 AS o2 FROM orders",
    "lineitem_by_supplier": "SELECT CAST(l_suppkey AS VARCHAR) AS ticker, epoch_us(CAST(l_shipdate AS TIMESTAMP)) * 1000 AS time, CAST(l_extendedprice AS DOUBLE) / CAST(l_quantity AS DOUBLE) AS price, CAST(l_quantity AS DOUBLE) AS quantity, l_orderkey AS o1, l_linenumber AS o2 FROM lineitem",
}


def silver(source: str, thetas: tuple[float, ...]) -> str:
    """WITH RECURSIVE ... tk (ticks), ev (reversals), silver (events), fin (the end of each key)."""
    values = ", ".join(f"({t!r}::DOUBLE)" for t in thetas)
    return f"""WITH RECURSIVE src AS ({SOURCES[source]}),
th(theta) AS (VALUES {values}),
o AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY time, o1, o2) - 1 AS i FROM src),
tk AS MATERIALIZED (SELECT ticker, i, time, price, quantity,
  CASE WHEN price < lag(price) OVER (PARTITION BY ticker ORDER BY i) THEN -1 ELSE 1 END AS direction,
  list(price) OVER (PARTITION BY ticker, time ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
  max(i) OVER (PARTITION BY ticker, time) AS last_i FROM o),
ticks_n AS (SELECT ticker, count(*) AS n FROM tk GROUP BY ticker),
st AS (
  SELECT ticker, theta, -1::BIGINT AS i, 0 AS trend, price AS hp, 0::BIGINT AS hi, price AS lp, 0::BIGINT AS li, 0 AS event, 0::BIGINT AS xi, 0.0::DOUBLE AS cpx, 0::BIGINT AS ci FROM tk CROSS JOIN th WHERE i = 0
  UNION ALL
  SELECT ticker, theta, i, CASE WHEN nt <> 0 THEN nt ELSE trend END,
    CASE WHEN nt = 1 THEN cpx ELSE hp END, CASE WHEN nt = 1 THEN last_i ELSE hi END,
    CASE WHEN nt = -1 THEN cpx ELSE lp END, CASE WHEN nt = -1 THEN last_i ELSE li END,
    CASE WHEN nt <> 0 AND xi < last_i THEN nt ELSE 0 END, xi, cpx, last_i
  FROM (SELECT *, CASE WHEN nt = 1 THEN li ELSE hi END AS xi,
      CASE WHEN nt = 1 THEN list_min(list_filter(rest, lambda q: q >= lp * (1.0::DOUBLE + theta))) WHEN nt = -1 THEN list_max(list_filter(rest, lambda q: q <= hp * (1.0::DOUBLE - theta))) ELSE 0.0::DOUBLE END AS cpx
    FROM (SELECT *, CASE WHEN trend <= 0 AND p >= lp * (1.0::DOUBLE + theta) THEN 1 WHEN trend >= 0 AND p <= hp * (1.0::DOUBLE - theta) THEN -1 ELSE 0 END AS nt
      FROM (SELECT s.ticker, s.theta, tk.i, s.trend, tk.price AS p, tk.rest, tk.last_i,
          CASE WHEN tk.price > s.hp THEN tk.price ELSE s.hp END AS hp, CASE WHEN tk.price > s.hp THEN tk.i ELSE s.hi END AS hi,
          CASE WHEN tk.price < s.lp THEN tk.price ELSE s.lp END AS lp, CASE WHEN tk.price < s.lp THEN tk.i ELSE s.li END AS li
        FROM st s JOIN tk ON tk.ticker = s.ticker AND tk.i = s.i + 1) a) b) c
),
ev AS MATERIALIZED (SELECT ticker, theta, event, xi, ci, cpx, row_number() OVER w - 1 AS event_seq, lead(xi) OVER w AS next_xi FROM st WHERE event <> 0 WINDOW w AS (PARTITION BY ticker, theta ORDER BY i)),
silver AS MATERIALIZED (SELECT ev.ticker, ev.theta, ev.event_seq, ev.event AS event_type, r.price AS reference_price, r.time AS reference_time,
  coalesce(x.price, -1.0::DOUBLE) AS extreme_price, coalesce(x.time, -1) AS extreme_time, ev.cpx AS confirm_price, k.time AS confirm_time,
  ev.xi + 1 AS dc_start, ev.ci AS dc_end, CASE WHEN ev.next_xi IS NULL THEN n.n - 1 ELSE greatest(ev.next_xi, ev.ci) END AS os_end
  FROM ev JOIN ticks_n n ON n.ticker = ev.ticker JOIN tk r ON r.ticker = ev.ticker AND r.i = ev.xi JOIN tk k ON k.ticker = ev.ticker AND k.i = ev.ci LEFT JOIN tk x ON x.ticker = ev.ticker AND x.i = ev.next_xi),
fin AS (SELECT s.ticker, s.theta, n.n AS n_ticks, s.trend AS current_trend, s.hp AS high_price, s.lp AS low_price,
  CASE WHEN (SELECT count(*) FROM ev WHERE ev.ticker = s.ticker AND ev.theta = s.theta) = 0 THEN 0 WHEN s.trend = 1 THEN s.hi + 1 ELSE s.li + 1 END AS orphan_start
  FROM st s JOIN ticks_n n ON n.ticker = s.ticker AND s.i = n.n - 1)
"""


#: Events with their lists of ticks, after silver().
LISTS = """, dc AS (SELECT e.ticker, e.theta, e.event_seq, list(t.price ORDER BY t.i) AS price_dc, list(t.time ORDER BY t.i) AS time_dc, list(t.quantity ORDER BY t.i) AS qty_dc, list(t.direction ORDER BY t.i) AS dir_dc FROM silver e JOIN tk t ON t.ticker = e.ticker AND t.i BETWEEN e.dc_start AND e.dc_end GROUP BY ALL),
os AS (SELECT e.ticker, e.theta, e.event_seq, list(t.price ORDER BY t.i) AS price_os, list(t.time ORDER BY t.i) AS time_os, list(t.quantity ORDER BY t.i) AS qty_os, list(t.direction ORDER BY t.i) AS dir_os FROM silver e JOIN tk t ON t.ticker = e.ticker AND t.i > e.dc_end AND t.i <= e.os_end GROUP BY ALL),
full_ev AS MATERIALIZED (SELECT e.*, dc.price_dc, dc.time_dc, dc.qty_dc, dc.dir_dc, coalesce(os.price_os, []::DOUBLE[]) AS price_os, coalesce(os.time_os, []::BIGINT[]) AS time_os, coalesce(os.qty_os, []::DOUBLE[]) AS qty_os, coalesce(os.dir_os, []::INTEGER[]) AS dir_os
  FROM silver e JOIN dc USING (ticker, theta, event_seq) LEFT JOIN os USING (ticker, theta, event_seq))
"""


def events(theta: float) -> str:
    """ind: silver with all indicators that need no lists, at theta."""
    t = f"{theta!r}::DOUBLE"
    return f""", i1 AS (SELECT *, confirm_price - reference_price AS dc_magnitude, extreme_price - confirm_price AS os_magnitude, confirm_time - reference_time AS dc_time, extreme_time - confirm_time AS os_time,
  confirm_price - reference_price * (1.0::DOUBLE + event_type * {t}) AS dc_slippage FROM silver),
i2 AS (SELECT *, dc_magnitude / nullif(reference_price, 0) AS dc_return, os_magnitude / nullif(confirm_price, 0) AS os_return, dc_magnitude + os_magnitude AS event_magnitude, abs(dc_magnitude) AS a1_dc_price_abs, dc_time + os_time AS event_time,
  CASE WHEN dc_time > 0 THEN dc_magnitude / (dc_time / 1e9::DOUBLE) ELSE 0.0 END AS dc_velocity, CASE WHEN os_time > 0 THEN os_magnitude / (os_time / 1e9::DOUBLE) ELSE 0.0 END AS os_velocity,
  lag(confirm_price) OVER w AS a4_prev_dcc_price, CASE WHEN abs(lag(os_magnitude) OVER w) > 0 THEN 1 ELSE 0 END AS a5_prev_os_flag, CASE WHEN dc_time = 0 THEN 1 ELSE 0 END AS a6_flash_event
  FROM i1 WINDOW w AS (PARTITION BY ticker, theta ORDER BY event_seq)),
ind AS (SELECT *, abs(event_magnitude) AS total_move, abs(event_magnitude) / nullif(reference_price * {t}, 0) AS tmv, abs(os_return) / {t} AS osv_event,
  CASE WHEN event_time > 0 THEN event_magnitude / (event_time / 1e9::DOUBLE) ELSE 0.0 END AS event_velocity FROM i2)
"""


SUMMARY = """round(coalesce(sum(abs(tmv)), 0), 6) AS tmv_aggregated, round(avg(dc_time), -3) AS avg_dc_time, round(avg(dc_return), 9) AS avg_return, round(avg(os_magnitude), 9) AS avg_os_magnitude,
 round(stddev_samp(dc_return), 9) AS volatility_dc, count(*) AS ndc, round(coalesce(sum(abs(tmv)), 0), 6) AS cdc,
 CAST(sum(CASE WHEN event_type = 1 THEN dc_time ELSE 0 END) - sum(CASE WHEN event_type = -1 THEN dc_time ELSE 0 END) AS BIGINT) AS accumulated_time"""

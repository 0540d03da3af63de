"""DuckDB SQL for the adapter and the silver fact, shared by every oracle query.

Each oracle query is ``WITH <base CTEs> SELECT ...``, so it runs on the driver's
views alone. This is test scaffolding (an independent second computation), not
part of the engine.
"""

from __future__ import annotations

_BRAND = "CAST(split_part(p_brand, '#', 2) AS INTEGER)"
_DEPT = f"p_type || '_' || CAST({_BRAND} % 3 + 1 AS VARCHAR)"
_WEEK = "CAST((year({d}) % 100) * 100 + weekofyear({d}) AS INTEGER)"


# Event dates of the years that the driver's tables cover, from a calendar.
_EVENT_DATES = {
    "SuperBowl": "1992-01-26 1993-01-31 1994-01-30 1995-01-29 1996-01-28 1997-01-26 1998-01-25 1999-01-31 2000-01-30 2001-01-28 2002-02-03",
    "MemorialDay": "1992-05-25 1993-05-31 1994-05-30 1995-05-29 1996-05-27 1997-05-26 1998-05-25 1999-05-31 2000-05-29 2001-05-28 2002-05-27",
    "LaborDay": "1992-09-07 1993-09-06 1994-09-05 1995-09-04 1996-09-02 1997-09-01 1998-09-07 1999-09-06 2000-09-04 2001-09-03 2002-09-02",
    "Thanksgiving": "1992-11-26 1993-11-25 1994-11-24 1995-11-23 1996-11-28 1997-11-27 1998-11-26 1999-11-25 2000-11-23 2001-11-22 2002-11-28",
    "Christmas": "1992-12-25 1993-12-25 1994-12-25 1995-12-25 1996-12-25 1997-12-25 1998-12-25 1999-12-25 2000-12-25 2001-12-25 2002-12-25",
}
_EVENTS = ", ".join(f"(DATE '{d}', '{name}')" for name, days in _EVENT_DATES.items() for d in days.split())


def _daily(level: str) -> str:
    item, dept = ("item_id", "dept_id") if level == "item" else ("cat_id", "cat_id")
    return f"""
daily_{level} AS (
  SELECT {item} AS item_id, {dept} AS dept_id, cat_id, store_id, state_id, date,
         CAST(sum(qty) AS INTEGER) AS sales, CAST(sum(cents) AS BIGINT) AS cents,
         {item} || '_' || store_id || '_validation' AS id
  FROM lines GROUP BY {item}, {dept}, cat_id, store_id, state_id, date),
prices_{level} AS (
  SELECT store_id, item_id, {_WEEK.format(d='date')} AS wm_yr_wk,
         CAST(sum(cents) // sum(sales) AS DOUBLE) / 100.0 AS sell_price
  FROM daily_{level} GROUP BY ALL),
fact_{level} AS (
  SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, s.date, s.sales,
         c.wm_yr_wk, c.weekday, c.wday, c.month, c.year, c.d,
         coalesce(c.event_name_1, '') AS event_name_1, coalesce(c.event_type_1, '') AS event_type_1,
         coalesce(c.event_name_2, '') AS event_name_2, coalesce(c.event_type_2, '') AS event_type_2,
         c.snap_CA, c.snap_TX, c.snap_WI, p.sell_price,
         CAST(round(p.sell_price * 100) AS BIGINT) AS price_cents,
         CAST(s.sales AS BIGINT) * CAST(round(p.sell_price * 100) AS BIGINT) AS revenue_cents,
         CAST(CAST(s.sales AS BIGINT) * CAST(round(p.sell_price * 100) AS BIGINT) AS DOUBLE) / 100.0 AS revenue,
         c.wday AS week,
         CAST(c.wday IN (1, 2) AS INTEGER) AS is_weekend,
         CAST(coalesce(c.event_name_1, '') <> '' AS INTEGER) AS is_holiday,
         CAST(quarter(s.date) AS INTEGER) AS quarter, dayname(s.date) AS day_name,
         CAST(weekofyear(s.date) AS INTEGER) AS week_of_year
  FROM daily_{level} s JOIN cal c ON s.date = c.date
  JOIN prices_{level} p ON s.store_id = p.store_id AND s.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk)"""


BASE = f"""
li AS (
  SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS date, l_quantity AS qty,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem),
items AS (
  SELECT p_partkey, p_type AS cat_id, {_DEPT} AS dept_id,
         {_DEPT} || '_' || lpad(CAST({_BRAND} AS VARCHAR), 3, '0') AS item_id
  FROM part),
stores AS (
  SELECT s_suppkey, n_name AS store_id, r_name AS state_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lines AS (
  SELECT li.date, li.qty, li.cents, i.cat_id, i.dept_id, i.item_id, s.store_id, s.state_id
  FROM li JOIN items i ON li.l_partkey = i.p_partkey JOIN stores s ON li.l_suppkey = s.s_suppkey),
bounds AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) + 30 AS hi FROM lineitem),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM bounds),
cal_events(date, event_name_1) AS (VALUES {_EVENTS}),
cal_raw AS (SELECT spine.date, e.event_name_1 FROM spine LEFT JOIN cal_events e ON e.date = spine.date),
cal AS (
  SELECT c.date, {_WEEK.format(d='c.date')} AS wm_yr_wk, dayname(c.date) AS weekday,
         CAST((dayofweek(c.date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(c.date) AS INTEGER) AS month, CAST(year(c.date) AS INTEGER) AS year,
         'd_' || CAST(date_diff('day', b.lo, c.date) + 1 AS VARCHAR) AS d,
         c.event_name_1,
         CASE WHEN c.event_name_1 = 'SuperBowl' THEN 'Sporting'
              WHEN c.event_name_1 IS NOT NULL THEN 'National' END AS event_type_1,
         CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
         CAST(day(c.date) <= 10 AS INTEGER) AS snap_CA,
         CAST(day(c.date) <= 15 AS INTEGER) AS snap_TX,
         CAST(day(c.date) <= 14 AS INTEGER) AS snap_WI
  FROM cal_raw c, bounds b),{_daily('item')},{_daily('category')},
hist_category AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS rn FROM fact_category) WHERE rn > 28)
"""


def with_base(sql: str, extra: str = "", recursive: bool = False) -> str:
    """``WITH <base>[, extra] <sql>``."""
    ctes = BASE.rstrip() + ("," + extra if extra else "")
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{sql}"

"""DuckDB oracle SQL per registered query (an independent second computation)."""

from __future__ import annotations

from tillcast.plans.oracle_base import with_base

ORACLE: dict[str, str] = {}

TOTALS = ("CAST(sum(sales) AS BIGINT) AS total_units, "
          "CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue")
AVG_PRICE = "CAST(sum(price_cents) AS DOUBLE) / count(price_cents) / 100.0 AS avg_sell_price"
KEYS = "id, item_id, dept_id, cat_id, store_id, state_id"
FACT_COLUMNS = ("id, item_id, dept_id, cat_id, store_id, state_id, date, sales, wm_yr_wk, weekday, wday, "
                "month, year, d, event_name_1, event_type_1, event_name_2, event_type_2, "
                "snap_CA, snap_TX, snap_WI, sell_price, price_cents, revenue_cents, revenue")

GOLD_KEYS = {
    "gold_daily_sales": ["date", "year", "month", "wday", "is_holiday"],
    "gold_store_performance": ["store_id", "state_id"],
    "gold_product_performance": ["item_id", "dept_id", "cat_id"],
    "gold_category_sales": ["cat_id"],
    "gold_state_sales": ["state_id"],
    "gold_monthly_sales": ["year", "month"],
}


def _gold_sql(name: str, src: str = "fact_item") -> str:
    keys = ", ".join(GOLD_KEYS[name])
    extra = ", " + AVG_PRICE if name == "gold_store_performance" else ""
    return f"SELECT {keys}, {TOTALS}{extra} FROM {src} GROUP BY {keys}"


# --- clean / reshape ------------------------------------------------------------

ORACLE["calendar_dim"] = with_base("SELECT * FROM cal")
ORACLE["clean_calendar"] = with_base(
    "SELECT date, wm_yr_wk, weekday, wday, month, year, d, coalesce(event_name_1, '') AS event_name_1, "
    "coalesce(event_type_1, '') AS event_type_1, coalesce(event_name_2, '') AS event_name_2, "
    "coalesce(event_type_2, '') AS event_type_2, snap_CA, snap_TX, snap_WI FROM cal")
ORACLE["clean_prices"] = with_base("SELECT * FROM prices_item WHERE sell_price > 0")
ORACLE["dedupe_rows"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
             l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1"""
ORACLE["sample_series"] = with_base(
    f"SELECT * FROM (SELECT DISTINCT {KEYS} FROM daily_item) ORDER BY id LIMIT 100")
ORACLE["melt_daily"] = with_base(
    f"""SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, w.d,
           CAST(coalesce(f.sales, 0) AS INTEGER) AS sales
    FROM ser s CROSS JOIN win w
    LEFT JOIN daily_category f ON f.id = s.id AND f.date = w.date""",
    extra=f"""
last AS (SELECT max(date) AS m FROM daily_category),
win AS (SELECT c.date, c.d FROM cal c, last WHERE c.date <= last.m),
ser AS (SELECT DISTINCT {KEYS} FROM daily_category)""")
ORACLE["sales_fact"] = with_base(f"SELECT {FACT_COLUMNS} FROM fact_item")

# --- gold -------------------------------------------------------------------------

for _n in GOLD_KEYS:
    ORACLE[_n] = with_base(_gold_sql(_n))
ORACLE["gold_daily_sales_stream"] = ORACLE["gold_daily_sales"]

_ALL_COLS = ["date", "year", "month", "wday", "is_holiday", "store_id", "state_id",
             "item_id", "dept_id", "cat_id"]


def _all_part(name: str) -> str:
    keys = GOLD_KEYS[name]
    sel = ", ".join(c if c in keys else f"NULL AS {c}" for c in _ALL_COLS)
    return (f"SELECT {sel}, {TOTALS}, CAST(sum(price_cents) AS BIGINT) AS price_cents_sum, "
            f"count(price_cents) AS price_rows, '{name}' AS \"table\" FROM fact_item GROUP BY {', '.join(keys)}")


ORACLE["gold_all_grouping_sets"] = with_base("\nUNION ALL\n".join(_all_part(n) for n in GOLD_KEYS))
ORACLE["gold_after_warmup"] = with_base(
    f"SELECT cat_id, {TOTALS} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS rn "
    f"FROM fact_category) WHERE rn > 28 GROUP BY cat_id")

# --- features ---------------------------------------------------------------------

ORACLE["time_features"] = with_base(
    "SELECT id, date, year, month, week, is_weekend, is_holiday, quarter, day_name, week_of_year FROM fact_item")
ORACLE["lag_rolling_features"] = with_base("""
SELECT * FROM (
  SELECT id, date, sales,
    lag(sales, 7) OVER w AS lag_7, lag(sales, 14) OVER w AS lag_14, lag(sales, 28) OVER w AS lag_28,
    avg(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7_avg,
    avg(sales) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_30_avg
  FROM fact_category WINDOW w AS (PARTITION BY id ORDER BY date))
WHERE lag_7 IS NOT NULL AND lag_14 IS NOT NULL AND lag_28 IS NOT NULL
  AND rolling_7_avg IS NOT NULL AND rolling_30_avg IS NOT NULL""")
def _lag_sql(days: int) -> str:
    return f"""CAST(coalesce(max(sales) OVER (PARTITION BY id ORDER BY date RANGE BETWEEN INTERVAL {days} DAY PRECEDING
       AND INTERVAL {days} DAY PRECEDING), 0) AS DOUBLE) AS cal_lag_{days}"""


ORACLE["calendar_lags"] = with_base(
    f"SELECT id, date, sales, {_lag_sql(7)}, {_lag_sql(14)}, {_lag_sql(28)} FROM fact_category")
ORACLE["calendar_rolling"] = with_base("""
SELECT a.id, a.date, a.sales,
  coalesce((SELECT avg(b.sales) FROM fact_category b WHERE b.id = a.id
            AND b.date >= a.date - 7 AND b.date < a.date), 0.0) AS cal_rolling_7_avg,
  coalesce((SELECT avg(b.sales) FROM fact_category b WHERE b.id = a.id
            AND b.date >= a.date - 30 AND b.date < a.date), 0.0) AS cal_rolling_30_avg
FROM fact_category a""")

# --- priority-2 marts ---------------------------------------------------------------

ORACLE["dept_performance"] = with_base(
    f"SELECT dept_id, cat_id, {TOTALS} FROM fact_item GROUP BY dept_id, cat_id")
ORACLE["product_avg_price"] = with_base(
    f"SELECT item_id, dept_id, cat_id, {TOTALS}, {AVG_PRICE} FROM fact_item GROUP BY item_id, dept_id, cat_id")
ORACLE["holiday_sales"] = with_base(f"""
SELECT *, CASE WHEN days > 0 THEN CAST(total_units AS DOUBLE) / days ELSE 0.0 END AS units_per_day,
          CASE WHEN days > 0 THEN total_revenue / days ELSE 0.0 END AS revenue_per_day
FROM (SELECT is_holiday, {TOTALS}, count(DISTINCT date) AS days FROM fact_item GROUP BY is_holiday)""")
ORACLE["seasonal_index"] = with_base("""
SELECT month, wday, CAST(sum(units) AS DOUBLE) / count(units) AS mean_daily_units, count(*) AS days,
       CAST(sum(units) AS DOUBLE) / count(units)
         / (SELECT CAST(sum(units) AS DOUBLE) / count(units) FROM daily) AS seasonal_index
FROM daily GROUP BY month, wday""", extra="""
daily AS (SELECT date, month, wday, CAST(sum(sales) AS BIGINT) AS units FROM fact_item GROUP BY date, month, wday)""")


def _growth_sql(keys: list[str]) -> str:
    k = ", ".join(keys) + ", " if keys else ""
    same = "".join(f" AND p.{x} = c.{x}" for x in keys)
    by_month = f"(SELECT {k}year, month, {TOTALS} FROM fact_item GROUP BY {k}year, month)"
    return f"""
SELECT c.*, p.total_revenue AS prev_revenue,
       CASE WHEN p.total_revenue > 0 THEN (c.total_revenue - p.total_revenue) / p.total_revenue * 100.0 ELSE 0.0 END
          AS growth_pct
FROM {by_month} c LEFT JOIN {by_month} p ON p.year * 12 + p.month = c.year * 12 + c.month - 1{same}"""


ORACLE["monthly_growth"] = with_base(_growth_sql([]))
ORACLE["category_growth"] = with_base(_growth_sql(["cat_id"]))
ORACLE["product_growth"] = with_base(_growth_sql(["item_id"]))
ORACLE["store_vs_state"] = with_base(f"""
SELECT store_id, state_id, total_units, total_revenue, avg_sell_price, state_mean_revenue,
  CASE WHEN state_mean_revenue > 0 THEN (total_revenue / state_mean_revenue - 1.0) * 100.0 ELSE 0.0 END
    AS revenue_vs_state_pct,
  rank_in_state
FROM (SELECT *,
        CAST(sum(cents) OVER (PARTITION BY state_id) AS DOUBLE) / count(cents) OVER (PARTITION BY state_id) / 100.0
          AS state_mean_revenue,
        rank() OVER (PARTITION BY state_id ORDER BY total_revenue DESC, store_id) AS rank_in_state
      FROM (SELECT store_id, state_id, {TOTALS}, {AVG_PRICE}, sum(revenue_cents) AS cents
            FROM fact_item GROUP BY store_id, state_id))""")

# --- KPIs ----------------------------------------------------------------------------

ORACLE["kpi_totals"] = with_base("""
SELECT CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue,
       CAST(sum(sales) AS BIGINT) AS total_units_sold,
       CASE WHEN sum(sales) > 0 THEN CAST(sum(revenue_cents) AS DOUBLE) / sum(sales) ELSE 0.0 END / 100.0
         AS average_selling_price,
       count(DISTINCT item_id) AS active_products, count(DISTINCT store_id) AS active_stores
FROM fact_item""")
ORACLE["kpi_wow_growth"] = with_base("""
SELECT m AS max_date, CAST(l AS DOUBLE) / 100.0 AS last_7_revenue, CAST(p AS DOUBLE) / 100.0 AS prev_7_revenue,
       CASE WHEN p > 0 THEN CAST(l - p AS DOUBLE) / p * 100.0 ELSE 0.0 END AS growth_rate_wow
FROM (SELECT m, coalesce(sum(revenue_cents) FILTER (WHERE date > m - 7), 0) AS l,
             coalesce(sum(revenue_cents) FILTER (WHERE date <= m - 7), 0) AS p
      FROM fact_item, (SELECT max(date) AS m FROM fact_item) WHERE date > m - 14 GROUP BY m)""")
ORACLE["kpi_filtered"] = with_base("""
SELECT CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS Total_Revenue, CAST(sum(sales) AS BIGINT) AS Total_Units_Sold,
       count(id) AS Record_Count
FROM fact_item WHERE state_id = 'AMERICA' AND cat_id = 'PROMO'""")
ORACLE["daily_trend"] = with_base(
    "SELECT date, CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS Daily_Revenue FROM fact_item GROUP BY date")
ORACLE["category_share"] = with_base("""
SELECT cat_id, CAST(sum(sales) AS BIGINT) AS total_units, CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue,
       CAST(sum(revenue_cents) AS DOUBLE) / (SELECT sum(revenue_cents) FROM fact_item) * 100.0 AS share_pct
FROM fact_item GROUP BY cat_id""")
ORACLE["store_ranking"] = with_base(
    f"SELECT *, rank() OVER (ORDER BY total_revenue DESC, store_id) AS revenue_rank "
    f"FROM ({_gold_sql('gold_store_performance')})")
_PROD = _gold_sql("gold_product_performance")
ORACLE["top_products_5"] = with_base(f"SELECT * FROM ({_PROD}) ORDER BY total_revenue DESC, item_id LIMIT 5")
ORACLE["worst_products_5"] = with_base(f"SELECT * FROM ({_PROD}) ORDER BY total_revenue ASC, item_id DESC LIMIT 5")
ORACLE["top_products_10"] = with_base(f"SELECT * FROM ({_PROD}) ORDER BY total_revenue DESC, item_id LIMIT 10")

# --- forecasting ---------------------------------------------------------------------

RULE = ("0.4::DOUBLE * coalesce(h[24], 0) + 0.2::DOUBLE * coalesce(h[17], 0) + 0.1::DOUBLE * coalesce(h[3], 0)"
        " + 0.2::DOUBLE * coalesce(list_avg(h[24:30]), 0) + 0.1::DOUBLE * coalesce(list_avg(h), 0)")


def _recursion(p: str, as_of: str, hist: str = "hist_category") -> str:
    """Recursive CTE ``{p}`` = rule forecast for 30 calendar days after ``as_of``
    (an expression over ``{p}_last.m``), carrying the 30-day state as a list."""
    return f"""
{p}_last AS (SELECT {as_of} AS m FROM (SELECT max(date) AS m FROM {hist})),
{p}_hz AS (
  SELECT row_number() OVER (ORDER BY date) AS k, * FROM (
    SELECT c.date, c.wday, c.month, c.year, CAST(c.wday IN (1, 2) AS INTEGER) AS is_weekend,
           CAST(coalesce(c.event_name_1, '') <> '' AS INTEGER) AS is_holiday, c.snap_CA, c.snap_TX, c.snap_WI
    FROM cal c, {p}_last l WHERE c.date > l.m ORDER BY c.date LIMIT 30)),
{p}_ser AS (
  SELECT id, item_id, dept_id, cat_id, store_id, state_id, arg_max(sell_price, date) AS sell_price
  FROM {hist}, {p}_last l WHERE date <= l.m GROUP BY ALL),
{p}_init AS (
  SELECT s.id, list(CAST(f.sales AS DOUBLE) ORDER BY g.i) AS h
  FROM {p}_ser s CROSS JOIN range(1, 31) g(i) CROSS JOIN {p}_last l
  LEFT JOIN {hist} f ON f.id = s.id AND f.date = l.m - 30 + CAST(g.i AS INTEGER)
  GROUP BY s.id),
{p}_rec(id, k, h, date, y) AS (
  SELECT id, 0, h, CAST(NULL AS DATE), CAST(NULL AS DOUBLE) FROM {p}_init
  UNION ALL
  SELECT id, k, list_concat(h[2:30], [y]), date, y FROM (
    SELECT id, k, h, date, round_even(greatest({RULE}, 0), 0) AS y
    FROM (SELECT r.id, r.k + 1 AS k, r.h, z.date FROM {p}_rec r JOIN {p}_hz z ON z.k = r.k + 1))),
{p} AS (
  SELECT r.id, r.date, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, s.sell_price,
         CAST(r.y AS INTEGER) AS sales,
         CAST(CAST(r.y AS BIGINT) * CAST(round(s.sell_price * 100) AS BIGINT) AS DOUBLE) / 100.0 AS revenue,
         CAST(r.y AS BIGINT) * CAST(round(s.sell_price * 100) AS BIGINT) AS revenue_cents
  FROM {p}_rec r JOIN {p}_ser s USING (id) WHERE r.k > 0)"""


FC = _recursion("fc", "m")


def with_fc(sql: str, extra: str = "") -> str:
    return with_base(sql, extra=FC + ("," + extra if extra else ""), recursive=True)


ORACLE["series_directory"] = with_base(f"SELECT DISTINCT {KEYS} FROM hist_category")
ORACLE["last_price"] = with_base("SELECT id, arg_max(sell_price, date) AS last_price FROM hist_category GROUP BY id")
ORACLE["forecast_horizon"] = with_fc("SELECT * EXCLUDE (k) FROM fc_hz")
ORACLE["chrono_split"] = with_base("""
SELECT CASE WHEN date <= m - 30 THEN 'train' ELSE 'validation' END AS split, count(*) AS rows
FROM hist_category, (SELECT max(date) AS m FROM hist_category) GROUP BY 1""")
ORACLE["forecast_recursive_rule"] = with_fc("SELECT * EXCLUDE (revenue_cents) FROM fc")
_FC_DAILY = ("SELECT date, CAST(sum(sales) AS BIGINT) AS total_units, "
             "CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue FROM fc GROUP BY date")
ORACLE["forecast_daily"] = with_fc(_FC_DAILY)
ORACLE["forecast_totals"] = with_fc("""
SELECT CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS forecast_revenue, CAST(sum(sales) AS BIGINT) AS forecast_units,
       count(DISTINCT date) AS forecast_days,
       CASE WHEN count(DISTINCT date) > 0 THEN CAST(sum(sales) AS DOUBLE) / count(DISTINCT date) ELSE 0.0 END
         AS mean_daily_units
FROM fc""")
ORACLE["forecast_band"] = with_fc(
    f"SELECT *, total_units * 0.9::DOUBLE AS band_low, total_units * 1.1::DOUBLE AS band_high FROM ({_FC_DAILY})")
ORACLE["forecast_points"] = with_fc(f"""
SELECT date, 'Historical' AS type, CAST(total_units AS DOUBLE) AS sales, total_revenue AS revenue
FROM ({_gold_sql('gold_daily_sales', 'hist_category')}) WHERE date >= (SELECT max(date) FROM hist_category) - 90
UNION ALL
SELECT date, 'Forecasted' AS type, CAST(total_units AS DOUBLE) AS sales, total_revenue AS revenue FROM ({_FC_DAILY})""")
ORACLE["history_vs_forecast"] = with_fc("""
SELECT date, CAST(sum(sales) AS BIGINT) AS sales, 'Actual' AS type FROM hist_category GROUP BY date
UNION ALL
SELECT date, CAST(sum(sales) AS BIGINT) AS sales, 'Forecast' AS type FROM fc GROUP BY date""")
# Products: the recursion over item x store series and the whole fact.
PFC = _recursion("pf", "m", "fact_item")


def _dimension(d: str) -> str:
    return (f"SELECT '{d}' AS dimension, {d} AS key, date, CAST(sum(sales) AS BIGINT) AS total_units, "
            f"CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue FROM pf GROUP BY {d}, date")


ORACLE["forecast_by_dimension"] = with_base(
    "\nUNION ALL\n".join(map(_dimension, ["item_id", "cat_id", "store_id", "state_id"])), extra=PFC, recursive=True)
ORACLE["forecast_products"] = with_base("""
SELECT item_id, dept_id, cat_id, date, CAST(sum(sales) AS BIGINT) AS total_units,
       CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue, count(*) FILTER (sales > 0) AS stores
FROM pf GROUP BY ALL""", extra=PFC, recursive=True)
_RULE_METRICS = """
SELECT count(*) AS rows, round(sqrt(sum(e * e) / count(*)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
       round(CASE WHEN sum(y * y) - sum(y) * sum(y) / count(*) > 0
             THEN 1.0 - sum(e * e) / (sum(y * y) - sum(y) * sum(y) / count(*)) END, 6) AS r2
FROM (SELECT greatest(0.4::DOUBLE * lag_7 + 0.2::DOUBLE * lag_14 + 0.1::DOUBLE * lag_28
                      + 0.2::DOUBLE * rolling_7_avg + 0.1::DOUBLE * rolling_30_avg, 0) - sales AS e,
             CAST(sales AS DOUBLE) AS y
      FROM feats WHERE date > (SELECT max(date) FROM feats) - 30)"""
_FEATS = """
feats AS (
  SELECT * FROM (
    SELECT *,
      CAST(lag(sales, 7) OVER w AS DOUBLE) AS lag_7, CAST(lag(sales, 14) OVER w AS DOUBLE) AS lag_14,
      CAST(lag(sales, 28) OVER w AS DOUBLE) AS lag_28,
      avg(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7_avg,
      avg(sales) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_30_avg
    FROM fact_category WINDOW w AS (PARTITION BY id ORDER BY date))
  WHERE lag_28 IS NOT NULL AND lag_14 IS NOT NULL AND lag_7 IS NOT NULL
    AND rolling_7_avg IS NOT NULL AND rolling_30_avg IS NOT NULL)"""
ORACLE["forecast_metrics_rule"] = with_base(_RULE_METRICS, extra=_FEATS)
ORACLE["feature_vector"] = with_base("""
SELECT id, date, sell_price, CAST(wday AS DOUBLE) AS wday, CAST(month AS DOUBLE) AS month, CAST(year AS DOUBLE) AS year,
       CAST(is_weekend AS DOUBLE) AS is_weekend, CAST(is_holiday AS DOUBLE) AS is_holiday,
       CAST(snap_CA AS DOUBLE) AS "snap_CA", CAST(snap_TX AS DOUBLE) AS "snap_TX", CAST(snap_WI AS DOUBLE) AS "snap_WI",
       lag_7, lag_14, lag_28, rolling_7_avg, rolling_30_avg, CAST(sales AS DOUBLE) AS sales,
       CASE WHEN date <= (SELECT max(date) FROM feats) - 30 THEN 'train' ELSE 'validation' END AS split
FROM feats""", extra=_FEATS)
ORACLE["forecast_record"] = with_fc(f"""
SELECT p.*, m.rmse, m.mae, m.r2 FROM (
    SELECT date, 'Historical' AS type, CAST(total_units AS DOUBLE) AS sales, total_revenue AS revenue
    FROM ({_gold_sql('gold_daily_sales', 'hist_category')}) WHERE date >= (SELECT max(date) FROM hist_category) - 90
    UNION ALL
    SELECT date, 'Forecasted', CAST(total_units AS DOUBLE), total_revenue FROM ({_FC_DAILY})) p,
    ({_RULE_METRICS}) m""", extra=_FEATS)
ORACLE["backtest_metrics"] = with_base("""
SELECT CAST(date_diff('day', (SELECT m FROM bt_last), b.date) AS INTEGER) AS step, b.date, count(*) AS rows,
       CAST(sum(coalesce(a.sales, 0)) AS BIGINT) AS actual_units, CAST(sum(b.sales) AS BIGINT) AS forecast_units,
       round(sqrt(avg(CAST((b.sales - coalesce(a.sales, 0)) AS DOUBLE) ^ 2)), 6) AS rmse,
       round(avg(abs(CAST(b.sales - coalesce(a.sales, 0) AS DOUBLE))), 6) AS mae
FROM bt b LEFT JOIN hist_category a ON a.id = b.id AND a.date = b.date
GROUP BY b.date""", extra=_recursion("bt", "m - 30"), recursive=True)


def _fmt_summary(fc_name: str) -> str:
    return f"""
summ AS (
  SELECT t.total_revenue, t.total_units, tc.cat_id AS top_category, ts.store_id AS top_store,
         ts.state_id AS top_store_state, tt.state_id AS top_state,
         f.forecast_revenue, f.forecast_units, f.forecast_days,
         CASE WHEN f.forecast_days > 0 THEN CAST(f.forecast_units AS DOUBLE) / f.forecast_days ELSE 0.0 END
           AS mean_daily_units
  FROM (SELECT CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue, CAST(sum(sales) AS BIGINT) AS total_units
        FROM hist_category) t,
       (SELECT cat_id FROM hist_category GROUP BY cat_id ORDER BY sum(revenue_cents) DESC, cat_id LIMIT 1) tc,
       (SELECT store_id, state_id FROM hist_category GROUP BY store_id, state_id
        ORDER BY sum(revenue_cents) DESC, store_id LIMIT 1) ts,
       (SELECT state_id FROM hist_category GROUP BY state_id ORDER BY sum(revenue_cents) DESC, state_id LIMIT 1) tt,
       (SELECT CAST(sum(revenue_cents) AS DOUBLE) / 100.0 AS forecast_revenue,
               CAST(sum(sales) AS BIGINT) AS forecast_units, count(DISTINCT date) AS forecast_days FROM {fc_name}) f),
summary AS (
  SELECT *, 'HISTORICAL GENERAL METRICS:' || chr(10)
    || '- Total Revenue: $' || format('{{:,.2f}}', total_revenue) || chr(10)
    || '- Total Units Sold: ' || format('{{:,}}', total_units) || chr(10)
    || '- Top Category: ' || top_category || chr(10)
    || '- Top Performing Store: ' || top_store || ' (located in state ' || top_store_state || ')' || chr(10)
    || '- Top Performing State: ' || top_state || chr(10) || chr(10)
    || 'FUTURE 30-DAY FORECAST METRICS:' || chr(10)
    || '- Forecasted Total Revenue: $' || format('{{:,.2f}}', forecast_revenue) || chr(10)
    || '- Forecasted Units Sold: ' || format('{{:,}}', forecast_units) || chr(10)
    || '- Average Forecasted Daily Sales: ' || format('{{:.1f}}', mean_daily_units) || ' units' || chr(10)
    AS summary
  FROM summ)"""


ORACLE["kpi_summary"] = with_fc("SELECT * FROM summary", extra=_fmt_summary("fc"))
_TOP = ("SELECT string_agg(item_id, ', ' ORDER BY total_revenue DESC, item_id) FROM "
        f"(SELECT * FROM ({_PROD}) ORDER BY total_revenue DESC, item_id LIMIT 5)")
_WORST = ("SELECT string_agg(item_id, ', ' ORDER BY total_revenue DESC, item_id) FROM "
          f"(SELECT * FROM ({_PROD}) ORDER BY total_revenue ASC, item_id DESC LIMIT 5)")
ORACLE["kpi_summary_lists"] = with_fc(f"""
SELECT *, summary || '- Top Products: ' || top_products || chr(10) || '- Worst Products: ' || worst_products
          || chr(10) || '- Categories: ' || categories || chr(10) AS summary_lists
FROM (SELECT *, ({_TOP}) AS top_products,
             ({_WORST}) AS worst_products,
             (SELECT string_agg(cat_id, ', ' ORDER BY cat_id) FROM (SELECT DISTINCT cat_id FROM hist_category))
               AS categories
      FROM summary)""", extra=_fmt_summary("fc"))
_RULE_LINE = "=" * 51
ORACLE["question_context"] = with_fc(f"""
SELECT q.conv_id, q.turn,
  'Here is the Gold Layer Business KPI and Forecasting Summary for our stores:' || chr(10)
  || '{_RULE_LINE}' || chr(10) || s.summary || chr(10) || '{_RULE_LINE}' || chr(10) || chr(10)
  || 'User Question: ' || q.text || chr(10) || 'Assistant Response:' AS prompt
FROM conversations q, summary s WHERE q.role = 'user'""", extra=_fmt_summary("fc"))

# --- data quality ----------------------------------------------------------------------

_PROFILE_COLUMNS = ["id", "item_id", "store_id", "state_id", "cat_id", "date", "sales", "wm_yr_wk",
                    "price_cents", "revenue_cents"]
ORACLE["profile_table"] = with_base("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"count(DISTINCT {c}) AS \"distinct\", CAST(min({c}) AS VARCHAR) AS \"min\", "
    f"CAST(max({c}) AS VARCHAR) AS \"max\" FROM fact_item" for c in _PROFILE_COLUMNS))
_CHECKS = {
    "sales_outside_calendar": "SELECT count(*) FROM sales_raw s WHERE NOT EXISTS "
                              "(SELECT 1 FROM cal c WHERE c.date = s.date)",
    "sales_without_price": "SELECT count(*) FROM sales_raw s LEFT JOIN cal c ON c.date = s.date WHERE NOT EXISTS "
                           "(SELECT 1 FROM prices_item p WHERE p.store_id = s.store_id AND p.item_id = s.item_id "
                           "AND p.wm_yr_wk = c.wm_yr_wk)",
    "duplicate_series_day": "SELECT count(*) FROM (SELECT id, date FROM sales_raw GROUP BY ALL HAVING count(*) > 1)",
    "null_sales": "SELECT count(*) FROM sales_raw WHERE sales IS NULL",
    "negative_sales": "SELECT count(*) FROM sales_raw WHERE sales < 0",
    "nonpositive_or_null_price": "SELECT count(*) FROM prices_item WHERE NOT (coalesce(sell_price, 0) > 0)",
    "duplicate_price_key": "SELECT count(*) FROM (SELECT store_id, item_id, wm_yr_wk FROM prices_item "
                           "GROUP BY ALL HAVING count(*) > 1)",
    "duplicate_calendar_day": "SELECT count(*) FROM (SELECT date FROM cal GROUP BY date HAVING count(*) > 1)",
    "lineitem_unknown_part": "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)",
    "lineitem_unknown_supplier": "SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN "
                                 "(SELECT s_suppkey FROM supplier)",
    "lineitem_duplicate_key": "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
                              "GROUP BY ALL HAVING count(*) > 1)",
}
ORACLE["quality_report"] = with_base("\nUNION ALL\n".join(
    f"SELECT '{k}' AS \"check\", ({v}) AS failed_rows" for k, v in _CHECKS.items()), extra="""
sales_raw AS (SELECT item_id || '_' || store_id || '_validation' AS id, store_id, item_id, date, qty AS sales
              FROM lines)""")

# --- the batch job on exported CSV files: readiness counts ---------------------------
# The wide file holds every category x store series over every calendar day up to the
# last sale (zeros kept); the job melts it, keeps days whose (store, item, week) has a
# price, drops each series' first 28 rows and forecasts 30 days per remaining series.

_JOB = f"""
job_series AS (SELECT DISTINCT {KEYS} FROM daily_category),
job_dense AS (
  SELECT s.*, c.date, c.wm_yr_wk FROM job_series s CROSS JOIN cal c
  WHERE c.date <= (SELECT max(date) FROM daily_category)),
job_priced AS (
  SELECT d.*, p.sell_price FROM job_dense d JOIN prices_category p
    ON p.store_id = d.store_id AND p.item_id = d.item_id AND p.wm_yr_wk = d.wm_yr_wk
  WHERE p.sell_price > 0)"""
ORACLE["csv_integrated"] = with_base("""
SELECT j.id, j.item_id, j.dept_id, j.cat_id, j.store_id, j.state_id, j.date, coalesce(d.sales, 0) AS sales,
       j.wm_yr_wk, c.weekday, c.wday, c.month, c.year, c.d, coalesce(c.event_name_1, '') AS event_name_1,
       coalesce(c.event_type_1, '') AS event_type_1, coalesce(c.event_name_2, '') AS event_name_2,
       coalesce(c.event_type_2, '') AS event_type_2, c.snap_CA, c.snap_TX, c.snap_WI, j.sell_price,
       CAST(round(j.sell_price * 100) AS BIGINT) AS price_cents,
       coalesce(d.sales, 0) * CAST(round(j.sell_price * 100) AS BIGINT) AS revenue_cents,
       CAST(coalesce(d.sales, 0) * CAST(round(j.sell_price * 100) AS BIGINT) AS DOUBLE) / 100.0 AS revenue
FROM job_priced j JOIN cal c ON c.date = j.date LEFT JOIN daily_category d ON d.id = j.id AND d.date = j.date""",
                                    extra=_JOB)
ORACLE["silver_clustering"] = with_base("""
SELECT count(*) AS rows, count(DISTINCT id) AS keys, CAST(0 AS BIGINT) AS keys_in_several_files,
       CAST(0 AS BIGINT) AS rows_out_of_order FROM fact_category""")
ORACLE["status_ready"] = with_base("""
SELECT 'ready' AS status, CAST(6 AS BIGINT) AS tables_ready, true AS model, true AS has_rmse, true AS has_mae,
       count(*) > 0 AS better_than_mean FROM lineitem""")
_CONTRACT = {
    "calendar": "date:date wm_yr_wk:int weekday:string wday:int month:int year:int d:string event_name_1:string "
                "event_type_1:string event_name_2:string event_type_2:string snap_CA:int snap_TX:int snap_WI:int",
    "prices": "store_id:string item_id:string wm_yr_wk:int sell_price:double"}
_SOURCE = {"calendar": "cal", "prices": "prices_item"}
ORACLE["schema_report"] = with_base("\nUNION ALL\n".join(
    f"SELECT '{name}' AS input, '{c}' AS \"column\", '{t}' AS expected, '{t}' AS actual, 'ok' AS status, "
    f"count(*) FILTER ({c} IS NULL) AS nulls FROM {_SOURCE[name]}"
    for name, columns in _CONTRACT.items() for c, t in (x.split(":") for x in columns.split())))

ORACLE["table_status"] = with_base("""
SELECT 'gold' AS layer, 'gold_daily_sales' AS "table", true AS "exists", count(DISTINCT date) AS rows FROM job_hist
UNION ALL SELECT 'gold', 'gold_store_performance', true, count(DISTINCT (store_id, state_id)) FROM job_hist
UNION ALL SELECT 'gold', 'gold_product_performance', true, count(DISTINCT (item_id, dept_id, cat_id)) FROM job_hist
UNION ALL SELECT 'gold', 'gold_category_sales', true, count(DISTINCT cat_id) FROM job_hist
UNION ALL SELECT 'gold', 'gold_state_sales', true, count(DISTINCT state_id) FROM job_hist
UNION ALL SELECT 'gold', 'gold_forecast_results', true, 30 * count(DISTINCT id) FROM job_hist
UNION ALL SELECT 'models', 'evaluation_metrics', true, CAST(1 AS BIGINT)
UNION ALL SELECT 'models', 'gbt_forecaster', false, CAST(0 AS BIGINT)
UNION ALL SELECT 'status', 'pending_etl', false, CAST(0 AS BIGINT)""", extra=f"""
job_series AS (SELECT DISTINCT {KEYS} FROM daily_category),
job_dense AS (
  SELECT s.*, c.date, c.wm_yr_wk FROM job_series s CROSS JOIN cal c
  WHERE c.date <= (SELECT max(date) FROM daily_category)),
job_priced AS (
  SELECT d.* FROM job_dense d JOIN prices_category p
    ON p.store_id = d.store_id AND p.item_id = d.item_id AND p.wm_yr_wk = d.wm_yr_wk
  WHERE p.sell_price > 0),
job_hist AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS rn FROM job_priced) WHERE rn > 28)""")

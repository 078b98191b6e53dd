"""DuckDB SQL that repeats each registered query on the same tables.

Shared subqueries are kept as named parts; ``_with`` puts the ones a query needs in front.
"""

from __future__ import annotations

import re

from tillwise.config import (
    EVENT_FLAGS, EVENT_TYPES, FEATURES, LAGS, MAJOR_HOLIDAYS, NAMED_HOLIDAYS, ROLLING,
    SEGMENT_COLOURS, STATES,
)
from tillwise.operators.churn import CHURN_FEATURES
from tillwise.operators.forecast import DEPTH, HORIZON, SEED_LAGS
from tillwise.plans.model_queries import PURCHASE_AT, SPEND_AT
from tillwise.plans.queries import HIGH, LOW, TOP_N, WEIGHTS
from tillwise.sources.star import CALENDAR_AHEAD, STOCK_DAYS

(_R, _ALPHA, _A, _B), (_P, _Q, _V) = ([f"{v}::DOUBLE" for v in at] for at in (PURCHASE_AT, SPEND_AT))


def _money(amount: str) -> str:
    return f"(CAST(coalesce(sum(CAST(round_even(({amount}) * 10000, 0) AS BIGINT)), 0) AS DOUBLE) / 10000)"


def _r(*columns: str) -> str:
    """Rounded output columns, without negative zeros."""
    return ", ".join(f"round_even({c}, 6) + 0.0 AS {c}" for c in columns)


def _text(*names: str) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


def _slots(test: str, column: str) -> str:
    one, two = (test.replace("?", f"{column}_{i}") for i in (1, 2))
    return f"CAST(max(CASE WHEN {one} OR {two} THEN 1 ELSE 0 END) AS INTEGER)"


_UNIT_PRICE = (
    "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS DOUBLE) / 100"
)
_LABEL = (
    "upper(substr(cat_id, 1, 1)) || lower(substr(cat_id, 2)) || ' · Item ' || split_part(product_id, '_', 3)"
)

PARTS: dict[str, str] = {
    "store": """
SELECT s_suppkey AS supplier_id, state || '_' || n_regionkey AS store_id, state, n_regionkey
FROM (SELECT s_suppkey, n_regionkey,
        CASE n_regionkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'WI' END AS state
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    "product": """
SELECT item_id, cat_id, cat_id || '_' || (b % 7) AS dept_id, cat_id || '_' || (b % 7) || '_' || b AS product_id
FROM (SELECT p_partkey AS item_id, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS b,
        CASE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 3
          WHEN 0 THEN 'FOODS' WHEN 1 THEN 'HOBBIES' ELSE 'HOUSEHOLD' END AS cat_id
      FROM part)""",
    "sale": f"""
SELECT l_partkey AS item_id, store_id, state, CAST(l_shipdate AS DATE) AS date,
  CAST(l_quantity AS BIGINT) AS quantity, {_UNIT_PRICE} AS unit_price
FROM lineitem JOIN store ON l_suppkey = supplier_id""",
    "line": """
SELECT store_id || '_' || strftime(date, '%Y%m%d') AS order_id, product_id, cat_id, store_id,
  state, date AS order_date, CAST(date_trunc('week', date) AS DATE) AS week, quantity, unit_price
FROM sale JOIN product USING (item_id)""",
    "total": f"""
SELECT product_id, {_money('quantity * unit_price')} AS revenue FROM line GROUP BY product_id""",
    "top": f"""
SELECT product_id FROM total ORDER BY revenue DESC, product_id LIMIT {TOP_N}""",
    "top_product": "SELECT DISTINCT product_id, dept_id, cat_id FROM product JOIN top USING (product_id)",
    "weekly": f"""
SELECT product_id, store_id, week, CAST(sum(quantity) AS BIGINT) AS quantity,
  {_money('quantity * unit_price')} AS revenue,
  CAST(sum(CAST(round_even(unit_price * 10000, 0) AS BIGINT)) AS DOUBLE) / 10000 / count(unit_price) AS unit_price
FROM line GROUP BY product_id, store_id, week""",
    "weekly_top": "SELECT weekly.* FROM weekly JOIN top USING (product_id)",
    "grid": """
SELECT product_id, store_id, CAST(week AS DATE) AS week
FROM top
CROSS JOIN (SELECT DISTINCT store_id FROM store)
CROSS JOIN (SELECT unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS week FROM weekly_top)""",
    "dense": """
SELECT product_id, store_id, week, coalesce(quantity, 0) AS quantity, coalesce(revenue, 0) AS revenue,
  nullif(coalesce(unit_price, 0), 0) AS known
FROM grid LEFT JOIN weekly_top USING (product_id, store_id, week)""",
    "filled": """
SELECT product_id, store_id, week, quantity, revenue, coalesce(
  last_value(known IGNORE NULLS) OVER (PARTITION BY product_id, store_id ORDER BY week
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(known IGNORE NULLS) OVER (PARTITION BY product_id, store_id ORDER BY week
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS unit_price
FROM dense""",
    "product_median": "SELECT product_id, quantile_cont(unit_price, 0.5) AS m FROM filled GROUP BY product_id",
    "panel": """
SELECT product_id, store_id, week, quantity, revenue, coalesce(unit_price, m) AS unit_price
FROM filled JOIN product_median USING (product_id)""",
    # ---- calendar
    "day": f"""
SELECT date,
  CASE WHEN month = 1 AND day = 1 THEN 'NewYear' WHEN month = 1 AND day = 7 THEN 'OrthodoxChristmas'
    WHEN month = 2 AND wd = 7 AND nth = 1 THEN 'SuperBowl' WHEN month = 4 AND wd = 7 AND nth = 2 THEN 'Easter'
    WHEN month = 5 AND wd = 7 AND nth = 2 THEN 'Mother''s day' WHEN month = 6 AND wd = 7 AND nth = 3 THEN 'NBAFinalsEnd'
    WHEN month = 7 AND day = 4 THEN 'IndependenceDay' WHEN month = 9 AND wd = 1 AND nth = 1 THEN 'LaborDay'
    WHEN month = 10 AND day = 31 THEN 'Halloween' WHEN month = 11 AND wd = 4 AND nth = 4 THEN 'Thanksgiving'
    WHEN month = 12 AND day = 25 THEN 'Christmas' END AS event_name_1,
  CASE WHEN month = 1 AND day = 1 THEN 'National' WHEN month = 1 AND day = 7 THEN 'Religious'
    WHEN month = 2 AND wd = 7 AND nth = 1 THEN 'Sporting' WHEN month = 4 AND wd = 7 AND nth = 2 THEN 'Religious'
    WHEN month = 5 AND wd = 7 AND nth = 2 THEN 'Cultural' WHEN month = 6 AND wd = 7 AND nth = 3 THEN 'Sporting'
    WHEN month = 7 AND day = 4 THEN 'National' WHEN month = 9 AND wd = 1 AND nth = 1 THEN 'National'
    WHEN month = 10 AND day = 31 THEN 'Cultural' WHEN month = 11 AND wd = 4 AND nth = 4 THEN 'National'
    WHEN month = 12 AND day = 25 THEN 'National' END AS event_type_1,
  CASE WHEN month = 4 AND wd = 7 AND nth = 2 AND day % 2 = 0 THEN 'OrthodoxEaster'
    WHEN month = 6 AND wd = 7 AND nth = 3 THEN 'Father''s day' END AS event_name_2,
  CASE WHEN month = 4 AND wd = 7 AND nth = 2 AND day % 2 = 0 THEN 'Religious'
    WHEN month = 6 AND wd = 7 AND nth = 3 THEN 'Cultural' END AS event_type_2,
  {', '.join(f"CAST(day BETWEEN {1 + 2 * i} AND {10 + 2 * i} AS INTEGER) AS snap_{s}" for i, s in enumerate(STATES))}
FROM (SELECT date, month(date) AS month, day(date) AS day, isodow(date) AS wd, (day(date) + 6) // 7 AS nth
  FROM (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)),
      max(CAST(l_shipdate AS DATE)) + {CALENDAR_AHEAD}, INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem))""",
    "week_event": f"""
SELECT CAST(date_trunc('week', date) AS DATE) AS week,
  CAST(count(event_name_1) + count(event_name_2) AS INTEGER) AS n_events,
  {_slots(f"? IN ({_text(*MAJOR_HOLIDAYS)})", 'event_name')} AS has_major_holiday,
  {', '.join(f"{_slots(f'? = {_text(t)}', 'event_type')} AS {n}" for n, t in EVENT_TYPES.items())},
  {', '.join(f"{_slots(f'contains(?, {_text(t)})', 'event_name')} AS {n}" for n, t in NAMED_HOLIDAYS.items())},
  {', '.join(f"CAST(sum(snap_{s}) AS INTEGER) AS snap_days_{s}" for s in STATES)}
FROM day GROUP BY 1""",
    "calendar": """
SELECT * EXCLUDE (place, last), CAST(coalesce((place - last) * 7, 365) AS INTEGER) AS days_since_last_event
FROM (SELECT *, max(CASE WHEN has_event = 1 THEN place END) OVER (ORDER BY week) AS last,
    CAST(month(week + 7) <> month(week) AS INTEGER) AS is_month_end,
    lead(has_major_holiday, 1, 0) OVER (ORDER BY week) AS event_week_before,
    lag(has_major_holiday, 1, 0) OVER (ORDER BY week) AS event_week_after
  FROM (SELECT *, CAST(n_events > 0 AS INTEGER) AS has_event, row_number() OVER (ORDER BY week) AS place
    FROM week_event))""",
    # ---- features
    "windowed": f"""
SELECT *,
  {', '.join(f'CAST(lag(quantity, {k}) OVER s AS DOUBLE) AS lag_{k}' for k in LAGS)},
  {', '.join(f'''avg(quantity) OVER (s ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS rolling_mean_{w},
  coalesce(stddev_samp(quantity) OVER (s ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0) AS rolling_std_{w}''' for w in ROLLING)},
  least(greatest(avg(quantity) OVER (s ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
    / nullif(avg(quantity) OVER (s ROWS BETWEEN 56 PRECEDING AND 53 PRECEDING) + 1e-6, 0)
    + CASE WHEN avg(quantity) OVER (s ROWS BETWEEN 56 PRECEDING AND 53 PRECEDING) IS NULL THEN NULL ELSE 0 END, 0), 5) AS yoy_raw,
  avg(quantity) OVER (s ROWS BETWEEN 56 PRECEDING AND 53 PRECEDING) AS year_ago,
  lag(unit_price, 1) OVER s AS price_lag_1,
  (unit_price - lag(unit_price, 1) OVER s) / (lag(unit_price, 1) OVER s + 1e-6) AS price_change,
  unit_price / (quantile_cont(unit_price, 0.5) OVER (s ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) + 1e-6) AS ratio_raw,
  CAST(row_number() OVER s - 1 AS INTEGER) AS weeks_since_start
FROM panel WINDOW s AS (PARTITION BY product_id, store_id ORDER BY week)""",
    "featured": """
SELECT * EXCLUDE (yoy_raw, ratio_raw, year_ago),
  CASE WHEN year_ago IS NOT NULL THEN yoy_raw END AS yoy_growth,
  CASE WHEN ratio_raw IS NOT NULL THEN least(greatest(ratio_raw, 0), 5) END AS price_vs_median_ratio
FROM windowed""",
    "code": """
SELECT product_id, dept_id, cat_id,
  CAST(dense_rank() OVER (ORDER BY product_id) - 1 AS INTEGER) AS product_encoded,
  CAST(dense_rank() OVER (ORDER BY cat_id) - 1 AS INTEGER) AS cat_encoded,
  CAST(dense_rank() OVER (ORDER BY dept_id) - 1 AS INTEGER) AS dept_encoded
FROM top_product""",
    "store_code": """
SELECT store_id, CAST(row_number() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_encoded
FROM (SELECT DISTINCT store_id FROM store)""",
    "feature": """
SELECT f.product_id, f.store_id, f.week, f.quantity, f.revenue, substr(f.store_id, 1, 2) AS state,
  c.dept_id, c.cat_id, lag_1, lag_2, lag_3, lag_4, coalesce(lag_8, 0) AS lag_8, coalesce(lag_12, 0) AS lag_12,
  coalesce(lag_52, 0) AS lag_52, rolling_mean_4, rolling_std_4, rolling_mean_8, rolling_std_8,
  rolling_mean_12, rolling_std_12, coalesce(yoy_growth, 1) AS yoy_growth,
  unit_price, price_lag_1, price_change, price_vs_median_ratio,
  CASE substr(f.store_id, 1, 2) WHEN 'CA' THEN snap_days_CA WHEN 'TX' THEN snap_days_TX ELSE snap_days_WI END AS snap_days,
  CAST(CASE substr(f.store_id, 1, 2) WHEN 'CA' THEN snap_days_CA WHEN 'TX' THEN snap_days_TX ELSE snap_days_WI END > 0 AS INTEGER) AS snap,
  k.* EXCLUDE (week),
  CAST(weekofyear(f.week) AS INTEGER) AS week_of_year, CAST(month(f.week) AS INTEGER) AS month,
  CAST(quarter(f.week) AS INTEGER) AS quarter, CAST(year(f.week) AS INTEGER) AS year,
  CAST(month(f.week) >= 10 AS INTEGER) AS is_q4, CAST(month(f.week) = 1 AS INTEGER) AS is_january,
  weeks_since_start, store_encoded, product_encoded, cat_encoded, dept_encoded
FROM (SELECT *, count(*) OVER (PARTITION BY product_id, store_id) AS n FROM featured WHERE lag_4 IS NOT NULL) f
LEFT JOIN calendar k ON f.week = k.week LEFT JOIN code c ON f.product_id = c.product_id
LEFT JOIN store_code s ON f.store_id = s.store_id
WHERE n >= 52""",
    # ---- items and daily sales
    "daily": """
SELECT item_id, store_id, date, CAST(date_trunc('week', date) AS DATE) AS week,
  CAST(sum(quantity) AS BIGINT) AS quantity,
  CAST(floor(date_diff('day', DATE '1995-01-02', date) / 200.0) AS INTEGER) AS chunk
FROM sale GROUP BY item_id, store_id, date""",
    "price": """
SELECT store_id, item_id, CAST(date_trunc('week', date) AS DATE) AS week, max(unit_price) AS sell_price
FROM sale GROUP BY 1, 2, 3""",
    "gappy_price": """
SELECT * FROM price
WHERE item_id % 7 <> 0 AND (item_id + date_diff('day', DATE '1994-01-03', week) // 7) % 5 <> 0""",
    "item_filled": """
SELECT d.*, coalesce(sell_price, quantile_cont(sell_price, 0.5) OVER (PARTITION BY store_id, chunk, item_id)) AS p
FROM daily d LEFT JOIN gappy_price USING (store_id, item_id, week)""",
    "known_sale": """
SELECT d.*, sell_price AS unit_price FROM daily d JOIN price USING (store_id, item_id, week)""",
    "priced": """
SELECT store_id, item_id, date, chunk, quantity,
  coalesce(p, quantile_cont(p, 0.5) OVER (PARTITION BY store_id, chunk)) AS unit_price
FROM item_filled""",
    # ---- inventory
    "inventory": """
SELECT f.product_id, f.store_id, avg(f.quantity) AS avg_weekly_qty, any_value(f.cat_id) AS cat_id,
  any_value(f.dept_id) AS dept_id
FROM feature f WHERE f.week >= (SELECT max(week) FROM feature) - 56 GROUP BY f.product_id, f.store_id""",
    "cover": """
SELECT *, CASE WHEN weeks_to_stockout <= 2 THEN 'Critical' WHEN weeks_to_stockout <= 4 THEN 'Warning' ELSE 'Safe' END AS status
FROM (SELECT *, round_even(current_stock / avg_weekly_qty, 1) AS weeks_to_stockout
  FROM (SELECT inventory.*, coalesce(units, 0) AS current_stock
    FROM inventory LEFT JOIN open_stock USING (product_id, store_id) WHERE avg_weekly_qty >= 1))""",
    "open_stock": f"""
SELECT product_id, store_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS units
FROM lineitem JOIN store ON l_suppkey = supplier_id JOIN product ON l_partkey = item_id
WHERE l_linestatus = 'O' AND CAST(l_shipdate AS DATE) > (SELECT max(CAST(l_shipdate AS DATE)) - {STOCK_DAYS} FROM lineitem)
GROUP BY product_id, store_id""",
    "panel_price": """
SELECT t.*, median_price, price_min, price_max FROM top_product t LEFT JOIN (
  SELECT product_id, quantile_cont(unit_price, 0.5) AS median_price, min(unit_price) AS price_min,
    max(unit_price) AS price_max
  FROM panel WHERE quantity > 0 GROUP BY product_id) USING (product_id)""",
    # ---- customers
    "bill": f"""
SELECT o_custkey AS customer_id, o_orderkey AS invoice, o_orderdate AS invoice_date, c_nationkey AS country,
  {_money('l_quantity * (' + _UNIT_PRICE + ')')} AS revenue, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS items, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
WHERE l_quantity > 0 AND {_UNIT_PRICE} > 0 AND o_custkey IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "base": f"""
SELECT customer_id, count(DISTINCT invoice) AS frequency, {_money('revenue')} AS monetary,
  CAST(sum(items) AS BIGINT) AS total_items, CAST(count(DISTINCT country) AS INTEGER) AS countries,
  CAST(date_diff('day', max(invoice_date), (SELECT max(invoice_date) FROM bill) + INTERVAL 7 DAY) AS INTEGER) AS recency,
  {_money('revenue')} / CAST(sum(lines) AS BIGINT) AS avg_order_value,
  greatest(date_diff('day', min(invoice_date), max(invoice_date)) / 7.0::DOUBLE, 1) AS lifespan_weeks,
  count(DISTINCT invoice) / greatest(date_diff('day', min(invoice_date), max(invoice_date)) / 7.0::DOUBLE, 1) AS weekly_purchase_rate
FROM bill GROUP BY customer_id""",
    "score": """
SELECT *, CAST(R * 100 + F * 10 + M AS INTEGER) AS rfm_score, CAST(R + F + M AS INTEGER) AS rfm_total
FROM (SELECT base.*,
    CAST(5 - (recency > e[1])::INT - (recency > e[2])::INT - (recency > e[3])::INT - (recency > e[4])::INT AS INTEGER) AS R,
    CAST(least(5, greatest(1, ceil(5.0 * (row_number() OVER (ORDER BY frequency, customer_id) - 1) / (count(*) OVER () - 1)))) AS INTEGER) AS F,
    CAST(least(5, greatest(1, ceil(5.0 * (row_number() OVER (ORDER BY monetary, customer_id) - 1) / (count(*) OVER () - 1)))) AS INTEGER) AS M
  FROM base, (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM base))""",
    "segmented": """
SELECT *, CASE WHEN R >= 4 AND F >= 4 AND M >= 4 THEN 'Champions' WHEN R >= 3 AND F >= 3 THEN 'Loyal customers'
  WHEN R >= 4 AND F <= 2 THEN 'New customers' WHEN R >= 3 AND F >= 2 AND M >= 3 THEN 'Potential loyalists'
  WHEN R = 2 AND F >= 2 THEN 'At risk' WHEN R <= 2 AND F >= 3 THEN 'Cannot lose them'
  WHEN R <= 2 AND F <= 2 AND M <= 2 THEN 'Lost' ELSE 'Needs attention' END AS segment
FROM score""",
    "person": """
SELECT *, CASE WHEN churn_risk_score < 0.25 THEN 'Low' WHEN churn_risk_score < 0.5 THEN 'Medium'
  WHEN churn_risk_score < 0.75 THEN 'High' ELSE 'Critical' END AS churn_risk
FROM (SELECT *, round_even(recency / (recency + 90.0::DOUBLE), 3) AS churn_risk_score,
  round_even(weekly_purchase_rate * avg_order_value * 52 / 1.1::DOUBLE, 2) AS clv_projected_12m FROM segmented)""",
    # ---- revenue
    "store_day": f"""
SELECT store_id, state, order_date AS day, week, {_money('quantity * unit_price')} AS revenue
FROM line GROUP BY 1, 2, 3, 4""",
    "week_revenue": f"SELECT week, {_money('revenue')} AS revenue FROM store_day GROUP BY week",
    "month_revenue": f"""
SELECT CAST(date_trunc('month', day) AS DATE) AS month, {_money('revenue')} AS revenue FROM store_day GROUP BY 1""",
}


def _terms(weights: dict[str, float]) -> str:
    return " + ".join(f"{w}::DOUBLE * {c}" for c, w in weights.items())


def _forecast_parts(rolling: str) -> dict[str, str]:
    """One subquery per step; each adds that step's prediction to the series' row."""
    own = lambda p: f"CASE state WHEN 'TX' THEN {p}TX WHEN 'WI' THEN {p}WI ELSE {p}CA END"
    parts = {
        "seed": """
SELECT f.* FROM feature f JOIN (SELECT product_id, store_id, max(week) AS week FROM feature GROUP BY 1, 2)
USING (product_id, store_id, week)""",
        "past": """
SELECT product_id, store_id, list(CAST(quantity AS DOUBLE) ORDER BY week DESC) AS q FROM feature GROUP BY 1, 2""",
        "mean_snap": f"SELECT {', '.join(f'avg(snap_{s}) * 7 AS mean_{s}' for s in STATES)} FROM day",
        "step_0": "SELECT seed.*, q, mean_snap.* FROM seed JOIN past USING (product_id, store_id) CROSS JOIN mean_snap",
    }
    for step in range(1, HORIZON + 1):
        lag = {k: f"p{step - k}" if k < step else f"coalesce(q[{k - step + 1}], 0)" for k in LAGS}
        before = [f"p{i}" for i in range(step - 1, 0, -1)]
        before += [f"lag_{k}" for k in SEED_LAGS] if rolling == "seed_deque" else [f"q[{i}]" for i in range(1, DEPTH + 1)]
        before = before[:DEPTH]
        stats = {}
        for size in ROLLING:
            values = f"[{', '.join(before[:size])}]"
            spread = "stddev_pop" if rolling == "seed_deque" else "stddev_samp"
            stats[f"rolling_mean_{size}"] = f"list_avg({values})" if step > 1 else f"rolling_mean_{size}"
            stats[f"rolling_std_{size}"] = f"list_{spread}({values})" if step > 1 else f"rolling_std_{size}"
        terms = {f"lag_{k}": v for k, v in lag.items()} | stats | {
            "has_event": "coalesce(k.has_event, 0)",
            "snap_days": f"CASE WHEN k.week IS NULL THEN {own('mean_')} ELSE {own('k.snap_days_')} END",
            "price_vs_median_ratio": "price_vs_median_ratio" if step == 1 else "1.0::DOUBLE",
        }
        pred = " + ".join(f"{w}::DOUBLE * ({terms[c]})" for c, w in WEIGHTS.items())
        low = " + ".join(f"{w}::DOUBLE * ({'raw' if c == 'pred' else stats[c]})" for c, w in LOW.items())
        high = " + ".join(f"{w}::DOUBLE * ({'raw' if c == 'pred' else stats[c]})" for c, w in HIGH.items())
        mine = [c for c in FEATURES if c.startswith(("lag_", "rolling_", "price_vs"))]
        carried = ", ".join(["product_id", "store_id", "state", "q", "last_week", *(f"mean_{s}" for s in STATES), *mine])
        done = "".join(f", p{i}, o{i}" for i in range(1, step))
        parts[f"raw_{step}"] = f"""
SELECT t.* EXCLUDE (has_event, has_major_holiday, snap_days), {pred} AS raw, coalesce(k.has_event, 0) AS has_event,
  coalesce(k.has_major_holiday, 0) AS has_major_holiday, {terms['snap_days']} AS snap_days
FROM step_{step - 1} t LEFT JOIN calendar k ON k.week = last_week + {7 * step}"""
        if step == 1:
            parts["raw_1"] = f"""
SELECT t.* EXCLUDE (has_event, has_major_holiday, snap_days), t.week AS last_week, {pred} AS raw,
  coalesce(k.has_event, 0) AS has_event, coalesce(k.has_major_holiday, 0) AS has_major_holiday,
  {terms['snap_days']} AS snap_days
FROM step_0 t LEFT JOIN calendar k ON k.week = t.week + 7"""
        parts[f"step_{step}"] = f"""
SELECT {carried}{done}, greatest(raw, 0) AS p{step}, 0 AS has_event, 0 AS has_major_holiday, 0 AS snap_days,
  {{'forecast_week': last_week + {7 * step}, 'forecast_qty': round_even(greatest(raw, 0), 1),
    'forecast_lower': round_even(greatest({low}, 0), 1), 'forecast_upper': round_even(greatest(greatest(raw, 0), {high}), 1),
    'has_event_flag': has_event, 'has_major_holiday_flag': has_major_holiday,
    'snap_days': round_even(CAST(snap_days AS DOUBLE), 1)}} AS o{step}
FROM raw_{step}"""
    outs = ", ".join(f"o{i}" for i in range(1, HORIZON + 1))
    parts["forecast"] = f"""
SELECT product_id, store_id, o.forecast_week, o.forecast_qty, o.forecast_lower, o.forecast_upper, o.has_event_flag,
  o.has_major_holiday_flag, o.snap_days
FROM (SELECT product_id, store_id, unnest([{outs}]) AS o FROM step_{HORIZON})"""
    return parts


PARTS["valued"] = """
SELECT f.*, dept_id, cat_id, median_price, forecast_qty * median_price AS forecast_revenue,
  forecast_lower * median_price AS forecast_revenue_lower, forecast_upper * median_price AS forecast_revenue_upper
FROM forecast f LEFT JOIN panel_price USING (product_id)"""
PARTS["forecast_week_total"] = f"""
SELECT forecast_week, {_money('forecast_revenue')} AS revenue, {_money('forecast_revenue_lower')} AS revenue_lower,
  {_money('forecast_revenue_upper')} AS revenue_upper, CAST(row_number() OVER (ORDER BY forecast_week) AS INTEGER) AS step
FROM valued GROUP BY forecast_week"""
PARTS["store_cat"] = f"""
SELECT *, quantile_cont(qty, 0.5) OVER (PARTITION BY store_id, cat_id) AS median_qty,
  CAST(row_number() OVER (PARTITION BY store_id, cat_id ORDER BY forecast_week) AS INTEGER) AS step
FROM (SELECT store_id, cat_id, forecast_week, {_money('forecast_qty')} AS qty, {_money('forecast_lower')} AS qty_lower,
    {_money('forecast_upper')} AS qty_upper, {_money('forecast_revenue')} AS revenue
  FROM valued GROUP BY 1, 2, 3)"""
PARTS["scored"] = f"""
SELECT *, greatest(raw, 0) AS pred, greatest({_terms(LOW).replace('pred', 'raw')}, 0) AS pred_lo,
  greatest({_terms(HIGH).replace('pred', 'raw')}, 0) AS pred_hi
FROM (SELECT *, {_terms(WEIGHTS)} AS raw,
    CASE WHEN week <= DATE '1999-12-31' THEN 'Train' WHEN week <= DATE '2000-12-31' THEN 'Validation' ELSE 'Test' END AS split
  FROM feature)"""

SEED_DEQUE, TRUE_HISTORY = _forecast_parts("seed_deque"), _forecast_parts("true_history")


def _with(body: str, forecast: dict[str, str] = SEED_DEQUE) -> str:
    """Put the parts that ``body`` names, and those they name, in front of it."""
    parts, order = PARTS | forecast, []

    def need(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+\(?([a-z_0-9]+)", text):
            if name in parts and name not in order:
                need(parts[name])
                if name not in order:
                    order.append(name)

    need(body)
    heads = ",\n".join(f"{name} AS {'MATERIALIZED ' if name.startswith(('step_', 'feature', 'raw_')) else ''}({parts[name].strip()})" for name in order)
    return f"WITH {heads}\n{body.strip()}" if heads else body.strip()


_ERRORS = f"""count(*) AS rows, round_even(avg(abs(quantity - pred)), 6) AS mae,
  round_even(sqrt(avg((quantity - pred) * (quantity - pred))), 6) AS rmse,
  round_even(avg(CASE WHEN quantity > 0 THEN abs(quantity - pred) / quantity END) * 100, 6) AS mape,
  round_even(CASE WHEN var_pop(quantity) > 0 THEN 1 - avg((quantity - pred) * (quantity - pred)) / var_pop(quantity) END, 6) AS r2,
  round_even(avg(CAST(quantity >= pred_lo AND quantity <= pred_hi AS INTEGER)) * 100, 6) AS interval_coverage_80pct"""
_KEYS = "product_id, store_id, week"
_TEXT_LINES = """(SELECT CASE WHEN l_linenumber = 6 THEN 'flag' ELSE l_returnflag END AS flag,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity, l_extendedprice AS amount
  FROM lineitem) WHERE flag <> 'flag'"""
_ORDER_TX = f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'C' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS invoice,
  o_custkey AS customer_id, o_orderdate AS invoice_date,
  CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  {_UNIT_PRICE} AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_LINE_ITEM = """
SELECT p.store_id || '_' || strftime(p.date, '%Y%m%d') AS order_id, p.store_id, p.date AS order_date,
  p.item_id AS product_id, p.quantity, round_even(p.unit_price, 6) AS unit_price,
  round_even(p.quantity * p.unit_price, 6) AS total_line"""

ORACLES: dict[str, str] = {
    "scan_conform": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  round_even(o_totalprice, 6) AS total_amount, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority, 'store' AS channel
FROM orders WHERE o_orderdate IS NOT NULL""",
    "coerce_lines": f"""
SELECT flag, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS units, {_money('amount')} AS amount
FROM {_TEXT_LINES} AND quantity IS NOT NULL GROUP BY flag""",
    "coerce_rejects": f"SELECT count(*) FILTER (WHERE quantity IS NULL) AS quantity, 0::BIGINT AS amount FROM {_TEXT_LINES}",
    "run_summary": f"""
SELECT min(order_date) AS first_day, max(order_date) AS last_day, count(*) AS line_items,
  count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products, count(DISTINCT store_id) AS stores,
  {_money('quantity * unit_price')} AS revenue
FROM line""",
    "unpivot_sales": """
SELECT item_id, store_id, 'd_' || day(date) AS d, CAST(sum(quantity) AS BIGINT) AS quantity
FROM sale GROUP BY 1, 2, 3 HAVING sum(quantity) > 0""",
    "products": """
SELECT p_partkey AS product_id, p_brand AS dept_id, p_type AS cat_id, round_even(median_price, 6) AS median_price,
  price_min, price_max
FROM (SELECT DISTINCT p_partkey, p_brand, p_type FROM part) LEFT JOIN (
  SELECT item_id, quantile_cont(sell_price, 0.5) AS median_price, min(sell_price) AS price_min, max(sell_price) AS price_max
  FROM price GROUP BY item_id) ON p_partkey = item_id""",
    "stores": """
SELECT DISTINCT store_id, state, CASE state WHEN 'CA' THEN 'West' WHEN 'TX' THEN 'South' ELSE 'Midwest' END AS region
FROM store""",
    "price_impute": """
SELECT store_id, item_id, date, chunk, quantity, round_even(unit_price, 6) AS unit_price FROM priced""",
    "line_items": f"""{_LINE_ITEM}, event_name_1, event_type_1, snap_CA, snap_TX, snap_WI
FROM known_sale p LEFT JOIN day ON p.date = day.date""",
    "store_day_orders": f"""
SELECT store_id || '_' || strftime(date, '%Y%m%d') AS order_id, store_id, date AS order_date,
  round_even({_money('quantity * unit_price')}, 6) AS total_amount, CAST(sum(quantity) AS BIGINT) AS total_units,
  count(DISTINCT item_id) AS n_items
FROM known_sale GROUP BY store_id, date""",
    "top_products": f"""
SELECT l_partkey AS item_id, {_money('l_quantity * (' + _UNIT_PRICE + ')')} AS revenue
FROM lineitem GROUP BY 1 ORDER BY revenue DESC, item_id LIMIT 200""",
    "top_coverage": f"""
SELECT round_even(sum(CASE WHEN rn <= 200 THEN revenue END) / sum(revenue), 6) AS coverage
FROM (SELECT *, row_number() OVER (ORDER BY revenue DESC, item_id) AS rn
  FROM (SELECT l_partkey AS item_id, {_money('l_quantity * (' + _UNIT_PRICE + ')')} AS revenue FROM lineitem GROUP BY 1))""",
    "weekly_calendar": "SELECT * FROM calendar",
    "average_snap": f"SELECT {', '.join(f'round_even(avg(snap_{s}) * 7, 6) AS snap_days_{s}' for s in STATES)} FROM day",
    "weekly_agg": f"SELECT {_KEYS}, quantity, {_r('revenue', 'unit_price')} FROM weekly",
    "weekly_panel": f"SELECT {_KEYS}, quantity, {_r('revenue', 'unit_price')} FROM panel",
    "feat_lags": f"SELECT {_KEYS}, {', '.join(f'lag_{k}' for k in LAGS)} FROM featured",
    "feat_rolling": f"SELECT {_KEYS}, {_r(*[f'rolling_{s}_{w}' for w in ROLLING for s in ('mean', 'std')])} FROM featured",
    "feat_yoy": f"SELECT {_KEYS}, {_r('yoy_growth')} FROM featured",
    "feat_price": f"SELECT {_KEYS}, {_r('unit_price', 'price_lag_1', 'price_change', 'price_vs_median_ratio')} FROM featured",
    "feat_codes": f"SELECT *, {_LABEL} AS name FROM code",
    "demand_features": f"""
SELECT * REPLACE ({_r('revenue', *[f'rolling_{s}_{w}' for w in ROLLING for s in ('mean', 'std')],
    'yoy_growth', 'unit_price', 'price_lag_1', 'price_change', 'price_vs_median_ratio')})
FROM feature""",
    "temporal_splits": """
SELECT split, min(week) AS first_week, max(week) AS last_week, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS units
FROM scored GROUP BY split""",
    "inventory_base": f"SELECT product_id, store_id, {_r('avg_weekly_qty')}, cat_id, dept_id FROM inventory",
    "inventory_coverage": f"""
SELECT product_id, store_id, {_r('avg_weekly_qty')}, cat_id, dept_id, {_r('current_stock', 'weeks_to_stockout')}, status FROM cover""",
    "inventory_status": """
SELECT count(*) FILTER (WHERE status = 'Critical') AS critical, count(*) FILTER (WHERE status = 'Warning') AS warning,
  count(*) FILTER (WHERE status = 'Safe') AS safe, count(*) AS total,
  round_even(count(*) FILTER (WHERE status = 'Safe') / count(*) * 100, 1) AS safe_pct
FROM cover""",
    "category_cover": "SELECT cat_id, round_even(avg(weeks_to_stockout), 6) AS mean_weeks FROM cover GROUP BY cat_id",
    "critical_by_store": """
SELECT s.store_id, count(c.product_id) AS critical
FROM (SELECT DISTINCT store_id FROM store) s LEFT JOIN (SELECT * FROM cover WHERE status = 'Critical') c
ON s.store_id = c.store_id GROUP BY s.store_id""",
    "inventory_board": f"""
SELECT CAST(rank AS INTEGER) AS rank, product_id, {_LABEL} AS product, cat_id, store_id,
  weeks_to_stockout, round_even(avg_weekly_qty, 1) AS demand, round_even(round_even(avg_weekly_qty, 1) * 12, 0) AS demand_ahead,
  round_even(coalesce(median_price, 0), 6) AS price,
  CASE WHEN weeks_to_stockout <= 1 THEN 'CRITICAL' ELSE 'WARNING' END AS priority
FROM (SELECT c.*, median_price, row_number() OVER (ORDER BY weeks_to_stockout, c.product_id, store_id) AS rank
  FROM cover c LEFT JOIN panel_price p ON c.product_id = p.product_id WHERE status = 'Critical')
WHERE rank <= 20""",
    "clean_transactions": f"""
SELECT *, round_even(quantity * price, 6) AS revenue FROM ({_ORDER_TX})
WHERE customer_id IS NOT NULL AND quantity > 0 AND price > 0 AND NOT starts_with(invoice, 'C')""",
    "union_vintages": f"""
SELECT o_custkey AS customer_id, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS items,
  {_money('l_quantity * (' + _UNIT_PRICE + ')')} AS revenue, CAST(min(o_orderdate) AS DATE) AS first_day,
  CAST(max(o_orderdate) AS DATE) AS last_day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "rfm_base": f"""
SELECT customer_id, frequency, monetary, total_items, countries, recency,
  {_r('avg_order_value', 'lifespan_weeks', 'weekly_purchase_rate')} FROM base""",
    "rfm_scores": "SELECT customer_id, R, F, M, rfm_score, rfm_total FROM score",
    "rfm_segments": f"""
SELECT customer_id, recency, frequency, monetary, {_r('avg_order_value')}, total_items, R, F, M, rfm_score, rfm_total, segment
FROM segmented""",
    "segment_counts": """
SELECT segment, count(*) AS n, round_even(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS share_pct FROM segmented GROUP BY segment""",
    "repeat_summary": f"""
SELECT customer_id, count(*) - 1 AS frequency,
  CAST(date_diff('day', min(w), max(w)) AS DOUBLE) / 7 AS recency,
  CAST(date_diff('day', min(w), CAST(date_trunc('week', (SELECT max(invoice_date) FROM bill) + INTERVAL 7 DAY) AS DATE)) AS DOUBLE) / 7 AS T,
  round_even(coalesce((sum(spend) - arg_min(spend, w)) / nullif(count(*) - 1, 0), 0), 6) AS monetary_value
FROM (SELECT customer_id, CAST(date_trunc('week', invoice_date) AS DATE) AS w, {_money('revenue')} AS spend FROM bill GROUP BY 1, 2)
GROUP BY customer_id""",
    "clv_likelihood": f"""
SELECT * FROM (WITH x AS (
  SELECT CAST(count(*) - 1 AS DOUBLE) AS x, CAST(date_diff('day', min(w), max(w)) AS DOUBLE) / 7 AS recent,
    CAST(date_diff('day', min(w), CAST(date_trunc('week', (SELECT max(invoice_date) FROM bill) + INTERVAL 7 DAY) AS DATE)) AS DOUBLE) / 7 AS age,
    coalesce((sum(spend) - arg_min(spend, w)) / nullif(count(*) - 1, 0), 0) AS m
  FROM (SELECT customer_id, CAST(date_trunc('week', invoice_date) AS DATE) AS w, {_money('revenue')} AS spend FROM bill GROUP BY 1, 2)
  GROUP BY customer_id),
bought AS (
  SELECT avg(lgamma({_R} + x) - lgamma({_R}) + {_R} * ln({_ALPHA}) + lgamma({_A} + {_B}) + lgamma({_B} + x) - lgamma({_B}) - lgamma({_A} + {_B} + x)
    + ln(power({_ALPHA} + age, -({_R} + x)) + CASE WHEN x > 0 THEN {_A} / ({_B} + greatest(x, 1) - 1) * power({_ALPHA} + recent, -({_R} + x)) ELSE 0 END)) AS v
  FROM x),
spent AS (
  SELECT avg(lgamma({_P} * x + {_Q}) - lgamma({_P} * x) - lgamma({_Q}) + {_Q} * ln({_V}) + ({_P} * x - 1) * ln(m) + {_P} * x * ln(x)
    - ({_P} * x + {_Q}) * ln(x * m + {_V})) AS v
  FROM x WHERE x > 0 AND m > 0)
SELECT round_even((SELECT v FROM bought), 6) AS purchase, round_even((SELECT v FROM spent), 6) AS spend)""",
    "churn_folds": """
SELECT fold, churned, count(*) AS n FROM (SELECT CAST((row_number() OVER (ORDER BY churned, customer_id) - 1) % 5 AS INT) AS fold, churned FROM (
  SELECT customer_id, CAST(recency > 90 AS INTEGER) AS churned FROM base)) GROUP BY ALL""",
    "clv_linear": f"""
SELECT customer_id, monetary AS clv_historical, clv_projected_12m, 'linear_projection' AS clv_model_type,
  {_r('weekly_purchase_rate', 'lifespan_weeks')} FROM person""",
    "churn_tiers": """
SELECT churn_risk, count(*) AS n, round_even(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS share_pct FROM person GROUP BY 1""",
    "churn_label": """
SELECT customer_id, recency, CAST(recency > 90 AS INTEGER) AS churned FROM base""",
    "churn_features_std": f"""
SELECT customer_id, {', '.join(f'round_even(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}_std' for c in CHURN_FEATURES)}
FROM base""",
    "top_segments": f"""
SELECT segment, {_money('monetary')} AS revenue FROM person GROUP BY segment ORDER BY revenue DESC, segment LIMIT 5""",
    "store_names": """
SELECT DISTINCT store_id, store_id || ' — ' || CASE state WHEN 'CA' THEN 'California' WHEN 'TX' THEN 'Texas' ELSE 'Wisconsin' END
  || ' Store ' || n_regionkey AS name
FROM store""",
    "segment_board": f"""
SELECT segment, count(*) AS customers, {_money('monetary')} AS revenue,
  CASE segment {' '.join(f"WHEN '{s}' THEN '{c}'" for s, c in SEGMENT_COLOURS.items())} END AS colour
FROM person GROUP BY segment""",
    "customer_kpis": f"""
SELECT count(*) AS customers, round_even({_money('clv_projected_12m')} / count(*), 6) AS avg_clv,
  round_even(quantile_cont(clv_projected_12m, 0.5), 6) AS median_clv,
  count(*) FILTER (WHERE churn_risk IN ('High', 'Critical')) AS high_risk,
  {_money("CASE WHEN churn_risk IN ('High', 'Critical') THEN clv_projected_12m END")} AS revenue_at_risk,
  count(*) FILTER (WHERE segment = 'Champions') AS champions,
  {_money("CASE WHEN segment = 'Champions' THEN monetary END")} AS champions_revenue,
  'linear_projection' AS clv_model
FROM person""",
    "retention_quadrant": """
SELECT customer_id, segment, churn_risk_score, clv_projected_12m,
  CASE WHEN churn_risk_score >= 0.5 AND clv_projected_12m >= mid THEN 'Priority retention'
    WHEN churn_risk_score >= 0.5 THEN 'Deprioritise' WHEN clv_projected_12m >= mid THEN 'Keep engaged' ELSE 'Monitor' END AS quadrant
FROM (SELECT *, quantile_cont(clv_projected_12m, 0.5) OVER () AS mid
  FROM person WHERE clv_projected_12m < (SELECT quantile_cont(clv_projected_12m, 0.97) FROM person))""",
    "forecast_recursion": "SELECT * FROM forecast",
    "forecast_revenue": f"""
SELECT * REPLACE ({_r('median_price', 'forecast_revenue', 'forecast_revenue_lower', 'forecast_revenue_upper')}) FROM valued""",
    "forecast_weeks": f"""
SELECT forecast_week, {_r('revenue', 'revenue_lower', 'revenue_upper')}, step, 'W+' || step AS label FROM forecast_week_total""",
    "forecast_summary": f"""
SELECT round_even({_money('revenue')}, 6) AS total, round_even({_money('revenue')} / count(*), 6) AS weekly_mean,
  (SELECT step FROM forecast_week_total ORDER BY revenue DESC, step LIMIT 1) AS peak_week
FROM forecast_week_total""",
    "forecast_by_store_cat": f"""
SELECT store_id, cat_id, forecast_week, {_r('qty', 'qty_lower', 'qty_upper', 'revenue')}, step, {_r('median_qty')},
  round_even(greatest(qty, median_qty), 6) AS high_qty, round_even(qty - greatest(qty, median_qty), 6) + 0.0 AS base_qty
FROM store_cat""",
    "store_category_block": f"""
SELECT store_id, cat_id, round_even({_money('revenue')}, 6) AS revenue, round_even({_money('qty')} / count(*), 6) AS avg_qty,
  arg_max(step, qty * 1e6 - step) AS peak_week, CAST(count(*) AS INTEGER) AS weeks
FROM store_cat GROUP BY store_id, cat_id""",
    "top_forecast": f"""
SELECT product_id, cat_id, round_even(revenue, 6) AS revenue,
  CAST(row_number() OVER (ORDER BY revenue DESC, product_id) AS INTEGER) AS rank, {_LABEL} AS name
FROM (SELECT product_id, cat_id, {_money('forecast_revenue')} AS revenue FROM valued GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5)""",
    "forecast_metrics": f"SELECT split, {_ERRORS} FROM scored WHERE split <> 'Train' GROUP BY split",
    "category_metrics": f"SELECT cat_id, {_ERRORS} FROM scored WHERE split = 'Test' GROUP BY cat_id",
    "weekly_revenue": f"""
SELECT week, revenue, round_even((revenue - before) / before * 100, 6) AS wow_pct, strftime(week, '%d %b ''%y') AS label
FROM (SELECT *, lag(revenue) OVER (ORDER BY week) AS before
  FROM (SELECT week, {_money('quantity * unit_price')} AS revenue FROM line JOIN top USING (product_id) GROUP BY week))
ORDER BY week DESC LIMIT 52""",
    "weekly_revenue_all": """
SELECT week, revenue, round_even((revenue - before) / before * 100, 6) AS wow_pct, strftime(week, '%d %b ''%y') AS label
FROM (SELECT *, lag(revenue) OVER (ORDER BY week) AS before FROM week_revenue)""",
    "revenue_kpis": f"""
SELECT arg_max(revenue, week) AS this_week, round_even(arg_max((revenue - before) / before * 100, week), 6) AS wow_pct,
  {_money('revenue')} AS last_four_weeks
FROM (SELECT *, lag(revenue) OVER (ORDER BY week) AS before FROM week_revenue ORDER BY week DESC LIMIT 4)""",
    "monthly_revenue": """
SELECT month, revenue, round_even((revenue - before) / before * 100, 6) AS growth_pct, strftime(month, '%b ''%y') AS label
FROM (SELECT *, lag(revenue) OVER (ORDER BY month) AS before FROM month_revenue) ORDER BY month DESC LIMIT 24""",
    "region_share": f"""
SELECT state, revenue, round_even(revenue / sum(revenue) OVER () * 100, 1) AS share_pct
FROM (SELECT state, {_money('revenue')} AS revenue FROM store_day GROUP BY state)""",
    "revenue_grains": f"""
SELECT 'total' AS grain, NULL::VARCHAR AS state, NULL::DATE AS week, NULL::DATE AS month, {_money('revenue')} AS revenue FROM store_day
UNION ALL SELECT 'state', state, NULL, NULL, {_money('revenue')} FROM store_day GROUP BY state
UNION ALL SELECT 'week', NULL, week, NULL, revenue FROM week_revenue
UNION ALL SELECT 'month', NULL, NULL, month, revenue FROM month_revenue""",
    "stream_weekly": """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS n,
  CAST(sum(CAST(round_even(value * 100, 0) AS BIGINT)) AS DOUBLE) / 100 AS total
FROM events GROUP BY 1, 2""",
}
ORACLES = {name: _with(body) for name, body in ORACLES.items()}
ORACLES["forecast_true_history"] = _with("SELECT * FROM forecast", TRUE_HISTORY)

"""DuckDB SQL that computes each query's result independently.

Every statement starts from the supplied tables. Orders are counted with
COUNT(DISTINCT ...) here, as a check on the plain counts of the Spark plans.
"""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(c_custkey AS VARCHAR) AS customer_id,
         c_name AS customer_name,
         r_name AS region,
         c_mktsegment AS segment,
         s_name AS sales_rep,
         concat(p_name, ' ', CAST(p_partkey AS VARCHAR)) AS product_name,
         p_type AS product_category,
         CAST(l_quantity AS INT) AS quantity,
         CAST(ROUND(CAST(l_extendedprice / l_quantity AS DECIMAL(18,6)), 2) AS DECIMAL(18,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
              AS DECIMAL(18,2)) AS sales,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              * CAST(0.30 + (p_partkey % 76) / CAST(100 AS DOUBLE) AS DECIMAL(4,2)), 2)
              AS DECIMAL(18,2)) AS cost,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                     l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""


def _title(text: str) -> str:
    pieces = rf"regexp_extract_all(lower({text}), '([\p{{L}}]+|[^\p{{L}}]+)')"
    return f"array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || w[2:]), '')"


def _valid(raw: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) REPLACE (
           {_title("trim(region)")} AS region, {_title("trim(segment)")} AS segment,
           {_title("trim(sales_rep)")} AS sales_rep, {_title("trim(product_category)")} AS product_category),
         sales - cost AS profit
  FROM {raw}
  WHERE rn = 1 AND sales > 0 AND quantity > 0"""


def _derived(valid: str) -> str:
    return f"""
valid AS ({valid}
),
sales AS (
  SELECT *,
         CAST(year(order_date) AS INT) AS order_year,
         CAST(month(order_date) AS INT) AS order_month,
         CAST(quarter(order_date) AS INT) AS order_quarter,
         CAST(week(order_date) AS INT) AS order_week,
         dayname(order_date) AS order_dow,
         ROUND(CAST(profit / sales * 100 AS DECIMAL(18,6)), 2) AS profit_margin_pct,
         ROUND(CAST(sales / quantity AS DECIMAL(18,6)), 2) AS revenue_per_unit,
         CASE WHEN discount > 0 THEN 1 ELSE 0 END AS is_discounted,
         CASE WHEN profit > 0 THEN 1 ELSE 0 END AS is_profitable
  FROM valid
)"""


_SALES = _derived(_valid("raw"))

_CLEAN = """
  SELECT * REPLACE (
    strftime(order_date, '%Y-%m-%d') AS order_date, CAST(quantity AS DOUBLE) AS quantity,
    CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount,
    CAST(sales AS DOUBLE) AS sales, CAST(cost AS DOUBLE) AS cost, CAST(profit AS DOUBLE) AS profit,
    CAST(profit_margin_pct AS DOUBLE) AS profit_margin_pct,
    CAST(revenue_per_unit AS DOUBLE) AS revenue_per_unit)
  FROM sales"""

# The same with amounts and quantities scaled down.
_FINE = """
unscaled AS (SELECT * FROM raw),
raw_fine AS (
  SELECT * REPLACE (
    CAST(quantity AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS quantity,
    CAST(unit_price AS DECIMAL(18,2)) * CAST(0.000001 AS DECIMAL(7,6)) AS unit_price,
    CAST(sales AS DECIMAL(18,2)) * CAST(0.000001 AS DECIMAL(7,6)) AS sales,
    CAST(cost AS DECIMAL(18,2)) * CAST(0.000001 AS DECIMAL(7,6)) AS cost)
  FROM unscaled
)"""

# The same with a kind of damage in every twentieth order, and without sales_rep.
_DIRTY = """
dirty AS (
  SELECT * EXCLUDE (rn, sales_rep, okey) REPLACE (
           CASE okey % 20 WHEN 12 THEN NULL ELSE order_id END AS order_id,
           CASE okey % 20 WHEN 13 THEN NULL ELSE customer_id END AS customer_id,
           CASE okey % 20 WHEN 10 THEN upper(region) ELSE region END AS region,
           CASE okey % 20 WHEN 11 THEN '' ELSE segment END AS segment,
           CASE okey % 20 WHEN 0 THEN NULL WHEN 1 THEN -sales WHEN 2 THEN 0 ELSE sales END AS sales,
           CASE okey % 20 WHEN 3 THEN NULL WHEN 4 THEN 0 WHEN 5 THEN -1 ELSE quantity END AS quantity,
           CASE okey % 20 WHEN 6 THEN CAST(-0.1 AS DECIMAL(4,2)) WHEN 7 THEN CAST(1.5 AS DECIMAL(4,2))
                          WHEN 8 THEN NULL ELSE discount END AS discount),
         CASE okey % 20 WHEN 9 THEN NULL ELSE CAST(sales - cost AS DECIMAL(18,2)) END AS profit,
         ROW_NUMBER() OVER (PARTITION BY CASE okey % 20 WHEN 12 THEN NULL ELSE order_id END
                            ORDER BY okey, order_id, rn) AS n_same
  FROM (SELECT *, CAST(split_part(order_id, '-', 1) AS BIGINT) AS okey FROM raw)
)"""

_ORDERS = "COUNT(DISTINCT order_id)"
_CUSTOMERS = "COUNT(DISTINCT customer_id)"
_MARGIN = "CAST(ROUND(CAST(AVG(profit_margin_pct) AS DECIMAL(28,6)), 2) AS DOUBLE)"
_DISCOUNT = "CAST(ROUND(CAST(AVG(discount) AS DECIMAL(28,6)) * 100, 1) AS DOUBLE)"
_PER_ORDER = f"CAST(ROUND(CAST(SUM(sales) / {_ORDERS} AS DECIMAL(28,6)), 2) AS DOUBLE)"
_UNITS = "CAST(SUM(quantity) AS DOUBLE)"
_REVENUE = "CAST(ROUND(SUM(sales), 2) AS DOUBLE)"
_PROFIT = "CAST(ROUND(SUM(profit), 2) AS DOUBLE)"


def _from_sales(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([_RAW, _SALES, *ctes]) + body


_RFM = """
rfm AS (
  SELECT customer_id,
         CAST(date_diff('day', MAX(order_date), (SELECT MAX(order_date) FROM sales)) AS INT) AS recency_days,
         COUNT(DISTINCT order_id) AS frequency,
         SUM(sales) AS monetary
  FROM sales
  WHERE customer_id IS NOT NULL
  GROUP BY customer_id
)"""

_CUSTOMERS_RANKED = """
  SELECT customer_id, customer_name, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
         CASE WHEN recency_days <= 30 AND frequency >= 10 THEN 'Champions'
              WHEN recency_days <= 60 AND frequency >= 5 THEN 'Loyal'
              WHEN recency_days <= 90 THEN 'At Risk'
              ELSE 'Lost' END AS rfm_segment
  FROM (SELECT DISTINCT customer_id, customer_name FROM sales) LEFT JOIN rfm USING (customer_id)"""

_TREND = f"""
  SELECT order_year, order_month,
         {_ORDERS} AS total_orders, {_REVENUE} AS revenue, {_PROFIT} AS profit,
         {_MARGIN} AS avg_margin_pct, {_CUSTOMERS} AS unique_customers, {_PER_ORDER} AS avg_order_value
  FROM sales"""

_TOP = """
top AS (
  SELECT product_name, product_category, SUM(sales) AS total_revenue, SUM(profit) AS total_profit,
         ROUND(CAST(AVG(profit_margin_pct) AS DECIMAL(28,6)), 2) AS avg_margin_pct
  FROM sales
  GROUP BY product_name, product_category
  ORDER BY total_revenue DESC, product_name, product_category
  LIMIT 20
)"""


def _top_products(limit: int) -> str:
    return _from_sales(f"""
  SELECT product_name, product_category, {_UNITS} AS units_sold, {_ORDERS} AS order_count,
         {_REVENUE} AS total_revenue, {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct,
         {_DISCOUNT} AS avg_discount_pct
  FROM sales
  GROUP BY product_name, product_category
  ORDER BY SUM(sales) DESC, product_name, product_category
  LIMIT {limit}""")


def _weekly(series: str = "") -> str:
    by = f"{series}, " if series else ""
    return f"""
weekly AS (
  SELECT {by}CAST(date_trunc('week', order_date) AS DATE) AS week,
         SUM(sales) AS revenue,
         {_ORDERS} AS orders,
         CAST(AVG(sales) AS DECIMAL(28,6)) AS avg_order_value,
         {_CUSTOMERS} AS unique_customers,
         CAST(AVG(profit_margin_pct) AS DECIMAL(28,6)) AS avg_margin,
         CAST(SUM(is_discounted) AS BIGINT) AS discounted_orders
  FROM sales
  GROUP BY ALL
)"""


def _lagged(series: str = "") -> str:
    part = f"PARTITION BY {series} " if series else ""
    lags = ",\n         ".join(
        f"LAG({c}, {k}) OVER w AS {c}_lag{k}" for c in ("revenue", "orders") for k in (1, 2, 3, 4)
    )

    def moving(name: str, function: str, size: int) -> str:
        window = f"({part}ORDER BY week ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING)"
        return (
            f"CASE WHEN COUNT(*) OVER {window} = {size} "
            f"THEN CAST({function}(revenue) OVER {window} AS DECIMAL(28,6)) END AS {name}"
        )

    return f"""
lagged AS (
  SELECT *,
         {lags},
         {moving("revenue_ma4", "AVG", 4)},
         {moving("revenue_ma8", "AVG", 8)},
         {moving("revenue_std4", "STDDEV_SAMP", 4)},
         CAST(week(week) AS INT) AS week_of_year,
         CAST(month(week) AS INT) AS month,
         CAST(quarter(week) AS INT) AS quarter,
         CASE WHEN quarter(week) = 4 THEN 1 ELSE 0 END AS is_q4
  FROM weekly
  WINDOW w AS ({part}ORDER BY week)
),
panel AS (SELECT * FROM lagged WHERE revenue_ma8 IS NOT NULL)"""


_AMOUNTS = ("revenue", "avg_order_value", "avg_margin")
_PANEL_AMOUNTS = _AMOUNTS + tuple(f"revenue_lag{k}" for k in (1, 2, 3, 4)) + (
    "revenue_ma4",
    "revenue_ma8",
    "revenue_std4",
)


def _as_shown(columns: tuple[str, ...]) -> str:
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"* REPLACE ({doubles}, strftime(week, '%Y-%m-%d') AS week)"


_REQUIRED = ("order_id", "order_date", "customer_id", "product_name", "quantity",
             "unit_price", "discount", "sales", "profit")
_NULLS = f"""
nulls AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS n FROM checked" for c in _REQUIRED)})"""
_CHECKED = """
checked AS (SELECT *, CAST(sales - cost AS DECIMAL(18,2)) AS profit FROM raw),""" + _NULLS
_CHECKED_DIRTY = _DIRTY + """,
checked AS (SELECT *, n_same AS rn FROM dirty),""" + _NULLS
_FOUND = """,
found AS (
  SELECT 'null' AS "check", column_name, n FROM nulls
  UNION ALL SELECT 'negative', 'sales', COUNT(*) FILTER (sales < 0) FROM checked
  UNION ALL SELECT 'duplicate', 'order_id', COUNT(*) FILTER (rn > 1) FROM checked
)
  SELECT * FROM found WHERE n > 0"""

_SEGMENTS = ("Automobile", "Building", "Furniture", "Household", "Machinery")

# Eight further weeks by known weights, newest revenue first in the list.
_FORECAST = """
last_weeks AS (SELECT week, CAST(revenue AS DOUBLE) AS revenue FROM panel ORDER BY week DESC LIMIT 8),
steps AS (
  SELECT 0 AS step, (SELECT MAX(week) FROM last_weeks) AS week, CAST(NULL AS DOUBLE) AS revenue,
         (SELECT list(revenue ORDER BY week DESC) FROM last_weeks) AS past
  UNION ALL
  SELECT step + 1, week, revenue, list_prepend(revenue, past)[1:8]
  FROM (SELECT step, CAST(week + 7 AS DATE) AS week, past,
               0.5::DOUBLE * past[1] + 0.2::DOUBLE * past[2] + 0.2::DOUBLE * list_avg(past[1:4])
               + 0.1::DOUBLE * list_avg(past) + CASE WHEN quarter(week + 7) = 4 THEN 1000 ELSE 0 END AS revenue
        FROM steps WHERE step < 8)
),
predicted AS (
  SELECT week, CAST(revenue AS DECIMAL(28,2)) AS forecasted_revenue FROM steps WHERE step > 0
)"""


def _with_recursion(body: str) -> str:
    return _from_sales(body, _weekly(), _lagged(), _FORECAST).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES = {
    "forecast_fixed": _with_recursion("""
  SELECT strftime(week, '%Y-%m-%d') AS week, CAST(forecasted_revenue AS DOUBLE) AS forecasted_revenue FROM predicted"""),
    "forecast_fixed_summary": _with_recursion("""
  SELECT COUNT(*) AS forecast_weeks, CAST(SUM(forecasted_revenue) AS DOUBLE) AS total_forecasted_revenue,
         CAST(MIN(forecasted_revenue) AS DOUBLE) AS min_forecasted_revenue,
         CAST(MAX(forecasted_revenue) AS DOUBLE) AS max_forecasted_revenue
  FROM predicted"""),
    "holdout_metrics": _from_sales("""
  SELECT model, ROUND(mae, 2) AS mae, ROUND(rmse, 2) AS rmse, ROUND(r2, 6) AS r2,
         ROW_NUMBER() OVER (ORDER BY rmse, model) = 1 AS is_best
  FROM (
    SELECT model, AVG(abs(revenue - predicted)) AS mae, sqrt(AVG((revenue - predicted) ** 2)) AS rmse,
           1 - SUM((revenue - predicted) ** 2) / (var_pop(revenue) * COUNT(*)) AS r2
    FROM (
      SELECT CAST(revenue AS DOUBLE) AS revenue, unnest(['revenue_lag1', 'revenue_ma4', 'revenue_ma8']) AS model,
             unnest([CAST(revenue_lag1 AS DOUBLE), CAST(revenue_ma4 AS DOUBLE), CAST(revenue_ma8 AS DOUBLE)]) AS predicted
      FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY week) AS rn, COUNT(*) OVER () AS n FROM panel)
      WHERE rn > FLOOR(n * 0.8)
    ) GROUP BY model
  )""", _weekly(), _lagged()),
    "quality_nulls": "WITH " + _RAW + "," + _CHECKED + " SELECT column_name, n FROM nulls",
    "quality_report": "WITH " + _RAW + "," + _CHECKED + _FOUND,
    "quality_nulls_dirty": "WITH " + _RAW + "," + _CHECKED_DIRTY + " SELECT column_name, n FROM nulls",
    "quality_report_dirty": "WITH " + _RAW + "," + _CHECKED_DIRTY + _FOUND,
    "sales_clean_dirty": "WITH " + _RAW + "," + _DIRTY + "," + _derived("""
  SELECT * EXCLUDE (n_same) REPLACE (
           """ + ", ".join(f"{_title(c)} AS {c}" for c in ("region", "segment", "product_category")) + """,
           least(1, greatest(0, coalesce(discount, 0))) AS discount, coalesce(profit, 0) AS profit)
  FROM dirty WHERE n_same = 1 AND sales > 0 AND quantity > 0""") + _CLEAN,
    "sales_clean_fine": "WITH " + _RAW + "," + _FINE + "," + _derived(_valid("raw_fine")) + _CLEAN,
    "sales_clean": _from_sales(_CLEAN),
    "csv_round_trip": _from_sales(_CLEAN),
    "csv_mixed_headers": f"""
SELECT * EXCLUDE (part) REPLACE (
  CASE WHEN part <> 1 THEN region END AS region, CASE WHEN part <> 1 THEN cost END AS cost,
  CASE WHEN part <> 2 THEN segment END AS segment)
FROM (SELECT *, CAST(split_part(order_id, '-', 1) AS BIGINT) % 3 AS part FROM ({_from_sales(_CLEAN)}))""",
    "views_by_name": _from_sales(f"""
  SELECT 'monthly_kpi' AS view, order_year || '-' || order_month AS key, {_ORDERS} AS orders, {_REVENUE} AS revenue
  FROM sales GROUP BY order_year, order_month
  UNION ALL SELECT 'category_kpi', product_category, {_ORDERS}, {_REVENUE} FROM sales GROUP BY product_category
  UNION ALL SELECT 'rep_performance', sales_rep, {_ORDERS}, {_REVENUE} FROM sales GROUP BY sales_rep"""),
    "report_marts": _from_sales(f"""
  SELECT name AS mart, CASE name
           WHEN 'overall_kpis' THEN 1
           WHEN 'monthly_trend' THEN (SELECT COUNT(DISTINCT (order_year, order_month)) FROM sales)
           WHEN 'top_products' THEN (SELECT COUNT(*) FROM top)
           WHEN 'region_analysis' THEN (SELECT COUNT(DISTINCT (region, segment)) FROM sales)
           WHEN 'sales_rep_kpis' THEN (SELECT COUNT(DISTINCT sales_rep) FROM sales)
           ELSE (SELECT COUNT(DISTINCT is_discounted) FROM sales) END AS rows,
         CASE name WHEN 'top_products' THEN (SELECT CAST(SUM(total_revenue) AS DOUBLE) FROM top)
                   ELSE (SELECT {_REVENUE} FROM sales) END AS total
  FROM (VALUES ('overall_kpis'), ('monthly_trend'), ('top_products'), ('region_analysis'), ('sales_rep_kpis'),
               ('discount_analysis')) AS marts (name)""", _TOP),
    "sales_rfm": _from_sales("""
  SELECT order_id, customer_id, CAST(sales AS DOUBLE) AS sales, recency_days, frequency,
         CAST(monetary AS DOUBLE) AS monetary
  FROM sales LEFT JOIN rfm USING (customer_id)""", _RFM),
    "customer_rfm": _from_sales(
        _CUSTOMERS_RANKED + " ORDER BY rfm.monetary DESC NULLS LAST, customer_id, customer_name LIMIT 30", _RFM
    ),
    "customer_segments": _from_sales(_CUSTOMERS_RANKED, _RFM),
    "normalize_text": "SELECT p_partkey, "
    + _title("trim(chr(9) || ' ' || upper(p_name) || '-o''neil 2nd' || chr(10), ' ' || chr(9) || chr(10))")
    + " AS label FROM part",
    "monthly_kpi": _from_sales(f"""
  SELECT order_year, order_month, {_ORDERS} AS total_orders, {_REVENUE} AS total_revenue,
         {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct, {_CUSTOMERS} AS unique_customers
  FROM sales GROUP BY order_year, order_month"""),
    "category_kpi": _from_sales(f"""
  SELECT product_category, {_ORDERS} AS total_orders, {_UNITS} AS units_sold, {_REVENUE} AS total_revenue,
         {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct
  FROM sales GROUP BY product_category"""),
    "rep_performance": _from_sales(f"""
  SELECT sales_rep, {_ORDERS} AS orders_closed, {_CUSTOMERS} AS customers_served, {_REVENUE} AS total_revenue,
         {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct
  FROM sales GROUP BY sales_rep"""),
    "overall_kpis": _from_sales(f"""
  SELECT {_ORDERS} AS total_orders, {_CUSTOMERS} AS unique_customers, {_REVENUE} AS total_revenue,
         {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct, {_PER_ORDER} AS avg_order_value,
         CAST(ROUND(CAST(SUM(CASE WHEN is_discounted = 1 THEN sales ELSE 0 END) / SUM(sales) * 100
              AS DECIMAL(28,6)), 2) AS DOUBLE) AS discounted_revenue_pct
  FROM sales"""),
    "revenue_trend_monthly": _from_sales(_TREND + " GROUP BY order_year, order_month ORDER BY 1, 2"),
    "revenue_trend_year": _from_sales(
        _TREND + " GROUP BY order_year, order_month HAVING order_year = 1997 ORDER BY 1, 2"
    ),
    "top_products": _top_products(10),
    "top_products_50": _top_products(50),
    "region_segment_matrix": _from_sales(f"""
  SELECT region, segment, {_ORDERS} AS orders, {_CUSTOMERS} AS customers, {_REVENUE} AS revenue,
         {_PROFIT} AS profit, {_MARGIN} AS avg_margin_pct
  FROM sales GROUP BY region, segment"""),
    "sales_rep_leaderboard": _from_sales(f"""
  SELECT sales_rep, {_ORDERS} AS orders_closed, {_CUSTOMERS} AS customers_served, {_REVENUE} AS total_revenue,
         {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct, {_PER_ORDER} AS avg_deal_size
  FROM sales GROUP BY sales_rep"""),
    "discount_impact": _from_sales(f"""
  SELECT CASE WHEN is_discounted = 1 THEN 'Discounted' ELSE 'Full Price' END AS pricing_type,
         {_DISCOUNT} AS avg_discount_pct, {_ORDERS} AS order_count, {_REVENUE} AS total_revenue,
         {_PROFIT} AS total_profit, {_MARGIN} AS avg_margin_pct
  FROM sales GROUP BY is_discounted"""),
    "low_margin_alerts": _from_sales(f"""
  SELECT product_name, product_category, {_ORDERS} AS order_count, {_MARGIN} AS avg_margin_pct,
         {_REVENUE} AS total_revenue
  FROM sales GROUP BY product_name, product_category
  HAVING ROUND(CAST(AVG(profit_margin_pct) AS DECIMAL(28,6)), 2) < 20"""),
    "trend_period": _from_sales(f"""
  SELECT order_year || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS period, {_REVENUE} AS revenue,
         CAST(CAST(SUM(sales) / 100000 AS DECIMAL(28,7)) AS DOUBLE) AS revenue_lakh, {_MARGIN} AS avg_margin_pct
  FROM sales GROUP BY order_year, order_month"""),
    "rep_lakhs": _from_sales("""
  SELECT sales_rep, CAST(CAST(SUM(sales) / 100000 AS DECIMAL(28,7)) AS DOUBLE) AS revenue_lakh,
         CAST(CAST(SUM(profit) / 100000 AS DECIMAL(28,7)) AS DOUBLE) AS profit_lakh
  FROM sales GROUP BY sales_rep"""),
    "category_breakdown": _from_sales("""
  SELECT product_category, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
         CAST(SUM(total_profit) AS DOUBLE) AS total_profit,
         CAST(ROUND(CAST(SUM(total_revenue) / (SELECT SUM(total_revenue) FROM top) * 100
              AS DECIMAL(28,6)), 1) AS DOUBLE) AS share_pct
  FROM top GROUP BY product_category""", _TOP),
    "category_margin_rank": _from_sales("""
  SELECT product_category, CAST(CAST(AVG(avg_margin_pct) AS DECIMAL(28,6)) AS DOUBLE) AS avg_margin_pct
  FROM top GROUP BY product_category""", _TOP),
    "region_segment_pivot": _from_sales(
        " SELECT region, "
        + ", ".join(
            f"CAST(SUM(CASE WHEN segment = '{s}' THEN sales ELSE 0 END) AS DOUBLE) AS \"{s}\"" for s in _SEGMENTS
        )
        + " FROM sales GROUP BY region"
    ),
    "records_json": _from_sales(f"""
  SELECT '{{"order_year":' || order_year || ',"order_month":' || order_month
         || ',"total_orders":' || {_ORDERS} || ',"revenue":' || SUM(sales) || ',"profit":' || SUM(profit)
         || ',"avg_margin_pct":' || ROUND(CAST(AVG(profit_margin_pct) AS DECIMAL(28,6)), 2)
         || ',"unique_customers":' || {_CUSTOMERS}
         || ',"avg_order_value":' || ROUND(CAST(SUM(sales) / {_ORDERS} AS DECIMAL(28,6)), 2) || '}}' AS record
  FROM sales GROUP BY order_year, order_month"""),
    "weekly_agg": _from_sales(f" SELECT {_as_shown(_AMOUNTS)} FROM weekly", _weekly()),
    "weekly_features": _from_sales(f" SELECT {_as_shown(_PANEL_AMOUNTS)} FROM panel", _weekly(), _lagged()),
    "weekly_features_region": _from_sales(
        f" SELECT {_as_shown(_PANEL_AMOUNTS)} FROM panel", _weekly("region"), _lagged("region")
    ),
    "train_test_split": _from_sales("""
  SELECT strftime(week, '%Y-%m-%d') AS week, CAST(revenue AS DOUBLE) AS revenue,
         CASE WHEN ROW_NUMBER() OVER (ORDER BY week) <= FLOOR(COUNT(*) OVER () * 0.8) THEN 1 ELSE 0 END AS is_train
  FROM panel""", _weekly(), _lagged()),
    "adhoc_select": _from_sales(f"""
  SELECT sales_rep, COUNT(*) AS orders, {_REVENUE} AS revenue, {_MARGIN} AS avg_margin_pct
  FROM sales WHERE region = 'Asia' AND is_discounted = 1 GROUP BY sales_rep"""),
}

"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written directly against the test tables with the FIXTURES.md section 2 mapping; it
shares no code with the Spark plans. Parity rules: money sums cast to DECIMAL(22,2),
integer sums to BIGINT, calendar parts to INTEGER, averages as ``CAST(SUM AS DOUBLE) /
COUNT(*)``, rounded doubles ``+ 0.0``.
"""

from __future__ import annotations

# ------------------------------------------------------------------ star CTEs
_AGE = """CASE WHEN c_acctbal < 0 THEN '0-17' WHEN c_acctbal < 1500 THEN '18-25'
  WHEN c_acctbal < 3000 THEN '26-35' WHEN c_acctbal < 4500 THEN '36-45'
  WHEN c_acctbal < 6000 THEN '46-50' WHEN c_acctbal < 8000 THEN '51-55' ELSE '55+' END"""

DIM_CUSTOMER = f"""dim_customer AS (
  SELECT c_custkey AS customer_sk, CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    {_AGE} AS age_group,
    c_nationkey AS occupation,
    CASE c_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS city_category,
    CAST(c_custkey % 5 AS INTEGER) AS stay_in_current_city_years,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 1 ELSE 0 END AS marital_status,
    n_regionkey AS store_sk
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

DIM_PRODUCT = """dim_product AS (
  SELECT p_partkey AS product_sk, p_partkey AS product_id, p_type AS product_category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part)"""

DIM_STORE = """dim_store AS (
  SELECT CAST(r_regionkey AS BIGINT) AS store_sk, r_regionkey AS store_id, r_name AS store_name
  FROM region)"""

DIM_SUPPLIER = """dim_supplier AS (
  SELECT s_suppkey AS supplier_sk, s_suppkey AS supplier_id, s_name AS supplier_name
  FROM supplier)"""

FACT = """fact AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_sk,
         l_partkey AS product_sk, l_suppkey AS supplier_sk, n_regionkey AS store_sk,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(12,2))
           AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)"""

DIM_TIME_FN = """dt AS (
  SELECT f.*, CAST(year(transaction_date) AS INTEGER) AS year,
         CAST(month(transaction_date) AS INTEGER) AS month,
         CAST(quarter(transaction_date) AS INTEGER) AS quarter,
         CASE WHEN isodow(transaction_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN month(transaction_date) IN (12, 1, 2) THEN 'Winter'
              WHEN month(transaction_date) IN (3, 4, 5) THEN 'Spring'
              WHEN month(transaction_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
  FROM fact f)"""

STAR = "WITH " + ",\n".join([FACT, DIM_CUSTOMER, DIM_PRODUCT, DIM_STORE, DIM_SUPPLIER,
                              DIM_TIME_FN]) + "\n"

DAYTYPE = "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END"
MSUM = "CAST(SUM(total_amount) AS DECIMAL(22,2))"
QSUM = "CAST(SUM(quantity) AS BIGINT)"
AVG = "CAST(SUM(total_amount) AS DOUBLE) / COUNT(*)"


def growth(cur: str, prev: str) -> str:
    return (f"CASE WHEN {prev} IS NULL THEN 0.0 WHEN {prev} = 0 THEN NULL ELSE "
            f"ROUND((CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / CAST({prev} AS DOUBLE)"
            f" * 100.0, 2) + 0.0 END")


REPORT_SQL: dict[str, str] = {}

REPORT_SQL["q01_top_products_daytype"] = STAR + f"""
SELECT p.product_category, p.product_id, p.price, {DAYTYPE} AS day_type, year, month,
       {MSUM} AS total_revenue, COUNT(*) AS transaction_count
FROM dt JOIN dim_product p USING (product_sk)
GROUP BY ALL
ORDER BY total_revenue DESC, transaction_count DESC, product_category, product_id, price,
         day_type, year, month
LIMIT 5"""

REPORT_SQL["q01_top_per_daytype"] = STAR + f"""
, g AS (
  SELECT {DAYTYPE} AS day_type, year, month, p.product_id, p.product_category,
         {MSUM} AS total_revenue, COUNT(*) AS transaction_count
  FROM dt JOIN dim_product p USING (product_sk)
  GROUP BY 1, 2, 3, 4, 5)
SELECT * FROM (
  SELECT g.*, CAST(ROW_NUMBER() OVER (PARTITION BY day_type, year, month
                ORDER BY total_revenue DESC, transaction_count DESC, product_id) AS INTEGER)
                AS rank
  FROM g) t
WHERE rank <= 5"""

REPORT_SQL["q02_customer_demographics"] = STAR + f"""
SELECT gender, age_group, city_category, COUNT(DISTINCT customer_sk) AS customer_count,
       {MSUM} AS total_purchase_amount, {AVG} AS avg_purchase_amount,
       COUNT(*) AS transaction_count
FROM fact JOIN dim_customer c USING (customer_sk)
GROUP BY gender, age_group, city_category
ORDER BY total_purchase_amount DESC"""

REPORT_SQL["q03_category_by_occupation"] = STAR + f"""
SELECT occupation, product_category, {QSUM} AS total_quantity, {MSUM} AS total_sales,
       {AVG} AS avg_sale_value, COUNT(DISTINCT customer_sk) AS customer_count
FROM fact JOIN dim_customer USING (customer_sk) JOIN dim_product USING (product_sk)
GROUP BY occupation, product_category
ORDER BY total_sales DESC"""

REPORT_SQL["q04_gender_age_quarterly"] = STAR + f"""
SELECT gender, age_group, year, quarter, {QSUM} AS total_quantity,
       {MSUM} AS total_purchase_amount, {AVG} AS avg_purchase_amount,
       COUNT(*) AS transaction_count
FROM dt JOIN dim_customer USING (customer_sk)
WHERE year = 1998
GROUP BY gender, age_group, year, quarter
ORDER BY year, quarter, gender, age_group"""

REPORT_SQL["q05_top_occupations"] = STAR + f"""
SELECT occupation, product_category, {MSUM} AS total_sales, COUNT(*) AS transaction_count,
       {AVG} AS avg_sale_value
FROM fact JOIN dim_customer USING (customer_sk) JOIN dim_product USING (product_sk)
GROUP BY occupation, product_category
ORDER BY total_sales DESC, transaction_count DESC, occupation, product_category
LIMIT 5"""

REPORT_SQL["q06_city_marital_monthly"] = STAR + f"""
SELECT city_category, marital_status, year, month, {MSUM} AS total_purchase_amount,
       COUNT(*) AS transaction_count, {AVG} AS avg_purchase_amount
FROM dt JOIN dim_customer USING (customer_sk)
WHERE date_diff('month', transaction_date, DATE '2001-08-01') <= 6
GROUP BY city_category, marital_status, year, month
ORDER BY year DESC, month DESC, total_purchase_amount DESC"""

REPORT_SQL["q07_stay_duration_gender"] = STAR + f"""
SELECT stay_in_current_city_years AS stay_duration_years, gender,
       COUNT(DISTINCT customer_sk) AS customer_count, {AVG} AS avg_purchase_amount,
       {MSUM} AS total_amount, COUNT(*) AS transaction_count
FROM fact JOIN dim_customer USING (customer_sk)
GROUP BY stay_in_current_city_years, gender
ORDER BY stay_duration_years, gender"""

REPORT_SQL["q08_top_cities_category"] = STAR + f"""
SELECT city_category, product_category, {MSUM} AS total_revenue, {QSUM} AS total_quantity,
       COUNT(DISTINCT customer_sk) AS unique_customers, {AVG} AS avg_sale_value
FROM fact JOIN dim_customer USING (customer_sk) JOIN dim_product USING (product_sk)
GROUP BY city_category, product_category
ORDER BY total_revenue DESC, total_quantity DESC, city_category, product_category
LIMIT 5"""

REPORT_SQL["q09_monthly_growth"] = STAR + f"""
, m AS (
  SELECT product_category, year, month, {MSUM} AS monthly_sales
  FROM dt JOIN dim_product USING (product_sk)
  WHERE year = 1998
  GROUP BY product_category, year, month),
l AS (
  SELECT *, LAG(monthly_sales) OVER (PARTITION BY product_category ORDER BY year, month)
            AS previous_monthly_sales
  FROM m)
SELECT product_category, year, month, monthly_sales, previous_monthly_sales,
       {growth('monthly_sales', 'previous_monthly_sales')} AS growth_percentage
FROM l ORDER BY year, month"""

REPORT_SQL["q10_weekend_weekday_age"] = STAR + f"""
SELECT age_group, {DAYTYPE} AS day_type, {MSUM} AS total_sales, COUNT(*) AS transaction_count,
       {AVG} AS avg_sale_value, {QSUM} AS total_quantity
FROM dt JOIN dim_customer USING (customer_sk)
WHERE year = 1998
GROUP BY age_group, day_type
ORDER BY age_group, day_type"""

REPORT_SQL["q11_top_products_year"] = STAR + f"""
SELECT p.product_id, p.product_category, {DAYTYPE} AS day_type, year, month,
       {MSUM} AS total_revenue, {QSUM} AS total_quantity, COUNT(*) AS transaction_count
FROM dt JOIN dim_product p USING (product_sk)
WHERE year = 1997
GROUP BY ALL
ORDER BY total_revenue DESC, total_quantity DESC, product_id, product_category, day_type,
         year, month
LIMIT 5"""

REPORT_SQL["q12_store_quarter_growth"] = STAR + f"""
, q AS (
  SELECT s.store_id, s.store_name, quarter, {MSUM} AS quarterly_revenue
  FROM dt JOIN dim_store s USING (store_sk)
  WHERE year = 1997
  GROUP BY s.store_id, s.store_name, quarter),
l AS (
  SELECT *, LAG(quarterly_revenue) OVER (PARTITION BY store_id ORDER BY quarter)
            AS previous_quarter_revenue
  FROM q)
SELECT store_id, store_name, quarter, quarterly_revenue, previous_quarter_revenue,
       {growth('quarterly_revenue', 'previous_quarter_revenue')} AS growth_rate
FROM l ORDER BY store_id, quarter"""

REPORT_SQL["q13_supplier_contribution"] = STAR + f"""
SELECT store_name, supplier_name, product_id, product_category, {QSUM} AS total_quantity,
       {MSUM} AS total_sales, {AVG} AS avg_sale_value, COUNT(*) AS transaction_count
FROM fact JOIN dim_store USING (store_sk) JOIN dim_supplier USING (supplier_sk)
     JOIN dim_product USING (product_sk)
GROUP BY store_name, supplier_name, product_id, product_category
ORDER BY store_name, supplier_name, product_id"""

REPORT_SQL["q14_seasonal_category"] = STAR + f"""
SELECT product_category, season, {QSUM} AS total_quantity, {MSUM} AS total_sales,
       {AVG} AS avg_sale_value, COUNT(DISTINCT c.customer_sk) AS unique_customers,
       COUNT(*) AS transaction_count
FROM dt JOIN dim_product USING (product_sk) JOIN dim_customer c USING (customer_sk)
GROUP BY product_category, season
ORDER BY product_category, season"""

REPORT_SQL["q15_store_supplier_volatility"] = STAR + f"""
, m AS (
  SELECT store_id, store_name, supplier_id, supplier_name, year, month,
         {MSUM} AS monthly_revenue
  FROM dt JOIN dim_store USING (store_sk) JOIN dim_supplier USING (supplier_sk)
  GROUP BY store_id, store_name, supplier_id, supplier_name, year, month),
l AS (
  SELECT *, LAG(monthly_revenue) OVER (PARTITION BY store_id, supplier_id ORDER BY year, month)
            AS previous_month_revenue
  FROM m)
SELECT store_id, store_name, supplier_id, supplier_name, year, month, monthly_revenue,
       previous_month_revenue,
       {growth('monthly_revenue', 'previous_month_revenue')} AS volatility_percentage
FROM l ORDER BY store_id, supplier_id, year, month"""

REPORT_SQL["q16_product_affinity"] = STAR + """
SELECT p1.product_id AS product1, p1.product_category AS category1,
       p2.product_id AS product2, p2.product_category AS category2,
       COUNT(*) AS frequency_purchased_together,
       CAST(SUM(f1.total_amount + f2.total_amount) AS DECIMAL(22,2)) AS combined_revenue
FROM fact f1 JOIN fact f2 ON f1.order_id = f2.order_id AND f1.product_sk < f2.product_sk
                          AND f1.customer_sk = f2.customer_sk
     JOIN dim_product p1 ON f1.product_sk = p1.product_sk
     JOIN dim_product p2 ON f2.product_sk = p2.product_sk
GROUP BY p1.product_id, p1.product_category, p2.product_id, p2.product_category
ORDER BY frequency_purchased_together DESC, combined_revenue DESC, product1, product2
LIMIT 5"""

REPORT_SQL["q17_revenue_rollup"] = STAR + f"""
SELECT store_name, supplier_name, product_category, year,
       CAST(GROUPING_ID(store_name, supplier_name, product_category, year) AS INTEGER)
         AS grouping_id,
       {MSUM} AS total_revenue, COUNT(*) AS transaction_count
FROM dt JOIN dim_store USING (store_sk) JOIN dim_supplier USING (supplier_sk)
     JOIN dim_product USING (product_sk)
GROUP BY ROLLUP (store_name, supplier_name, product_category, year)
ORDER BY store_name NULLS FIRST, supplier_name NULLS FIRST, product_category NULLS FIRST,
         year NULLS FIRST"""

REPORT_SQL["q18_half_year_sales"] = STAR + """
SELECT product_id, product_category, price,
  CAST(SUM(CASE WHEN month <= 6 THEN total_amount ELSE 0 END) AS DECIMAL(22,2)) AS h1_revenue,
  CAST(SUM(CASE WHEN month <= 6 THEN quantity ELSE 0 END) AS BIGINT) AS h1_quantity,
  CAST(SUM(CASE WHEN month > 6 THEN total_amount ELSE 0 END) AS DECIMAL(22,2)) AS h2_revenue,
  CAST(SUM(CASE WHEN month > 6 THEN quantity ELSE 0 END) AS BIGINT) AS h2_quantity,
  CAST(SUM(total_amount) AS DECIMAL(22,2)) AS yearly_revenue,
  CAST(SUM(quantity) AS BIGINT) AS yearly_quantity
FROM dt JOIN dim_product USING (product_sk)
WHERE year = 1998
GROUP BY product_id, product_category, price
ORDER BY yearly_revenue DESC"""

REPORT_SQL["q19_revenue_spikes"] = STAR + """
, daily AS (
  SELECT p.product_id, p.product_sk, p.product_category, f.transaction_date AS sale_date,
         CAST(SUM(f.total_amount) AS DECIMAL(22,2)) AS daily_sales
  FROM fact f JOIN dim_product p USING (product_sk)
  GROUP BY p.product_id, p.product_sk, p.product_category, f.transaction_date),
w AS (
  SELECT *, SUM(daily_sales) OVER (PARTITION BY product_sk) AS tot,
            COUNT(*) OVER (PARTITION BY product_sk) AS n
  FROM daily)
SELECT product_id, product_category, sale_date, daily_sales,
       CAST(tot AS DOUBLE) / n AS avg_daily_sales,
       'SPIKE' AS sale_status,
       ROUND(CAST(daily_sales AS DOUBLE) / (CAST(tot AS DOUBLE) / n) * 100.0, 2) + 0.0
         AS percent_of_average
FROM w
WHERE daily_sales * n > 2 * tot
ORDER BY daily_sales DESC"""

REPORT_SQL["q20_store_quarterly_view"] = STAR + f"""
, v AS (
  SELECT s.store_sk, s.store_name, year, quarter, {MSUM} AS total_sales,
         {QSUM} AS total_quantity, COUNT(*) AS transaction_count, {AVG} AS avg_sale_value
  FROM dt JOIN dim_store s USING (store_sk)
  GROUP BY s.store_sk, s.store_name, year, quarter)
SELECT store_name, year, quarter, total_sales, total_quantity, transaction_count
FROM v ORDER BY store_name, year, quarter"""

REPORT_SQL["util_table_counts"] = STAR + """
SELECT 'SALES_FACT' AS table_name, COUNT(*) AS record_count FROM fact
UNION ALL SELECT 'DIM_CUSTOMER', COUNT(*) FROM dim_customer
UNION ALL SELECT 'DIM_PRODUCT', COUNT(*) FROM dim_product
UNION ALL SELECT 'DIM_STORE', COUNT(*) FROM dim_store
UNION ALL SELECT 'DIM_SUPPLIER', COUNT(*) FROM dim_supplier
UNION ALL SELECT 'DIM_TIME', COUNT(DISTINCT CAST(o_orderdate AS DATE)) FROM orders"""

REPORT_SQL["util_revenue_summary"] = STAR + f"""
SELECT COUNT(*) AS total_transactions, {MSUM} AS total_revenue,
       {AVG} AS avg_transaction_amount, MIN(total_amount) AS min_amount,
       MAX(total_amount) AS max_amount, {QSUM} AS total_quantity
FROM fact"""

REPORT_SQL["slice_dice"] = STAR + f"""
SELECT gender, age_group, {MSUM} AS total_revenue, COUNT(*) AS transaction_count
FROM fact JOIN dim_customer USING (customer_sk) JOIN dim_product USING (product_sk)
WHERE city_category = 'A' AND product_category = 'ECONOMY'
GROUP BY gender, age_group
ORDER BY gender, age_group"""

POINT_SQL = STAR + f"""
SELECT gender, product_category, year(transaction_date) AS year, {MSUM} AS total_revenue, COUNT(*) AS transaction_count
FROM fact JOIN dim_customer USING (customer_sk) JOIN dim_product USING (product_sk)
WHERE customer_sk = (SELECT MIN(customer_sk) FROM fact)
GROUP BY gender, product_category, year(transaction_date)"""


# ------------------------------------------------------------------ ETL keys
RAW = """raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
         CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_suppkey AS VARCHAR) AS supplier_id,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
         strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, o_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DIRTY = """dirty AS (
  SELECT order_id, line_number,
         CASE WHEN o_orderkey % 83 = 0 THEN 'UNKNOWN' ELSE customer_id END AS customer_id,
         CASE WHEN o_orderkey % 79 = 0 THEN 'UNKNOWN' ELSE product_id END AS product_id,
         supplier_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE quantity END AS quantity,
         CASE WHEN o_orderkey % 89 = 0 THEN 'bad' ELSE date END AS date
  FROM raw)"""

CM = f"""cm AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    {_AGE} AS age_group,
    c_nationkey AS occupation,
    CASE c_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS city_category,
    CAST(c_custkey % 5 AS INTEGER) AS stay_in_current_city_years,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 1 ELSE 0 END AS marital_status,
    r_regionkey AS store_id, r_name AS store_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PM = """pm AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category,
         p_retailprice AS price
  FROM part)"""

CLASSIFIED = """cl AS (
  SELECT d.*, TRY_CAST(trim(d.quantity) AS INTEGER) AS qty,
         TRY_CAST(trim(d.date) AS DATE) AS tdate, cm.gender, pm.product_category, pm.price,
         CASE WHEN TRY_CAST(trim(d.quantity) AS INTEGER) IS NULL THEN 'bad_quantity'
              WHEN TRY_CAST(trim(d.date) AS DATE) IS NULL THEN 'bad_date'
              WHEN cm.customer_id IS NULL THEN 'unknown_customer'
              WHEN pm.product_id IS NULL THEN 'unknown_product'
              WHEN pm.price IS NULL THEN 'bad_price'
              ELSE 'ok' END AS reject_reason
  FROM dirty d LEFT JOIN cm ON d.customer_id = cm.customer_id
               LEFT JOIN pm ON d.product_id = pm.product_id)"""

ETL = "WITH " + ",\n".join([RAW, DIRTY, CM, PM, CLASSIFIED]) + "\n"

CAL_COLS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS transaction_date,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
  strftime(d, '%A') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
       WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday"""


def members_sql(master_cte: str, key: str, sk: str, key_is_text: bool) -> str:
    num = f"CAST({key} AS BIGINT)" if key_is_text else key
    return ETL + f""", m AS ({master_cte}),
ex AS (SELECT {key}, ROW_NUMBER() OVER (ORDER BY {key}) AS {sk}, false AS is_new
       FROM m WHERE {num} % 2 = 0),
arr AS (SELECT DISTINCT {key} FROM arrivals JOIN m USING ({key})),
nw AS (SELECT {key}, (SELECT COUNT(*) FROM ex) + ROW_NUMBER() OVER (ORDER BY {key}) AS {sk},
              true AS is_new
       FROM arr WHERE {key} NOT IN (SELECT {key} FROM ex))
SELECT * FROM ex UNION ALL SELECT * FROM nw"""


ETL_SQL: dict[str, str] = {"slice_customer": POINT_SQL}

ETL_SQL["src_customer_master"] = ETL + """
SELECT customer_id, gender, age_group, occupation, city_category, stay_in_current_city_years,
       marital_status FROM cm"""

ETL_SQL["src_product_master"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, r_regionkey AS store_id,
       r_name AS store_name, CAST(s_suppkey AS INTEGER) AS supplier_id, s_name AS supplier_name
FROM part JOIN region ON p_partkey % (SELECT COUNT(*) FROM region) = r_regionkey
     JOIN supplier ON p_partkey % (SELECT COUNT(*) FROM supplier) = s_suppkey"""

ETL_SQL["enrich_sales_batch"] = ETL + """
SELECT r.order_id, r.customer_id, r.product_id, cm.gender, pm.product_category,
       CAST(r.quantity AS INTEGER) AS quantity, CAST(pm.price AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(r.quantity AS INTEGER) * CAST(pm.price AS DECIMAL(10,2)) AS DECIMAL(12,2))
         AS total_amount
FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN pm ON r.product_id = pm.product_id"""

ETL_SQL["unmatched_sales"] = ETL + """
SELECT order_id, line_number, customer_id, product_id FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM cm WHERE cm.customer_id = r.customer_id
                                     AND cm.customer_id NOT LIKE '%0')"""

ETL_SQL["quarantine_sales"] = ETL + """
SELECT reject_reason, COUNT(*) AS row_count FROM cl GROUP BY reject_reason"""

ETL_SQL["surrogate_keys"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       ROW_NUMBER() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS customer_sk
FROM customer"""

ETL_SQL["dim_customer_members"] = members_sql(
    "SELECT customer_id FROM cm", "customer_id", "customer_sk", True).replace(
    "FROM arrivals", "FROM raw")
ETL_SQL["dim_product_members"] = members_sql(
    "SELECT product_id FROM pm", "product_id", "product_sk", True).replace(
    "FROM arrivals", "FROM raw")
ETL_SQL["dim_store_members"] = members_sql(
    "SELECT r_regionkey AS store_id FROM region", "store_id", "store_sk", False).replace(
    "FROM arrivals", "FROM (SELECT store_id FROM raw JOIN cm USING (customer_id))")
ETL_SQL["dim_supplier_members"] = members_sql(
    "SELECT s_suppkey AS supplier_id FROM supplier", "supplier_id", "supplier_sk", False).replace(
    "FROM arrivals", "FROM (SELECT CAST(supplier_id AS BIGINT) AS supplier_id FROM raw)")

ETL_SQL["dim_time_from_sales"] = ETL + f"""
SELECT {CAL_COLS}
FROM (SELECT DISTINCT CAST(date AS DATE) AS d FROM raw)"""

ETL_SQL["dim_time_calendar"] = f"""
WITH b AS (SELECT make_date(CAST(year(MIN(o_orderdate)) AS INTEGER), 1, 1) AS lo,
                  make_date(CAST(year(MAX(o_orderdate)) AS INTEGER), 12, 31) AS hi FROM orders),
days AS (SELECT CAST(lo + INTERVAL (i) DAY AS DATE) AS d
         FROM b, range(0, 100000) t(i) WHERE lo + INTERVAL (i) DAY <= hi)
SELECT {CAL_COLS} FROM days"""

ETL_SQL["fact_sales"] = ETL + """
SELECT r.order_id,
       DENSE_RANK() OVER (ORDER BY r.customer_id) AS customer_sk,
       DENSE_RANK() OVER (ORDER BY r.product_id) AS product_sk,
       DENSE_RANK() OVER (ORDER BY cm.store_id) AS store_sk,
       DENSE_RANK() OVER (ORDER BY CAST(r.supplier_id AS INTEGER)) AS supplier_sk,
       CAST(strftime(CAST(r.date AS DATE), '%Y%m%d') AS INTEGER) AS date_sk,
       CAST(r.quantity AS INTEGER) AS quantity, CAST(pm.price AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(r.quantity AS INTEGER) * CAST(pm.price AS DECIMAL(10,2)) AS DECIMAL(12,2))
         AS total_amount
FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN pm ON r.product_id = pm.product_id"""

ETL_SQL["scd2_customer"] = ETL + """
, d2 AS (SELECT CAST(MAX(o_orderdate) AS DATE) AS d FROM orders),
chg AS (SELECT customer_id, city_category,
               CASE WHEN city_category = 'A' THEN 'B' WHEN city_category = 'B' THEN 'C'
                    ELSE 'A' END AS new_city
        FROM cm WHERE customer_id LIKE '%0')
SELECT customer_id, city_category, DATE '1995-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
       true AS is_current FROM cm WHERE customer_id NOT LIKE '%0'
UNION ALL SELECT customer_id, city_category, DATE '1995-01-01', (SELECT d FROM d2), false FROM chg
UNION ALL SELECT customer_id, new_city, (SELECT d FROM d2), CAST(NULL AS DATE), true FROM chg"""

ETL_SQL["dq_completeness"] = ETL + """
, n AS (SELECT COUNT(*) FILTER (WHERE reject_reason = 'ok') AS loaded_rows,
               COUNT(*) FILTER (WHERE reject_reason <> 'ok') AS rejected_rows FROM cl),
r AS (SELECT COUNT(*) AS source_rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT source_rows, loaded_rows, rejected_rows,
       source_rows - loaded_rows - rejected_rows AS unaccounted_rows FROM n, r"""

ETL_SQL["dq_orphans"] = ETL + """
SELECT fk_column, dimension, orphan_rows FROM (
  SELECT 1 AS o, 'customer_sk' AS fk_column, 'dim_customer' AS dimension,
         COUNT(*) FILTER (WHERE customer_id LIKE '%0') AS orphan_rows
  FROM cl WHERE reject_reason = 'ok'
  UNION ALL SELECT 2, 'product_sk', 'dim_product', 0
  UNION ALL SELECT 3, 'store_sk', 'dim_store', 0
  UNION ALL SELECT 4, 'supplier_sk', 'dim_supplier', 0
  UNION ALL SELECT 5, 'date_sk', 'dim_time', 0)"""

ETL_SQL["dq_duplicates"] = """
SELECT 'customer_master' AS table_name, 'customer_id' AS key_column,
       COUNT(*) AS duplicate_keys, COUNT(*) AS excess_rows
FROM customer WHERE CAST(c_custkey AS VARCHAR) LIKE '%7'
UNION ALL SELECT 'product_master', 'product_id', 0, 0"""

ETL_SQL["dq_nulls"] = ETL + """
UNPIVOT (
  SELECT 'transactions' AS table_name,
    COUNT(*) FILTER (WHERE order_id IS NULL) AS order_id,
    COUNT(*) FILTER (WHERE customer_id IS NULL) AS customer_id,
    COUNT(*) FILTER (WHERE product_id IS NULL) AS product_id,
    COUNT(*) FILTER (WHERE qty IS NULL) AS quantity,
    COUNT(*) FILTER (WHERE tdate IS NULL) AS transaction_date,
    COUNT(*) FILTER (WHERE gender IS NULL) AS gender,
    COUNT(*) FILTER (WHERE product_category IS NULL) AS product_category,
    COUNT(*) FILTER (WHERE price IS NULL) AS price
  FROM cl)
ON order_id, customer_id, product_id, quantity, transaction_date, gender, product_category, price
INTO NAME column_name VALUE null_count"""

ETL_SQL["dq_ranges"] = STAR + """
SELECT 'sales_fact' AS table_name, column_name, min_value, max_value FROM (
  SELECT 'unit_price' AS column_name, CAST(MIN(unit_price) AS VARCHAR) AS min_value,
         CAST(MAX(unit_price) AS VARCHAR) AS max_value FROM fact
  UNION ALL SELECT 'total_amount', CAST(MIN(total_amount) AS VARCHAR),
         CAST(MAX(total_amount) AS VARCHAR) FROM fact
  UNION ALL SELECT 'quantity', CAST(MIN(quantity) AS VARCHAR), CAST(MAX(quantity) AS VARCHAR)
         FROM fact
  UNION ALL SELECT 'transaction_date', CAST(MIN(transaction_date) AS VARCHAR),
         CAST(MAX(transaction_date) AS VARCHAR) FROM fact)"""

ETL_SQL["dq_domains"] = ETL + """
SELECT 'gender_char1' AS rule,
       COUNT(*) FILTER (WHERE length(gender) <> 1 OR gender NOT IN ('M', 'F')) AS violations FROM cm
UNION ALL SELECT 'city_category_char1',
       COUNT(*) FILTER (WHERE length(city_category) <> 1 OR city_category NOT IN ('A', 'B', 'C'))
       FROM cm
UNION ALL SELECT 'occupation_range', COUNT(*) FILTER (WHERE occupation < 0 OR occupation > 20)
       FROM cm
UNION ALL SELECT 'age_group_band', COUNT(*) FILTER (WHERE age_group NOT IN
       ('0-17', '18-25', '26-35', '36-45', '46-50', '51-55', '55+')) FROM cm
UNION ALL SELECT 'marital_status_flag', COUNT(*) FILTER (WHERE marital_status NOT IN (0, 1))
       FROM cm"""

ETL_SQL["stream_sales_enriched"] = ETL_SQL["enrich_sales_batch"]

ETL_SQL["stream_fact_sales"] = ETL + """
SELECT r.order_id, r.customer_id, r.product_id, CAST(cm.store_id AS INTEGER) AS store_id,
       CAST(r.supplier_id AS INTEGER) AS supplier_id,
       CAST(strftime(CAST(r.date AS DATE), '%Y%m%d') AS INTEGER) AS date_sk,
       CAST(r.quantity AS INTEGER) AS quantity, CAST(pm.price AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(r.quantity AS INTEGER) * CAST(pm.price AS DECIMAL(10,2)) AS DECIMAL(12,2))
         AS total_amount
FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN pm ON r.product_id = pm.product_id"""

ETL_SQL["fact_sales_keys"] = ETL + """
SELECT COUNT(*) AS fact_rows, CAST(1 AS BIGINT) AS first_sk, COUNT(*) AS last_sk,
       COUNT(*) AS distinct_sk, COUNT(*) AS dated_rows FROM raw"""

ETL_SQL["load_two_batches"] = ETL + """
, used AS (SELECT r.*, cm.store_id, CAST(r.order_id AS BIGINT) % 2 AS batch
           FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN pm ON r.product_id = pm.product_id),
c AS (SELECT COUNT(DISTINCT customer_id) AS c, COUNT(DISTINCT product_id) AS p,
             COUNT(DISTINCT store_id) AS s, COUNT(DISTINCT supplier_id) AS u FROM used)
SELECT 'sales_fact' AS table_name, batch AS batch_id, COUNT(*) AS n FROM used GROUP BY batch
UNION ALL SELECT 'sales_fact', 2, COUNT(*) FROM used WHERE batch = 1 AND customer_id LIKE '%7'
UNION ALL SELECT 'dim_customer ' || k, -1, c FROM c, (VALUES ('members'), ('keys')) v(k)
UNION ALL SELECT 'dim_product ' || k, -1, p FROM c, (VALUES ('members'), ('keys')) v(k)
UNION ALL SELECT 'dim_store ' || k, -1, s FROM c, (VALUES ('members'), ('keys')) v(k)
UNION ALL SELECT 'dim_supplier ' || k, -1, u FROM c, (VALUES ('members'), ('keys')) v(k)"""

ETL_SQL["mv_store_quarterly"] = STAR + f"""
SELECT s.store_id, s.store_name, year, quarter, {MSUM} AS total_sales, {QSUM} AS total_quantity,
       COUNT(*) AS transaction_count, {AVG} AS avg_sale_value
FROM dt JOIN dim_store s USING (store_sk)
GROUP BY s.store_id, s.store_name, year, quarter"""


_CUBES = {"demographics": ("gender", "age_group", "city_category"), "occupation": ("occupation", "product_category"),
          "stay": ("stay_in_current_city_years", "gender"), "city": ("city_category", "product_category"),
          "season": ("product_category", "season")}


def _cell_sql(cube: str, keys: tuple[str, ...]) -> str:
    named = [f"CAST({k} AS VARCHAR)" for k in keys] + ["CAST(NULL AS VARCHAR)"] * (3 - len(keys))
    cols = ", ".join(f"{k} AS k{i + 1}" for i, k in enumerate(named))
    return (f"SELECT '{cube}' AS cube, {cols}, COUNT(DISTINCT c.customer_sk) AS customers, {MSUM} AS total_sales, "
            f"{QSUM} AS total_quantity, COUNT(*) AS transaction_count FROM dt JOIN dim_product USING (product_sk) "
            f"JOIN dim_customer c USING (customer_sk) GROUP BY {', '.join(keys)}")


ETL_SQL["mv_customer_bitmaps"] = STAR + "\nUNION ALL ".join(_cell_sql(c, k) for c, k in _CUBES.items())

ETL_SQL["load_failed_batch"] = ETL + """
, used AS (SELECT r.*, cm.store_id, CAST(CAST(r.quantity AS INTEGER) * CAST(pm.price AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS amount
           FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN pm ON r.product_id = pm.product_id),
s AS (SELECT 'failed' AS phase, * FROM used WHERE CAST(order_id AS BIGINT) % 2 = 0
      UNION ALL SELECT 'again', * FROM used),
a AS (SELECT phase, COUNT(*) AS n, CAST(SUM(amount) AS DECIMAL(22,2)) AS amount, COUNT(DISTINCT customer_id) AS c,
             COUNT(DISTINCT product_id) AS p, COUNT(DISTINCT store_id) AS t, COUNT(DISTINCT supplier_id) AS u FROM s GROUP BY phase)
SELECT phase, 'sales_fact' AS table_name, n, amount FROM a
UNION ALL SELECT phase, 'store_quarterly_sales', n, amount FROM a
UNION ALL SELECT phase, 'quarantine', 0, NULL FROM a
UNION ALL SELECT phase, 'dim_customer', c, NULL FROM a
UNION ALL SELECT phase, 'dim_product', p, NULL FROM a
UNION ALL SELECT phase, 'dim_store', t, NULL FROM a
UNION ALL SELECT phase, 'dim_supplier', u, NULL FROM a"""

ETL_SQL["stream_restart"] = ETL_SQL["stream_fact_sales"]

ETL_SQL["fact_sales_scd2"] = ETL + """
, s AS (SELECT CASE WHEN r.customer_id LIKE '%0' AND CAST(r.date AS DATE) >= DATE '1997-01-01'
                    THEN CASE cm.city_category WHEN 'A' THEN 'B' WHEN 'B' THEN 'C' ELSE 'A' END
                    ELSE cm.city_category END AS city_category, CAST(year(CAST(r.date AS DATE)) AS INTEGER) AS year, r.customer_id,
               CAST(CAST(r.quantity AS INTEGER) * CAST(pm.price AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS amount
        FROM raw r JOIN cm ON r.customer_id = cm.customer_id JOIN pm ON r.product_id = pm.product_id)
SELECT city_category, year, COUNT(*) AS transaction_count, CAST(SUM(amount) AS DECIMAL(22,2)) AS total_sales,
       COUNT(DISTINCT customer_id) AS customers FROM s GROUP BY 1, 2"""

"""Independent SQL twins of the queries, for DuckDB (the correctness oracle).

Every query is written from the raw given tables up (raw → silver → gold → query)
as a chain of CTEs, so the oracle shares no code path with the Spark plans.
Numeric helpers spell the same IEEE operations as ``mercato.functions.numeric``.
"""

from __future__ import annotations

# Fixed values of the fixture contract (FIXTURES.md §2), in natural order.
_SHIP_MODES = "['REG AIR','AIR','RAIL','SHIP','TRUCK','MAIL','FOB']"
_SHIP_INSTR = "['DELIVER IN PERSON','COLLECT COD','NONE','TAKE BACK RETURN']"
_CONT_SIZE = "['SM','MED','LG','WRAP','JUMBO']"
_CONT_KIND = "['CASE','BOX','PACK','PKG','JAR','BAG','CAN','DRUM']"


# -- numeric helpers (SQL text) ------------------------------------------------------

def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def rhu(x: str, n: int) -> str:
    p = f"CAST({10 ** n} AS DOUBLE)"
    return f"(SIGN({x}) * FLOOR(ABS({x}) * {p} + CAST(0.5 AS DOUBLE)) / {p})"


def ratio(num: str, den: str) -> str:
    return f"({d(num)} / NULLIF({d(den)}, 0))"


def ratio_pct(num: str, den: str, n: int = 2) -> str:
    return rhu(f"{ratio(num, den)} * CAST(100 AS DOUBLE)", n)


def growth(cur: str, prev: str, n: int = 2) -> str:
    return rhu(f"{d(f'({cur}) - ({prev})')} / NULLIF({d(prev)}, 0) * CAST(100 AS DOUBLE)", n)


def avg(x: str, scale: int | None = None) -> str:
    v = f"CAST({x} AS DECIMAL(30,{scale}))" if scale is not None else x
    return f"({d(f'SUM({v})')} / NULLIF({d(f'COUNT({v})')}, 0))"


def pct_if(pred: str, n: int = 2) -> str:
    return rhu(f"{d(f'SUM(CASE WHEN {pred} THEN 1 ELSE 0 END)')} / NULLIF({d('COUNT(*)')}, 0) "
               f"* CAST(100 AS DOUBLE)", n)


def r0(x: str) -> str:
    return f"CAST(ROUND({x}, 0) AS DOUBLE)"


def ntile(n: int, order: str, nrows: str) -> str:
    """ntile from row_number, written out (same rule as the Spark operator)."""
    rn = f"ROW_NUMBER() OVER (ORDER BY {order})"
    return f"CAST(NTILE({n}) OVER (ORDER BY {order}) AS INTEGER)"


# -- CTE library ---------------------------------------------------------------------

CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()):
    CTE[name] = (sql, deps)


cte("r_customer", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  'CustAddr-' || CAST((c_custkey * 7919) % 99999 AS VARCHAR) AS c_address,
  CAST(c_nationkey + 10 AS VARCHAR) || '-' || lpad(CAST(c_custkey * 17 % 999 AS VARCHAR), 3, '0') || '-'
   || lpad(CAST(c_custkey * 29 % 999 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey * 37 % 9999 AS VARCHAR), 4, '0') AS c_phone
FROM customer""")
cte("r_supplier", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
  'Addr-' || CAST((s_suppkey * 7919) % 99999 AS VARCHAR) AS s_address,
  CAST(s_nationkey + 10 AS VARCHAR) || '-' || lpad(CAST(s_suppkey * 17 % 999 AS VARCHAR), 3, '0') || '-'
   || lpad(CAST(s_suppkey * 29 % 999 AS VARCHAR), 3, '0') || '-' || lpad(CAST(s_suppkey * 37 % 9999 AS VARCHAR), 4, '0') AS s_phone
FROM supplier""")
cte("r_part", f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
  'Manufacturer#' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS p_mfgr,
  ({_CONT_SIZE})[p_partkey % 5 + 1] || ' ' || ({_CONT_KIND})[(p_partkey // 5) % 8 + 1] AS p_container
FROM part""")
cte("r_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority, 'Clerk#' || lpad(CAST((o_orderkey * 31) % 1000 AS VARCHAR), 9, '0') AS o_clerk
FROM orders""")
cte("r_lineitem", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate,
  CAST(l_shipdate AS DATE) + CAST((l_orderkey * 13 + l_suppkey * 5) % 61 - 15 AS INTEGER) AS l_commitdate,
  CAST(l_shipdate AS DATE) + CAST(1 + (l_orderkey * 3 + l_partkey) % 30 AS INTEGER) AS l_receiptdate,
  ({_SHIP_MODES})[(l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 7 + 1] AS l_shipmode,
  ({_SHIP_INSTR})[(l_orderkey + l_linenumber) % 4 + 1] AS l_shipinstruct
FROM lineitem""")
cte("partsupp", """
SELECT p.p_partkey AS ps_partkey, (p.p_partkey + t.i) % n.cnt AS ps_suppkey,
  CAST(1 + (p.p_partkey * 11 + t.i * 7) % 9999 AS INTEGER) AS ps_availqty,
  CAST(CAST(100 + (p.p_partkey * 31 + t.i * 97) % 99900 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2)) AS ps_supplycost
FROM part p CROSS JOIN (SELECT CAST(unnest([0, 1, 2, 3]) AS BIGINT) AS i) t
  CROSS JOIN (SELECT count(*) AS cnt FROM supplier) n""")

cte("dim_geography", """
SELECT n.n_nationkey AS nation_key, n.n_name AS nation_name, r.r_regionkey AS region_key, r.r_name AS region_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
_TIER = ("CASE WHEN {c} < 0 THEN 'Negative' WHEN {c} < 3000 THEN 'Low' WHEN {c} < 7000 THEN 'Medium' "
         "ELSE 'High' END")
cte("dim_customer", f"""
SELECT c.c_custkey AS customer_key, trim(c.c_name) AS customer_name, trim(c.c_address) AS address,
  c.c_phone AS phone, c.c_acctbal AS account_balance, c.c_mktsegment AS market_segment,
  g.nation_name, g.region_name, {_TIER.format(c='c.c_acctbal')} AS balance_tier
FROM r_customer c LEFT JOIN dim_geography g ON c.c_nationkey = g.nation_key""", ("r_customer", "dim_geography"))
cte("dim_supplier", """
SELECT s.s_suppkey AS supplier_key, trim(s.s_name) AS supplier_name, trim(s.s_address) AS address,
  s.s_phone AS phone, s.s_acctbal AS account_balance, g.nation_name, g.region_name
FROM r_supplier s LEFT JOIN dim_geography g ON s.s_nationkey = g.nation_key""", ("r_supplier", "dim_geography"))
cte("dim_part", """
SELECT p_partkey AS part_key, trim(p_name) AS part_name, p_mfgr AS manufacturer, p_brand AS brand,
  p_type AS part_type, p_size AS size, p_container AS container, p_retailprice AS retail_price,
  CASE WHEN p_retailprice < 950 THEN 'Economy' WHEN p_retailprice < 1050 THEN 'Standard'
       WHEN p_retailprice < 1500 THEN 'Premium' ELSE 'Luxury' END AS price_band,
  CASE WHEN p_size <= 10 THEN 'Small' WHEN p_size <= 30 THEN 'Medium' ELSE 'Large' END AS size_category
FROM r_part""", ("r_part",))
cte("dim_date", """
SELECT CAST(dt AS DATE) AS date_key, CAST(year(dt) AS INTEGER) AS year, CAST(quarter(dt) AS INTEGER) AS quarter,
  CAST(month(dt) AS INTEGER) AS month, monthname(dt) AS month_name, CAST(weekofyear(dt) AS INTEGER) AS week_of_year,
  CAST(day(dt) AS INTEGER) AS day_of_month, CAST(dayofweek(dt) + 1 AS INTEGER) AS day_of_week,
  dayname(dt) AS day_name, dayofweek(dt) IN (0, 6) AS is_weekend,
  CAST(year(dt) AS VARCHAR) || '-Q' || CAST(quarter(dt) AS VARCHAR) AS year_quarter,
  strftime(dt, '%Y-%m') AS year_month
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
      INTERVAL 1 DAY)) AS dt FROM orders)""")
cte("fact_orders", f"""
SELECT o.o_orderkey AS order_key, c.customer_key, o.o_orderstatus AS order_status,
  CAST(o.o_totalprice AS DECIMAL(12,2)) AS total_price, o.o_orderdate AS order_date,
  o.o_orderpriority AS order_priority, o.o_clerk AS clerk, c.market_segment,
  c.nation_name AS customer_nation, c.region_name AS customer_region, c.balance_tier AS customer_balance_tier,
  CAST(year(o.o_orderdate) AS INTEGER) AS order_year, CAST(quarter(o.o_orderdate) AS INTEGER) AS order_quarter,
  CAST(month(o.o_orderdate) AS INTEGER) AS order_month
FROM r_orders o LEFT JOIN dim_customer c ON o.o_custkey = c.customer_key""", ("r_orders", "dim_customer"))
cte("fact_lineitem", """
SELECT li.l_orderkey AS order_key, li.l_linenumber AS line_number, li.l_partkey AS part_key,
  li.l_suppkey AS supplier_key, li.l_quantity AS quantity,
  CAST(li.l_extendedprice AS DECIMAL(12,2)) AS extended_price,
  CAST(li.l_discount AS DECIMAL(4,2)) AS discount, CAST(li.l_tax AS DECIMAL(4,2)) AS tax,
  CAST(ROUND(CAST(li.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(li.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS net_revenue,
  CAST(ROUND(CAST(li.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(li.l_discount AS DECIMAL(4,2)))
             * (1 + CAST(li.l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS gross_revenue,
  CAST(ROUND(ps.ps_supplycost * CAST(li.l_quantity AS DECIMAL(12,2)), 2) AS DECIMAL(12,2)) AS supply_cost,
  CAST(ROUND(CAST(li.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(li.l_discount AS DECIMAL(4,2)))
             - COALESCE(ps.ps_supplycost, 0) * CAST(li.l_quantity AS DECIMAL(12,2)), 2) AS DECIMAL(12,2)) AS profit,
  li.l_returnflag AS return_flag, li.l_linestatus AS line_status,
  li.l_shipdate AS ship_date, li.l_commitdate AS commit_date, li.l_receiptdate AS receipt_date,
  CAST(date_diff('day', li.l_commitdate, li.l_receiptdate) AS INTEGER) AS delivery_delay_days,
  CAST(date_diff('day', li.l_commitdate, li.l_shipdate) AS INTEGER) AS ship_delay_days,
  li.l_shipinstruct AS ship_instruct, li.l_shipmode AS ship_mode,
  pt.brand, pt.part_type, pt.price_band, pt.manufacturer,
  sp.supplier_name, sp.nation_name AS supplier_nation, sp.region_name AS supplier_region
FROM r_lineitem li
LEFT JOIN partsupp ps ON li.l_partkey = ps.ps_partkey AND li.l_suppkey = ps.ps_suppkey
LEFT JOIN dim_part pt ON li.l_partkey = pt.part_key
LEFT JOIN dim_supplier sp ON li.l_suppkey = sp.supplier_key""",
    ("r_lineitem", "partsupp", "dim_part", "dim_supplier"))

# gold (notebook variant unless suffixed _v)
_DAILY = f"""
SELECT o.order_date AS sale_date, o.customer_region AS region, o.market_segment AS segment,
  COUNT(DISTINCT o.order_key) AS num_orders, SUM(li.quantity) AS total_quantity,
  SUM(li.net_revenue) AS net_revenue, SUM(li.gross_revenue) AS gross_revenue,
  SUM(li.supply_cost) AS total_cost, SUM(li.profit) AS total_profit,
  {rhu(avg('li.discount'), 4)} AS avg_discount, COUNT(DISTINCT li.part_key) AS distinct_products,
  {ratio_pct('SUM(li.profit)', 'SUM(li.net_revenue)')} AS profit_margin_pct
FROM fact_lineitem li JOIN fact_orders o ON li.order_key = o.order_key
GROUP BY o.order_date, o.customer_region, o.market_segment"""
cte("gold_daily_sales", _DAILY, ("fact_lineitem", "fact_orders"))

_MONTHLY_AGG = f"""
  SUM(num_orders) AS num_orders, SUM(total_quantity) AS total_quantity, SUM(net_revenue) AS net_revenue,
  SUM(gross_revenue) AS gross_revenue, SUM(total_cost) AS total_cost, SUM(total_profit) AS total_profit,
  {rhu(avg('avg_discount', 4), 4)} AS avg_discount"""
cte("monthly_base", f"""
SELECT strftime(sale_date, '%Y-%m') AS year_month, CAST(year(sale_date) AS INTEGER) AS year,
  CAST(month(sale_date) AS INTEGER) AS month, region, segment, {_MONTHLY_AGG}
FROM gold_daily_sales GROUP BY 1, 2, 3, region, segment""", ("gold_daily_sales",))
cte("gold_monthly_sales", f"""
SELECT year_month, year, month, region, segment, CAST(num_orders AS BIGINT) AS num_orders, total_quantity,
  net_revenue, gross_revenue, total_cost, total_profit, avg_discount,
  {growth('net_revenue', 'LAG(net_revenue, 1) OVER (PARTITION BY region, segment ORDER BY year_month)')} AS mom_growth_pct,
  {growth('net_revenue', 'LAG(net_revenue, 1) OVER (PARTITION BY region, segment, month ORDER BY year)')} AS yoy_growth_pct,
  {ratio_pct('total_profit', 'net_revenue')} AS profit_margin_pct
FROM monthly_base""", ("monthly_base",))
cte("monthly_base_v", f"""
SELECT dd.year_month, dd.year, dd.month, ds.region, ds.segment, {_MONTHLY_AGG.replace('(num_orders', '(ds.num_orders')}
FROM gold_daily_sales ds JOIN dim_date dd ON ds.sale_date = dd.date_key
GROUP BY dd.year_month, dd.year, dd.month, ds.region, ds.segment""", ("gold_daily_sales", "dim_date"))
cte("gold_monthly_sales_v", f"""
SELECT year_month, year, month, region, segment, CAST(num_orders AS BIGINT) AS num_orders, total_quantity,
  net_revenue, gross_revenue, total_cost, total_profit, avg_discount,
  {ratio_pct('total_profit', 'net_revenue')} AS profit_margin_pct,
  {growth('net_revenue', 'LAG(net_revenue, 1) OVER (PARTITION BY region, segment ORDER BY year_month)')} AS mom_growth_pct,
  {growth('net_revenue', 'LAG(net_revenue, 12) OVER (PARTITION BY region, segment ORDER BY year_month)')} AS yoy_growth_pct
FROM monthly_base_v""", ("monthly_base_v",))

_RFM_AGG = f"""
  COUNT(DISTINCT order_key) AS frequency, SUM(total_price) AS monetary,
  MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
  {rhu(avg('total_price'), 2)} AS avg_order_value"""
cte("rfm_base", f"""
SELECT customer_key, market_segment, customer_nation, customer_region,
  CAST(date_diff('day', MAX(order_date), (SELECT MAX(order_date) FROM fact_orders)) AS INTEGER) AS recency_days,
  {_RFM_AGG}
FROM fact_orders GROUP BY customer_key, market_segment, customer_nation, customer_region""", ("fact_orders",))
_SCORES = """
  CAST(NTILE(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_key ASC NULLS FIRST) AS INTEGER) AS r_score,
  CAST(NTILE(5) OVER (ORDER BY frequency ASC NULLS FIRST, customer_key ASC NULLS FIRST) AS INTEGER) AS f_score,
  CAST(NTILE(5) OVER (ORDER BY monetary ASC NULLS FIRST, customer_key ASC NULLS FIRST) AS INTEGER) AS m_score"""
cte("rfm_scored", f"SELECT *, {_SCORES} FROM rfm_base", ("rfm_base",))
cte("gold_customer_rfm", """
SELECT customer_key, market_segment, customer_nation, customer_region, recency_days, frequency, monetary,
  first_order_date, last_order_date, avg_order_value, r_score, f_score, m_score,
  r_score + f_score + m_score AS rfm_score,
  CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
       WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers'
       WHEN r_score + f_score + m_score >= 8 THEN 'Potential Loyalists'
       WHEN r_score + f_score + m_score >= 6 THEN 'At Risk'
       WHEN r_score + f_score + m_score >= 4 THEN 'Needs Attention' ELSE 'Lost' END AS rfm_segment,
  CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER) AS customer_lifetime_days
FROM rfm_scored""", ("rfm_scored",))
cte("rfm_base_v", f"""
SELECT o.customer_key, c.market_segment, c.nation_name AS customer_nation, c.region_name AS customer_region,
  CAST(date_diff('day', MAX(o.order_date), DATE '1998-12-31') AS INTEGER) AS recency_days,
  COUNT(DISTINCT o.order_key) AS frequency, SUM(o.total_price) AS monetary,
  MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS last_order_date,
  {rhu(avg('o.total_price'), 2)} AS avg_order_value,
  CAST(date_diff('day', MIN(o.order_date), MAX(o.order_date)) AS INTEGER) AS customer_lifetime_days
FROM fact_orders o JOIN dim_customer c ON o.customer_key = c.customer_key
GROUP BY o.customer_key, c.market_segment, c.nation_name, c.region_name""", ("fact_orders", "dim_customer"))
cte("rfm_scored_v", f"SELECT *, {_SCORES} FROM rfm_base_v", ("rfm_base_v",))
cte("gold_customer_rfm_v", """
SELECT customer_key, market_segment, customer_nation, customer_region, recency_days, frequency, monetary,
  first_order_date, last_order_date, avg_order_value, customer_lifetime_days, r_score, f_score, m_score,
  r_score + f_score + m_score AS rfm_score,
  CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
       WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
       WHEN r_score >= 3 AND f_score >= 2 THEN 'Potential Loyalists'
       WHEN r_score >= 2 AND f_score >= 2 THEN 'Needs Attention'
       WHEN r_score >= 2 THEN 'At Risk' ELSE 'Lost' END AS rfm_segment
FROM rfm_scored_v""", ("rfm_scored_v",))

cte("gold_product_performance", f"""
SELECT brand, part_type, price_band, manufacturer, SUM(quantity) AS total_quantity_sold,
  SUM(net_revenue) AS net_revenue, SUM(profit) AS total_profit, SUM(supply_cost) AS total_cost,
  COUNT(DISTINCT order_key) AS num_orders, {rhu(avg('discount'), 4)} AS avg_discount,
  {pct_if("return_flag = 'R'")} AS return_rate_pct,
  {ratio_pct('SUM(profit)', 'SUM(net_revenue)')} AS profit_margin_pct,
  {rhu(ratio('SUM(net_revenue)', 'COUNT(DISTINCT order_key)'), 2)} AS avg_revenue_per_order
FROM fact_lineitem GROUP BY brand, part_type, price_band, manufacturer""", ("fact_lineitem",))


def _supplier(on_time: str) -> str:
    return f"""
SELECT supplier_key, supplier_name, supplier_nation, supplier_region, COUNT(*) AS total_line_items,
  COUNT(DISTINCT order_key) AS num_orders, SUM(quantity) AS total_quantity, SUM(net_revenue) AS net_revenue,
  SUM(profit) AS total_profit, {rhu(avg('delivery_delay_days'), 1)} AS avg_delivery_delay_days,
  {rhu(avg('ship_delay_days'), 1)} AS avg_ship_delay_days,
  {pct_if(f'{on_time} <= 0')} AS on_time_delivery_pct, {pct_if("return_flag = 'R'")} AS return_rate_pct,
  {ratio_pct('SUM(profit)', 'SUM(net_revenue)')} AS profit_margin_pct
FROM fact_lineitem GROUP BY supplier_key, supplier_name, supplier_nation, supplier_region"""


cte("gold_supplier_scorecard", _supplier("delivery_delay_days"), ("fact_lineitem",))
cte("gold_supplier_scorecard_v", _supplier("ship_delay_days"), ("fact_lineitem",))


def _shipping(on_time: str) -> str:
    return f"""
SELECT li.ship_mode, o.customer_region, COUNT(*) AS total_shipments, SUM(li.quantity) AS total_quantity,
  SUM(li.net_revenue) AS net_revenue, {rhu(avg('li.delivery_delay_days'), 1)} AS avg_delivery_delay_days,
  {rhu(avg('li.ship_delay_days'), 1)} AS avg_ship_delay_days,
  {pct_if(f'li.{on_time} <= 0')} AS on_time_pct, {pct_if("li.return_flag = 'R'")} AS return_rate_pct
FROM fact_lineitem li JOIN fact_orders o ON li.order_key = o.order_key
GROUP BY li.ship_mode, o.customer_region"""


cte("gold_shipping_analysis", _shipping("delivery_delay_days"), ("fact_lineitem", "fact_orders"))
cte("gold_shipping_analysis_v", _shipping("ship_delay_days"), ("fact_lineitem", "fact_orders"))

cte("exec_base", f"""
SELECT CAST(order_year AS VARCHAR) || '-Q' || CAST(order_quarter AS VARCHAR) AS year_quarter, order_year,
  order_quarter, COUNT(DISTINCT order_key) AS total_orders, COUNT(DISTINCT customer_key) AS active_customers,
  SUM(total_price) AS gross_order_value, {rhu(avg('total_price'), 2)} AS avg_order_value
FROM fact_orders GROUP BY 1, order_year, order_quarter""", ("fact_orders",))


def _exec(order: str) -> str:
    lag_g = f"LAG(gross_order_value, 1) OVER (ORDER BY {order})"
    lag_c = f"LAG(active_customers, 1) OVER (ORDER BY {order})"
    return f"""
SELECT year_quarter, order_year, order_quarter, total_orders, active_customers, gross_order_value,
  avg_order_value, {growth('gross_order_value', lag_g)} AS qoq_revenue_growth_pct,
  {growth('active_customers', lag_c)} AS qoq_customer_growth_pct,
  {rhu(ratio('gross_order_value', 'active_customers'), 2)} AS revenue_per_customer
FROM exec_base"""


cte("gold_executive_summary", _exec("year_quarter"), ("exec_base",))
cte("gold_executive_summary_v", _exec("order_year, order_quarter"), ("exec_base",))


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for dep in CTE[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(needs, select: str) -> str:
    """``WITH <needed CTEs in dependency order> <select>``."""
    order = _closure(needs)
    body = ",\n".join(f"{n} AS ({CTE[n][0].strip()})" for n in order)
    return f"WITH {body}\n{select.strip()}"

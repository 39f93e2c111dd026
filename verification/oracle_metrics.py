"""The metrics in DuckDB SQL over the same files, written from the definitions.

Each query is a chain of the table projections it needs plus its own SELECT.
"""

from __future__ import annotations

import re

TODAY = "DATE '2001-08-01'"

# The point-of-sale tables as projections of the star.
VIEWS = {
    "receipts": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CAST(o_orderkey AS VARCHAR) AS receipt_number,
               CASE WHEN o_orderkey % 20 = 0 THEN 'REFUND' ELSE 'SALE' END AS receipt_type,
               o_orderdate + to_hours(o_orderkey % 24) AS created_at,
               o_orderdate + to_hours(o_orderkey % 24) + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS updated_at,
               CASE WHEN o_orderkey % 97 = 0 THEN o_orderdate + to_hours(o_orderkey % 24)
                    + to_days(CAST(o_orderkey % 5 AS INTEGER)) END AS deleted_at,
               o_orderdate + to_hours(o_orderkey % 24) AS receipt_date,
               CASE WHEN o_orderkey % 50 = 7 THEN o_orderdate + to_hours(o_orderkey % 24) END AS cancelled_at,
               CASE WHEN o_orderkey % 20 = 0 THEN -o_totalprice ELSE o_totalprice END AS total_money,
               CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice * 5e-2 ELSE 0e0 END AS total_discount,
               CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2e-2 ELSE 0e0 END AS tip,
               CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               CAST(o_orderkey % 25 AS VARCHAR) AS employee_id,
               CAST(o_orderkey % 5 AS VARCHAR) AS store_id,
               CASE o_orderstatus WHEN 'F' THEN 'Dine in' WHEN 'O' THEN 'Takeaway' END AS dining_option
        FROM orders""",
    "receipt_line_items": """
        SELECT l_orderkey || '-' || l_linenumber AS id,
               CAST(l_orderkey AS VARCHAR) AS receipt_id,
               CAST(l_partkey AS VARCHAR) AS item_id,
               CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS variant_id,
               'Item ' || (l_partkey // 25) AS item_name,
               l_quantity AS quantity,
               9e2 + (l_partkey % 2000) / 1e1 AS price,
               l_extendedprice * (1e0 - l_discount) AS total_money,
               CASE WHEN l_partkey % 11 <> 0 THEN (9e2 + (l_partkey % 2000) / 1e1) * 6e-1 END AS cost,
               l_quantity * CASE WHEN l_partkey % 11 <> 0
                   THEN (9e2 + (l_partkey % 2000) / 1e1) * 6e-1 END AS cost_total
        FROM lineitem""",
    "receipt_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS receipt_id,
               o_orderpriority AS payment_type_id,
               CASE WHEN o_orderkey % 20 = 0 THEN -o_totalprice ELSE o_totalprice END
                 * CASE WHEN o_orderkey % 10 = 3 THEN 6e-1 ELSE 1e0 END AS money_amount
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), '1-URGENT',
               CASE WHEN o_orderkey % 20 = 0 THEN -o_totalprice ELSE o_totalprice END * 4e-1
        FROM orders WHERE o_orderkey % 10 = 3""",
    "items": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
               CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS category_id,
               TIMESTAMP '1999-01-01' + to_days(CAST(p_partkey % 700 AS INTEGER)) AS created_at,
               TIMESTAMP '1999-01-01' + to_days(CAST(p_partkey % 700 + p_partkey % 11 AS INTEGER)) AS updated_at,
               CASE WHEN p_partkey % 19 = 0 THEN TIMESTAMP '1999-01-01'
                 + to_days(CAST(p_partkey % 700 + p_partkey % 11 AS INTEGER)) END AS deleted_at
        FROM part""",
    "variants": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey AS VARCHAR) AS item_id,
               'SKU-' || p_partkey AS sku, p_retailprice * 6e-1 AS cost
        FROM part""",
    "categories": """
        SELECT DISTINCT p_type AS id, upper(p_type[1]) || lower(p_type[2:]) AS name FROM part""",
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
               'c' || c_custkey || '@' || CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
                 THEN 'gmail.com' ELSE 'example.org' END AS email,
               CASE WHEN c_custkey % 17 <> 0 THEN TIMESTAMP '1995-01-01'
                 + to_days(CAST(c_custkey * 37 % 2400 AS INTEGER)) END AS first_visit,
               TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey * 37 % 2400 + c_custkey % 400 AS INTEGER))
                 + to_hours(c_custkey % 13) AS last_visit,
               CAST(c_custkey % 9 AS INTEGER) AS total_visits, c_acctbal AS total_spent,
               TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey % 700 AS INTEGER)) AS created_at,
               TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey % 700 + c_custkey % 11 AS INTEGER)) AS updated_at,
               CASE WHEN c_custkey % 19 = 0 THEN TIMESTAMP '1999-01-01'
                 + to_days(CAST(c_custkey % 700 + c_custkey % 11 AS INTEGER)) END AS deleted_at
        FROM customer""",
    "employees": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "stores": "SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS name FROM region",
    "payment_types": """
        SELECT name AS id, name FROM (
          SELECT CASE r_regionkey WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH'
                 WHEN 2 THEN '3-MEDIUM' WHEN 3 THEN '4-NOT SPECIFIED' END AS name FROM region)
        WHERE name IS NOT NULL""",
    "inventory": """
        SELECT CAST(p_partkey AS VARCHAR) AS variant_id, CAST(s AS VARCHAR) AS store_id,
               CAST((p_partkey * 7 + s * 3) % 23 - 1 AS INTEGER) AS in_stock
        FROM part, range(5) AS t(s)""",
    "variant_store": """
        SELECT CAST(p_partkey AS VARCHAR) AS variant_id, CAST(s AS VARCHAR) AS store_id,
               CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey % 9 AS DOUBLE) END AS low_stock_threshold
        FROM part, range(5) AS t(s) WHERE p_partkey % 3 = 0""",
    # shared building blocks
    "sales": "SELECT * FROM receipts WHERE receipt_type = 'SALE' AND cancelled_at IS NULL",
    "sold_lines": """
        SELECT l.*, r.receipt_number, r.receipt_date, r.store_id
        FROM receipt_line_items l JOIN sales r ON l.receipt_id = r.receipt_number""",
    "category_lines": """
        SELECT l.*, COALESCE(c.name, 'Uncategorised') AS category
        FROM sold_lines l JOIN items i ON l.item_id = i.id LEFT JOIN categories c ON i.category_id = c.id""",
}


def with_views(select: str) -> str:
    """Prefix the views the statement mentions, and those they mention."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    head, sep, rest = select.strip().partition("WITH ")
    if sep and not head:
        return f"WITH {views},\n{rest}"
    return f"WITH {views}\n{select}"


def rnd(x: str, digits: int) -> str:
    return f"(sign({x}) * floor(abs({x}) * 1e{digits} + 0.5) / 1e{digits})"


def total(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def share(x: str) -> str:
    return rnd(f"(CAST({x} AS DOUBLE) * 1e2 / NULLIF(SUM(CAST({x} AS DOUBLE)) OVER (), 0))", 1)


def since(days: int, column: str = "receipt_date") -> str:
    return f"{column} >= {TODAY} - {days - 1}"


def pct(part: str, whole: str, digits: int) -> str:
    return rnd(f"({part} / NULLIF({whole}, 0) * 1e2)", digits)


COUNT = "COUNT(*) AS tx_count"
MONEY = total("total_money")
AVG_TICKET = rnd(f"({MONEY} / COUNT(total_money))", 2) + " AS avg_ticket"
REVENUE = rnd(MONEY, 2) + " AS revenue"
COST = "CAST(COALESCE(SUM(CAST(cost_total AS DECIMAL(18,4))), 0) AS DOUBLE)"
PROFIT = (
    "CAST(SUM(CAST(total_money AS DECIMAL(18,4))) "
    "- COALESCE(SUM(CAST(cost_total AS DECIMAL(18,4))), 0) AS DOUBLE)"
)
MARGIN_PCT = pct(PROFIT, MONEY, 1)
MARGINS = (
    f"{REVENUE}, {rnd(COST, 2)} AS cost, {rnd(PROFIT, 2)} AS gross_profit, {MARGIN_PCT} AS margin_pct"
)
DAY = "CAST(receipt_date AS DATE)"
MONTH = "CAST(date_trunc('month', receipt_date) AS DATE)"


def daily_revenue(where: str) -> str:
    return (
        f"SELECT {DAY} AS date, {MONEY} AS revenue, {COUNT}, {AVG_TICKET} "
        f"FROM sales WHERE {where} GROUP BY 1"
    )


def growth(unit: str, n: int, where: str = "TRUE") -> str:
    change = pct("(revenue - prev_revenue)", "prev_revenue", 1)
    return f"""
        WITH p AS (SELECT CAST(date_trunc('{unit}', receipt_date) AS DATE) AS period,
                          {MONEY} AS revenue, {COUNT} FROM sales WHERE {where} GROUP BY 1),
        g AS (SELECT *, lag(revenue) OVER (ORDER BY period) AS prev_revenue FROM p)
        SELECT *, {change} AS pct_change FROM g ORDER BY period DESC LIMIT {n}"""


def revenue_by_category(where: str) -> str:
    return f"""
        WITH g AS (SELECT category, COUNT(DISTINCT receipt_number) AS tx_count,
                          {MONEY} AS money, {total('quantity')} AS units_sold
                   FROM category_lines WHERE {where} GROUP BY 1)
        SELECT category, tx_count, {rnd('money', 2)} AS revenue, units_sold,
               {share('money')} AS pct_share FROM g"""


def top_items(where: str, n: int) -> str:
    return f"""
        SELECT item_name AS item, {total('quantity')} AS total_qty, {rnd(MONEY, 2)} AS total_revenue,
               COUNT(DISTINCT receipt_number) AS tx_count
        FROM sold_lines WHERE {where} GROUP BY 1 ORDER BY total_revenue DESC, item LIMIT {n}"""


def basket(where: str) -> str:
    return f"""
        WITH b AS (SELECT receipt_number, COUNT(id) AS lines FROM sold_lines WHERE {where} GROUP BY 1)
        SELECT COALESCE({rnd('(CAST(SUM(lines) AS DOUBLE) / COUNT(*))', 1)}, 0e0) AS average,
               MIN(lines) AS min_items,
               CAST(percentile_cont(0.25) WITHIN GROUP (ORDER BY lines) AS DOUBLE) AS p25,
               CAST(percentile_cont(0.50) WITHIN GROUP (ORDER BY lines) AS DOUBLE) AS p50,
               CAST(percentile_cont(0.75) WITHIN GROUP (ORDER BY lines) AS DOUBLE) AS p75,
               MAX(lines) AS max_items FROM b"""


def new_vs_returning(where: str) -> str:
    return f"""
        SELECT CAST(r.receipt_date AS DATE) AS date, COUNT(*) AS total_tx,
               COUNT(DISTINCT r.customer_id) AS unique_customers,
               COUNT(DISTINCT CASE WHEN c.first_visit >= CAST(r.receipt_date AS DATE)
                     THEN r.customer_id END) AS new_customers,
               COUNT(DISTINCT CASE WHEN c.first_visit < CAST(r.receipt_date AS DATE)
                     THEN r.customer_id END) AS returning_customers
        FROM sales r LEFT JOIN customers c ON r.customer_id = c.id
        WHERE r.customer_id IS NOT NULL AND {where} GROUP BY 1"""


def visits(days: int | None) -> str:
    bound = since(days) if days else "TRUE"
    return (
        "v AS (SELECT customer_id, COUNT(DISTINCT receipt_number) AS visits FROM sales "
        f"WHERE customer_id IS NOT NULL AND {bound} GROUP BY 1)"
    )


# every day between the first and the last, those without sales at 0
ON_DAYS = """
    WITH d AS (SELECT {day} AS date, {money} AS revenue, {count} FROM sales WHERE {where} GROUP BY 1),
    a AS (SELECT unnest(range(MIN(date), MAX(date) + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS date FROM d),
    e AS (SELECT a.date, COALESCE(d.revenue, 0e0) AS revenue, COALESCE(d.tx_count, 0) AS tx_count
          FROM a LEFT JOIN d ON a.date = d.date)"""


def moving_average_of_days(window: int, where: str) -> str:
    average = "(CAST(SUM(CAST(x.revenue AS DECIMAL(28,4))) AS DOUBLE) / COUNT(*))"
    return ON_DAYS.format(day=DAY, money=MONEY, count=COUNT, where=where) + f"""
        SELECT e.date, e.revenue, e.tx_count, {rnd(average, 2)} AS ma_{window}d
        FROM e JOIN e x ON x.date BETWEEN e.date - {window - 1} AND e.date GROUP BY ALL"""


def week_before(where: str) -> str:
    return ON_DAYS.format(day=DAY, money=MONEY, count=COUNT, where=where) + f"""
        SELECT e.date, e.revenue, x.revenue AS prev_week_revenue,
               {pct('(e.revenue - x.revenue)', 'x.revenue', 1)} AS wow_change_pct
        FROM e LEFT JOIN e x ON x.date = e.date - 7"""


RFM = f"""
    WITH g AS (
      SELECT c.id AS customer_id, c.name,
             CAST({TODAY} - MAX(CAST(r.receipt_date AS DATE)) AS BIGINT) AS recency_days,
             COUNT(DISTINCT r.receipt_number) AS frequency,
             COALESCE({total('r.total_money')}, 0e0) AS spent
      FROM customers c LEFT JOIN sales r ON c.id = r.customer_id GROUP BY 1, 2),
    s AS (
      SELECT *, CAST(NTILE(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_id) AS BIGINT) AS r_score,
             CAST(NTILE(5) OVER (ORDER BY frequency, customer_id) AS BIGINT) AS f_score,
             CAST(NTILE(5) OVER (ORDER BY spent, customer_id) AS BIGINT) AS m_score FROM g)
    SELECT customer_id, name, recency_days, frequency, {rnd('spent', 2)} AS monetary,
           r_score, f_score, m_score, r_score * 100 + f_score * 10 + m_score AS rfm_cell,
           CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                WHEN r_score >= 4 AND f_score >= 3 THEN 'Loyal'
                WHEN f_score >= 4 AND m_score >= 4 THEN 'Big Spenders'
                WHEN r_score >= 4 THEN 'New/Recent'
                WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
                WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                ELSE 'Average' END AS segment
    FROM s"""


def employee(select: str, where: str, group: str = "1") -> str:
    return f"""
        SELECT {select} FROM sales r JOIN (SELECT id, name AS employee FROM employees) e
          ON r.employee_id = e.id WHERE {where} GROUP BY {group}"""


def payment_split(where: str) -> str:
    return f"""
        WITH g AS (
          SELECT COALESCE(t.name, 'Unknown') AS payment_type,
                 COUNT(DISTINCT r.receipt_number) AS tx_count,
                 {total('COALESCE(p.money_amount, r.total_money)')} AS money
          FROM sales r LEFT JOIN receipt_payments p ON p.receipt_id = r.receipt_number
               LEFT JOIN payment_types t ON p.payment_type_id = t.id
          WHERE {where} GROUP BY 1)
        SELECT payment_type, tx_count, {rnd('money', 2)} AS revenue,
               {share('tx_count')} AS tx_pct, {share('money')} AS revenue_pct FROM g"""


def moving_average(window: int, where: str) -> str:
    average = (
        f"(CAST(SUM(CAST(revenue AS DECIMAL(28,4))) OVER w AS DOUBLE) / COUNT(revenue) OVER w)"
    )
    return f"""
        WITH d AS (SELECT {DAY} AS date, {MONEY} AS revenue, {COUNT} FROM sales WHERE {where} GROUP BY 1)
        SELECT date, revenue, tx_count, {rnd(average, 2)} AS ma_{window}d
        FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"""


def lagged(days: int, step: int, previous: str | None, change: str, count: bool, extra="TRUE") -> str:
    keep = f"{previous}," if previous else ""
    tx = "tx_count," if count else ""
    prev = previous or "prev"
    return f"""
        WITH d AS (SELECT {DAY} AS date, {MONEY} AS revenue, {COUNT} FROM sales
                   WHERE {since(days)} AND {extra} GROUP BY 1),
        g AS (SELECT *, lag(revenue, {step}) OVER (ORDER BY date) AS {prev} FROM d)
        SELECT date, revenue, {tx} {keep} {pct(f'(revenue - {prev})', prev, 1)} AS {change} FROM g"""


MONTHLY = f"""
    WITH m AS (SELECT {MONTH} AS month, {MONEY} AS revenue, {COUNT},
                      COUNT(DISTINCT customer_id) AS unique_customers, {AVG_TICKET}
               FROM sales WHERE %s GROUP BY 1),
    g AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS prev_month_revenue FROM m)
    SELECT *, {pct('(revenue - prev_month_revenue)', 'prev_month_revenue', 1)} AS mom_change_pct
    FROM g ORDER BY month DESC LIMIT %d"""


def daily_margin(where: str) -> str:
    return f"SELECT {DAY} AS date, {MARGINS} FROM sold_lines WHERE {where} GROUP BY 1"


def profit_margins(where: str, order: str, n: int) -> str:
    return f"""
        SELECT item_name AS item, {total('quantity')} AS qty_sold, {MARGINS}
        FROM sold_lines WHERE {where} GROUP BY 1 ORDER BY {order} DESC NULLS LAST, item LIMIT {n}"""


def turnover(where: str, days: int, stock_where: str, n: int) -> str:
    on_hand = "CAST(k.stock AS DOUBLE)"
    rate = rnd(f"(s.units_sold / GREATEST({on_hand}, 1e0))", 1)
    left = rnd(f"(GREATEST({on_hand}, 0e0) / (s.units_sold / {days}e0))", 0)
    return f"""
        WITH s AS (SELECT item_name, COALESCE(variant_id, item_id) AS vid, {total('quantity')} AS units_sold
                   FROM sold_lines WHERE {where} GROUP BY 1, 2),
        k AS (SELECT variant_id, CAST(SUM(in_stock) AS BIGINT) AS stock FROM inventory
              WHERE {stock_where} GROUP BY 1)
        SELECT item_name AS item, COALESCE(v.sku, 'N/A') AS variant_sku, units_sold,
               COALESCE(k.stock, 0) AS current_stock,
               {rnd("COALESCE(CASE WHEN k.stock IS NOT NULL THEN v.cost END, 0e0)", 2)} AS avg_cost,
               {rate} AS turnover_rate, {left} AS days_to_sell
        FROM s LEFT JOIN k ON s.vid = k.variant_id LEFT JOIN variants v ON s.vid = v.id
        WHERE units_sold > 0 ORDER BY turnover_rate DESC, item, vid LIMIT {n}"""


DESCRIBED = """LEFT JOIN variants v ON inv.variant_id = v.id LEFT JOIN items i ON v.item_id = i.id"""
NAMED = "COALESCE(i.name, 'Unknown') AS item_name, COALESCE(v.sku, 'N/A') AS variant_sku"
WORTH = rnd("(inv.in_stock * COALESCE(v.cost, 0e0))", 2)


def stock_value(where: str) -> str:
    return f"""
        SELECT {NAMED}, inv.in_stock, {rnd('COALESCE(v.cost, 0e0)', 2)} AS unit_cost, {WORTH} AS stock_value
        FROM inventory inv {DESCRIBED} WHERE inv.in_stock > 0 AND {where}"""


def low_stock(threshold: int, where: str) -> str:
    return f"""
        WITH z AS (SELECT variant_id, MAX(receipt_date) AS last_sold FROM sold_lines
                   WHERE variant_id IS NOT NULL GROUP BY 1)
        SELECT {NAMED}, inv.in_stock AS current_stock,
               COALESCE(t.low_stock_threshold, {threshold}e0) AS alert_threshold,
               s.name AS store_name, z.last_sold
        FROM inventory inv {DESCRIBED} LEFT JOIN stores s ON inv.store_id = s.id
             LEFT JOIN variant_store t ON inv.variant_id = t.variant_id AND inv.store_id = t.store_id
             LEFT JOIN z ON z.variant_id = inv.variant_id
        WHERE inv.in_stock <= COALESCE(t.low_stock_threshold, {threshold}) AND {where}"""


def never_sold(days: int) -> str:
    return f"""
        SELECT {NAMED}, inv.in_stock AS current_stock, {WORTH} AS tied_up_value
        FROM inventory inv {DESCRIBED}
        WHERE inv.in_stock > 0 AND inv.variant_id NOT IN (
          SELECT COALESCE(variant_id, item_id) FROM sold_lines WHERE {since(days)})"""


METRICS = {
    "a01_daily_revenue": daily_revenue(since(30)),
    "a01_daily_revenue_store_range": daily_revenue(
        "store_id = '3' AND receipt_date >= DATE '1998-03-01' AND receipt_date < DATE '1998-07-01'"
    ),
    "a02_revenue_by_store": f"""
        SELECT s.store_name, {COUNT}, {REVENUE}, {AVG_TICKET}
        FROM sales r JOIN (SELECT id, name AS store_name FROM stores) s ON r.store_id = s.id
        WHERE {since(30)} GROUP BY 1""",
    "a03_revenue_growth_month": growth("month", 12),
    "a03_revenue_growth_week_store": growth("week", 26, "store_id = '2'"),
    "a04_total_revenue": f"SELECT COALESCE({MONEY}, 0e0) AS total_revenue FROM sales WHERE {since(30)}",
    "a05_total_revenue_by_month": f"""
        SELECT strftime(receipt_date, '%Y-%m') AS month, {REVENUE}, {COUNT}, {AVG_TICKET}
        FROM sales WHERE {since(365)} GROUP BY 1""",
    "a06_refund_rate": f"""
        WITH g AS (SELECT {DAY} AS date,
               {total("CASE WHEN receipt_type = 'REFUND' THEN total_money ELSE 0 END")} AS refunds,
               {total("CASE WHEN receipt_type = 'SALE' THEN total_money ELSE 0 END")} AS sales
          FROM receipts WHERE cancelled_at IS NULL AND {since(365)} GROUP BY 1)
        SELECT date, refunds, sales, {pct('abs(refunds)', 'sales', 2)} AS refund_pct FROM g""",
    "a07_revenue_by_category": revenue_by_category(since(30)),
    "a07_revenue_by_category_all_time": revenue_by_category("TRUE"),
    "a08_top_items": top_items(since(30), 10),
    "a09_items_per_transaction": basket(since(30)),
    "a09_items_per_transaction_all_time": basket("TRUE"),
    "a10_category_mix_trend": f"""
        SELECT {MONTH} AS month, category, {REVENUE} FROM category_lines WHERE {since(90)} GROUP BY 1, 2""",
    "a11_new_vs_returning": new_vs_returning(since(30, "r.receipt_date")),
    "a11_new_vs_returning_all_time": new_vs_returning("TRUE"),
    "a12_rfm_analysis": RFM,
    "a12_inactive_lowest": RFM.replace("DESC NULLS LAST", "DESC NULLS FIRST"),
    "a13_top_customers": f"""
        SELECT c.id AS customer_id, c.name, COUNT(DISTINCT r.receipt_number) AS visits,
               {rnd(MONEY, 2)} AS total_spent, {AVG_TICKET}
        FROM sales r JOIN customers c ON r.customer_id = c.id WHERE {since(365)}
        GROUP BY 1, 2 ORDER BY total_spent DESC, customer_id LIMIT 10""",
    "a14_unique_customers": f"""
        SELECT COUNT(DISTINCT customer_id) AS unique_customers FROM sales WHERE {since(30)}""",
    "a15_retention_rate": f"""
        WITH {visits(365)} SELECT COALESCE({rnd('(CAST(COUNT(CASE WHEN visits > 1 THEN 1 END) AS DOUBLE) * 1e2 / NULLIF(COUNT(*), 0))', 1)}, 0e0)
          AS retention_rate FROM v""",
    "a16_customer_visit_distribution": f"""
        WITH {visits(365)}, g AS (SELECT visits, COUNT(*) AS customer_count FROM v GROUP BY 1)
        SELECT visits, customer_count, {share('customer_count')} AS pct FROM g""",
    "a17_revenue_by_employee": employee(
        f"employee, {COUNT}, {REVENUE}, {AVG_TICKET}, {rnd(total('tip'), 2)} AS total_tips", since(30)
    ),
    "a18_employee_daily_summary": employee(
        f"{DAY} AS date, employee, {COUNT}, {REVENUE}", since(365), "1, 2"
    ),
    "a19_tip_by_employee": employee(
        f"employee, {rnd(total('tip'), 2)} AS total_tips, {rnd('(' + total('tip') + ' / COUNT(*))', 2)} AS avg_tip, "
        f"{pct(total('tip'), MONEY, 1)} AS tip_rate_pct",
        since(30),
    ),
    "a20_peak_hours": f"""
        WITH g AS (SELECT CAST(extract(hour FROM receipt_date) AS BIGINT) AS hour, {COUNT}, {REVENUE}
                   FROM sales WHERE {since(30)} GROUP BY 1)
        SELECT *, {share('tx_count')} AS pct_of_day FROM g""",
    "a21_peak_days": f"""
        SELECT dayname(receipt_date) AS day_name, {COUNT}, {REVENUE}, {AVG_TICKET}
        FROM sales WHERE {since(90)} GROUP BY 1""",
    "a22_payment_method_split": payment_split(since(30)),
    "a22_payment_method_split_all_time": payment_split("TRUE"),
    "a23_discount_analysis": f"""
        SELECT {DAY} AS date, {COUNT}, {rnd(MONEY, 2)} AS gross_revenue,
               {rnd(total('total_discount'), 2)} AS discounts,
               {pct(total('total_discount'), f"({MONEY} + {total('total_discount')})", 1)} AS discount_rate_pct
        FROM sales WHERE {since(365)} GROUP BY 1""",
    "a24_tip_analysis": f"""
        SELECT {DAY} AS date, {COUNT}, {rnd(total('tip'), 2)} AS total_tips,
               {rnd('(' + total('tip') + ' / COUNT(tip))', 2)} AS avg_tip,
               {pct(total('tip'), MONEY, 1)} AS tip_rate_pct
        FROM sales WHERE {since(365)} GROUP BY 1""",
    "a25_dining_option_split": f"""
        SELECT COALESCE(dining_option, 'Unspecified') AS dining_option, {COUNT}, {REVENUE}, {AVG_TICKET}
        FROM sales WHERE {since(30)} GROUP BY 1""",
    "a26_moving_average_revenue": moving_average(7, since(90)),
    "a26_moving_average_28_days": moving_average(28, f"{since(365)} AND store_id = '1'"),
    "a27_week_over_week_growth": lagged(90, 7, "prev_week_revenue", "wow_change_pct", False),
    "a26_calendar": moving_average_of_days(
        7, "receipt_date >= DATE '1998-01-01' AND receipt_date < DATE '2000-01-01' AND store_id = '1'"
    ),
    "a27_calendar": week_before(since(365)),
    "a28_monthly_summary": MONTHLY % ("TRUE", 12),
    "a29_day_over_day": lagged(30, 1, None, "dod_change_pct", True),
    "a30_gross_profit": daily_margin(since(30)),
    "a30_gross_profit_all_time": daily_margin("TRUE"),
    "a31_profit_by_category": f"""
        SELECT category, {MARGINS} FROM category_lines WHERE {since(365)} GROUP BY 1""",
    "a32_profit_margins": profit_margins(since(365), "gross_profit", 20),
    "a32_profit_margins_by_margin": profit_margins(since(365), "margin_pct", 20),
    "a32_profit_margins_by_revenue": profit_margins("TRUE", "revenue", 20),
    "a33_margin_trend": f"""
        WITH d AS ({daily_margin(since(90))}),
        g AS (SELECT *, lag(margin_pct) OVER (ORDER BY date) AS prev_margin_pct FROM d)
        SELECT *, {rnd('(margin_pct - prev_margin_pct)', 1)} AS margin_change FROM g""",
    "a34_overall_margin": f"""
        SELECT COALESCE({MARGIN_PCT}, 0e0) AS overall_margin_pct FROM sold_lines
        WHERE {since(30)} AND store_id = '4'""",
    "a35_items_without_cost": f"""
        SELECT item_name AS item, COUNT(*) AS times_sold, {rnd(MONEY, 2)} AS total_revenue
        FROM sold_lines WHERE cost IS NULL OR cost_total IS NULL GROUP BY 1""",
    "a36_turnover": turnover(since(30), 30, "TRUE", 20),
    "a36_turnover_range_store": turnover(
        "receipt_date >= DATE '2000-01-01' AND receipt_date < DATE '2001-01-01'",
        366, "store_id = '2'", 50,
    ),
    "a37_stock_value": stock_value("TRUE"),
    "a37_stock_value_store": stock_value("inv.store_id = '1'"),
    "a38_total_inventory_value": f"""
        SELECT {rnd('COALESCE(' + total('inv.in_stock * v.cost') + ', 0e0)', 2)} AS total_inventory_value
        FROM inventory inv LEFT JOIN variants v ON inv.variant_id = v.id""",
    "a39_stock_value_by_store": f"""
        SELECT COALESCE(s.name, 'Unknown') AS store_name,
               COUNT(DISTINCT inv.variant_id) AS unique_variants,
               CAST(SUM(inv.in_stock) AS BIGINT) AS total_units,
               {rnd('COALESCE(' + total('inv.in_stock * v.cost') + ', 0e0)', 2)} AS stock_value
        FROM inventory inv LEFT JOIN variants v ON inv.variant_id = v.id
             LEFT JOIN stores s ON inv.store_id = s.id
        WHERE inv.in_stock > 0 GROUP BY 1""",
    "a40_low_stock": low_stock(5, "TRUE"),
    "a40_low_stock_store": low_stock(2, "inv.store_id = '3'"),
    "a41_items_never_sold": never_sold(30),
    "a41_items_never_sold_year": never_sold(365),
    "e1_top_customers_all_time": f"""
        SELECT name, receipt_count, total_spent FROM (
          SELECT c.id, c.name, COUNT(DISTINCT r.receipt_number) AS receipt_count,
                 {total('r.total_money')} AS total_spent
          FROM customers c JOIN receipts r ON c.id = r.customer_id
          WHERE r.receipt_type = 'SALE' GROUP BY 1, 2 ORDER BY total_spent DESC, c.id LIMIT 10)""",
    "e2_daily_receipts": f"""
        SELECT {DAY} AS date, COUNT(*) AS receipt_count, {MONEY} AS revenue FROM receipts
        WHERE receipt_type = 'SALE' AND receipt_date >= {TODAY} - 30 GROUP BY 1""",
    "e3_best_sellers": f"""
        SELECT name, units_sold, revenue FROM (
          SELECT i.id, i.name, {total('l.quantity')} AS units_sold,
                 {total('l.quantity * l.price')} AS revenue
          FROM items i JOIN receipt_line_items l ON i.id = l.item_id
               JOIN receipts r ON l.receipt_id = r.receipt_number
          WHERE r.receipt_type = 'SALE' GROUP BY 1, 2 ORDER BY units_sold DESC, i.id LIMIT 10)""",
    "e4_customer_lifetime_value": """
        SELECT name, total_visits, total_spent,
               total_spent / NULLIF(CAST(total_visits AS DOUBLE), 0) AS avg_per_visit
        FROM customers WHERE total_visits > 0 ORDER BY total_spent DESC, id LIMIT 20""",
    "e5_catalogue_by_category": """
        SELECT c.name AS category, COUNT(DISTINCT i.id) AS item_count,
               COUNT(DISTINCT v.id) AS variant_count
        FROM categories c LEFT JOIN items i ON c.id = i.category_id
             LEFT JOIN variants v ON i.id = v.item_id GROUP BY c.id, c.name""",
    "e6_customers_by_email_domain": """
        SELECT id, name, email FROM customers WHERE ends_with(email, '@gmail.com')""",
    "e7_customer_tenure": """
        SELECT id, CAST(date_diff('second', first_visit, last_visit) AS BIGINT) AS tenure_seconds,
               CAST(date_diff('second', first_visit, last_visit) // 86400 AS BIGINT) AS tenure_days
        FROM customers WHERE first_visit IS NOT NULL""",
}

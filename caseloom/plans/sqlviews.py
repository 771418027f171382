"""SQL text of the business-case tables, for the oracles: the same rules as ``sources.views``, in DuckDB's dialect."""

from __future__ import annotations

ORDER_TIME = "o_orderdate + to_hours(8) + to_seconds(CAST(floor(o_totalprice / 10) AS BIGINT))"

VIEWS = {
    "sales": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, l_partkey AS product_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "menu": """
        SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part""",
    "members": """
        SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS DATE) + 365 AS join_date
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1""",
    "raw_runs": f"""
        SELECT o_orderkey AS order_id, CAST(o_orderpriority[1] AS BIGINT) AS runner_id,
          CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE strftime(
            {ORDER_TIME} + to_seconds(300 + CAST(floor(o_totalprice / 250) AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS pickup_time,
          CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE
            (CAST(floor(o_totalprice / 2000) AS BIGINT) // 10) || '.' || (CAST(floor(o_totalprice / 2000) AS BIGINT) % 10) ||
            CASE WHEN month(o_orderdate) <= 4 THEN '' WHEN month(o_orderdate) <= 8 THEN 'km' ELSE ' km' END END AS distance,
          CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE (CAST(floor(o_totalprice / 20000) AS BIGINT) + 8) ||
            CASE WHEN day(o_orderdate) <= 6 THEN '' WHEN month(o_orderdate) <= 3 THEN ' minutes'
              WHEN month(o_orderdate) <= 6 THEN ' mins' WHEN month(o_orderdate) <= 9 THEN 'minutes'
              WHEN month(o_orderdate) <= 11 THEN 'mins' ELSE ' minute' END END AS duration,
          CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN 'Restaurant Cancellation'
            WHEN o_orderstatus = 'F' THEN 'Customer Cancellation' WHEN o_orderstatus = 'O' THEN ''
            WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'null' END AS cancellation
        FROM orders""",
    "runs": f"""
        SELECT o_orderkey AS order_id, CAST(o_orderpriority[1] AS BIGINT) AS runner_id,
          CASE WHEN o_orderstatus <> 'F' THEN
            date_trunc('second', {ORDER_TIME} + to_seconds(300 + CAST(floor(o_totalprice / 250) AS BIGINT))) END AS pickup_time,
          CASE WHEN o_orderstatus <> 'F' THEN CAST(floor(o_totalprice / 2000) AS BIGINT) / CAST(10 AS DOUBLE) END AS distance,
          CASE WHEN o_orderstatus <> 'F' THEN CAST(floor(o_totalprice / 20000) AS BIGINT) + 8 END AS duration,
          CASE WHEN o_orderstatus = 'F' THEN
            CASE WHEN o_totalprice < 200000 THEN 'Restaurant Cancellation' ELSE 'Customer Cancellation' END END AS cancellation
        FROM orders""",
    "raw_items": f"""
        SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS pizza_id, {ORDER_TIME} AS order_time,
          CASE WHEN l_tax = 0 THEN NULL WHEN l_linestatus = 'F' THEN '' WHEN l_returnflag = 'A' THEN 'null'
            WHEN l_returnflag = 'N' THEN CAST(l_linenumber AS VARCHAR)
            ELSE l_linenumber || ', ' || (l_linenumber + 8) END AS exclusions,
          CASE WHEN l_discount = 0 THEN NULL WHEN l_returnflag = 'N' THEN 'null' WHEN l_quantity < 15 THEN ''
            WHEN l_quantity < 30 THEN CAST(8 - l_linenumber AS VARCHAR)
            ELSE (8 - l_linenumber) || ', ' || (17 - l_linenumber) END AS extras
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT order_id, customer_id, pizza_id, order_time, nullif(nullif(exclusions, 'null'), '') AS exclusions,
          nullif(nullif(extras, 'null'), '') AS extras FROM raw_items""",
    "delivered": "SELECT * FROM runs WHERE distance IS NOT NULL",
    "delivered_items": "SELECT * FROM items JOIN delivered USING (order_id)",
    "prices": """
        SELECT p_partkey AS pizza_id, CASE p_type WHEN 'LARGE' THEN 12 ELSE 10 END AS price
        FROM part WHERE p_type IN ('LARGE', 'SMALL')""",
    "toppings": """
        SELECT row_number() OVER (ORDER BY topping_name) AS topping_id, topping_name
        FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS topping_name FROM part)""",
    "recipe_items": """
        SELECT p_partkey AS pizza_id, p_name AS pizza_name, topping_id, topping_name
        FROM (SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS topping_name FROM part) JOIN toppings USING (topping_name)""",
    "txns": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
          CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'purchase' WHEN 'P' THEN 'withdrawal' END AS txn_type,
          CAST(o_totalprice AS DECIMAL(12,2)) AS txn_amount, o_orderkey AS txn_id,
          CAST(date_trunc('month', o_orderdate) AS DATE) AS txn_month,
          CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE -1 END * CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS net
        FROM orders""",
    "closing": """
        SELECT customer_id, txn_month, sum(net) AS net_amount,
          sum(sum(net)) OVER (PARTITION BY customer_id ORDER BY txn_month) AS closing_balance
        FROM txns GROUP BY customer_id, txn_month""",
    "wallet": """
        SELECT user_id AS customer_id, ts AS txn_time, CAST(ts AS DATE) AS txn_date, event_id AS txn_id,
          CASE WHEN event_type IN ('purchase', 'signup') THEN 'deposit' WHEN event_type = 'error' THEN 'withdrawal'
            ELSE 'purchase' END AS txn_type,
          CAST(value AS DECIMAL(12,2)) AS txn_amount,
          CAST(CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE -1 END * CAST(value AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS net
        FROM events""",
    "nodes": """
        SELECT customer_id, CAST(n_regionkey AS BIGINT) AS region_id, node_id, start_date,
          greatest(start_date, coalesce(
            lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, node_id) - 1, DATE '9999-12-31')) AS end_date
        FROM (SELECT DISTINCT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS start_date,
                CAST(o_orderpriority[1] AS BIGINT) AS node_id FROM orders)
          JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey""",
    "stays": """
        SELECT customer_id, region_id, node_id, CAST(sum(end_date - start_date) AS BIGINT) AS days_stayed
        FROM nodes WHERE end_date <> DATE '9999-12-31' GROUP BY 1, 2, 3""",
    "clicks": """
        SELECT user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS visit_id, user_id,
          user_id || 'h' || hour(ts) AS cookie_id, CAST(json_extract(props, '$.k') AS BIGINT) AS page_id,
          CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS kind,
          event_id AS sequence_number, ts AS event_time
        FROM events""",
    "kinds": """
        SELECT * FROM (VALUES (1, 'Page View'), (2, 'Add to Cart'), (3, 'Purchase'), (4, 'Ad Impression'), (5, 'Ad Click'))
          AS k(kind, event_name)""",
    "site_pages": """
        SELECT p_partkey AS page_id, CASE WHEN p_size <= 5 THEN 'Checkout' ELSE p_name END AS page_name,
          CASE WHEN p_size > 5 THEN p_type END AS product_category, CASE WHEN p_size > 5 THEN p_partkey END AS product_id
        FROM part""",
    "buyers": "SELECT DISTINCT visit_id FROM clicks WHERE kind = 3",
    "product_funnel": """
        SELECT product_id, page_name, product_category,
          count(*) FILTER (kind = 1) AS views, count(*) FILTER (kind = 2) AS cart_adds,
          count(*) FILTER (kind = 2 AND visit_id NOT IN (SELECT visit_id FROM buyers)) AS abandoned,
          count(*) FILTER (kind = 2 AND visit_id IN (SELECT visit_id FROM buyers)) AS purchased
        FROM clicks JOIN site_pages USING (page_id) WHERE product_id IS NOT NULL AND kind IN (1, 2) GROUP BY 1, 2, 3""",
    "campaigns": """
        SELECT campaign_name, CAST(s AS TIMESTAMP) AS start_date, CAST(e AS TIMESTAMP) AS end_date FROM (VALUES
          ('early offer', '2024-01-02 00:00:00', '2024-01-08 23:59:59'), ('mid season', '2024-01-12 00:00:00', '2024-01-18 23:59:59'),
          ('flash sale', '2024-01-16 12:00:00', '2024-01-20 11:59:59'), ('late offer', '2024-01-22 00:00:00', '2024-01-30 23:59:59'))
          AS c(campaign_name, s, e)""",
    "visits": """
        SELECT user_id, visit_id, min(event_time) AS visit_start_time, count(*) FILTER (kind = 1) AS page_views,
          count(*) FILTER (kind = 2) AS cart_adds, CAST(max(CASE WHEN kind = 3 THEN 1 ELSE 0 END) AS BIGINT) AS purchase,
          count(*) FILTER (kind = 4) AS impression, count(*) FILTER (kind = 5) AS click,
          string_agg(CASE WHEN kind = 2 THEN page_name END, ', ' ORDER BY sequence_number) AS cart_products
        FROM clicks LEFT JOIN site_pages USING (page_id) GROUP BY 1, 2""",
    "visit_campaigns": """
        SELECT v.*, (SELECT arg_min(campaign_name, start_date) FROM campaigns
          WHERE v.visit_start_time BETWEEN start_date AND end_date) AS campaign_name FROM visits v""",
    "metrics": """
        SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN NULL
            ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS month_year,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_custkey END AS interest_id,
          CAST(o_totalprice AS DECIMAL(12,2)) AS composition, CAST(floor(o_totalprice / 500) AS BIGINT) AS ranking,
          floor(o_totalprice / 50) / 100 AS percentile_ranking
        FROM orders""",
    "registry": """
        SELECT c_custkey AS id, TIMESTAMP '1995-01-01 10:00:00' + to_days(CAST(floor(abs(c_acctbal) / 10) AS INTEGER)) AS created_at
        FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
    "tenure": "SELECT interest_id, count(DISTINCT month_year) AS total_periods FROM metrics WHERE interest_id IS NOT NULL GROUP BY 1",
    "plan_names": """
        SELECT * FROM (VALUES (0, 'trial', 0.00), (1, 'basic monthly', 9.90), (2, 'pro monthly', 19.90),
          (3, 'pro annual', 199.00), (4, 'churn', NULL)) AS p(plan_id, plan_name, price)""",
    "subs": """
        SELECT o_custkey AS customer_id, CAST(o_orderpriority[1] AS BIGINT) - 1 AS plan_id, CAST(o_orderdate AS DATE) AS start_date
        FROM orders""",
    "changes": """
        SELECT DISTINCT customer_id, start_date, plan_id FROM subs""",
    "moves": """
        SELECT customer_id, plan_id, start_date, lead(plan_id) OVER w AS next_plan_id, lead(start_date) OVER w AS next_start,
          lag(plan_id) OVER w AS prev_plan_id, lag(start_date) OVER w AS prev_start, row_number() OVER w AS pos
        FROM changes WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, plan_id)""",
    "weekly": """
        SELECT week_date, CAST((dayofyear(week_date) - 1) // 7 + 1 AS BIGINT) AS week_number,
          CAST(month(week_date) AS BIGINT) AS month_number, CAST(year(week_date) AS BIGINT) AS calendar_year, region, platform,
          CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'C1' WHEN 'BUILDING' THEN 'C2' WHEN 'FURNITURE' THEN 'F3'
            WHEN 'HOUSEHOLD' THEN 'F4' ELSE 'unknown' END AS segment,
          CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Young Adults' WHEN 'BUILDING' THEN 'Middle Aged'
            WHEN 'MACHINERY' THEN 'unknown' ELSE 'Retirees' END AS age_band,
          CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Couples'
            WHEN c_mktsegment = 'MACHINERY' THEN 'unknown' ELSE 'Families' END AS demographic,
          customer_type, count(*) AS transactions, sum(amount) AS sales,
          -- halves of a cent go up: whole-number arithmetic
          CAST((2 * CAST(sum(amount) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_transaction
        FROM (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_date, r_name AS region,
                CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Shopify' ELSE 'Retail' END AS platform, c_mktsegment,
                CASE o_orderstatus WHEN 'O' THEN 'New' WHEN 'F' THEN 'Existing' ELSE 'Guest' END AS customer_type,
                CAST(o_totalprice AS DECIMAL(12,2)) AS amount
              FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
                JOIN region ON r_regionkey = n_regionkey)
        GROUP BY ALL""",
    "lines": """
        SELECT l_orderkey AS txn_id, l_partkey AS product_id, p_type AS category, p_type || '/' || p_brand AS segment,
          CAST(l_quantity AS INTEGER) AS quantity,
          CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS gross,
          CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS rebate
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "baskets": """
        SELECT txn_id, count(DISTINCT product_id) AS products, sum(gross) AS revenue, sum(rebate) AS rebate
        FROM lines GROUP BY 1""",
}

NEEDS = {
    "items": ["raw_items"], "delivered": ["runs"], "delivered_items": ["items", "delivered"], "recipe_items": ["toppings"],
    "closing": ["txns"], "stays": ["nodes"], "buyers": ["clicks"], "product_funnel": ["clicks", "buyers", "site_pages"],
    "visits": ["clicks", "site_pages"], "visit_campaigns": ["visits", "campaigns"], "tenure": ["metrics"],
    "changes": ["subs"], "moves": ["changes"], "baskets": ["lines"],
}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views and the views they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    return f"WITH {ctes}\n{body}"

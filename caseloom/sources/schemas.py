"""Declared schemas of the input tables (SRC1)."""

from __future__ import annotations

from pyspark.sql import types as T


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


# Tables of the business cases, in the form they are delivered.
CASE_TABLES = {
    "sales": "customer_id string, order_date date, product_id int",
    "menu": "product_id int, product_name string, price int",
    "members": "customer_id string, join_date date",
    "runners": "runner_id int, registration_date date",
    "customer_orders": "order_id int, customer_id int, pizza_id int, exclusions string, extras string, order_time timestamp_ntz",
    "runner_orders": "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string",
    "pizza_names": "pizza_id int, pizza_name string",
    "pizza_recipes": "pizza_id int, toppings string",
    "pizza_toppings": "topping_id int, topping_name string",
    "ratings": "rating_id int, order_id int, rating int",
    "plans": "plan_id int, plan_name string, price decimal(5,2)",
    "subscriptions": "customer_id int, plan_id int, start_date date",
    "regions": "region_id int, region_name string",
    "customer_nodes": "customer_id int, region_id int, node_id int, start_date date, end_date date",
    "customer_transactions": "customer_id int, txn_date date, txn_type string, txn_amount int",
    "users": "user_id int, cookie_id string",
    "click_events": "visit_id string, cookie_id string, page_id int, event_type int, sequence_number int, event_time string",
    "event_types": "event_type int, event_name string",
    "page_hierarchy": "page_id int, page_name string, product_category string, product_id int",
    "campaigns": "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz",
    "interest_metrics": "_month string, _year string, month_year string, interest_id string, composition double, ranking int, percentile_ranking double",
    "interest_map": "id int, created_at timestamp_ntz",
    "json_data": "raw_data string",
    "weekly_sales": "week_date string, region string, platform string, segment string, customer_type string, transactions bigint, sales decimal(18,2)",
}

# Parquet tables the registered queries read.
DATA_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

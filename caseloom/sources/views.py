"""The business-case tables, derived from the parquet tables of one folder.

Every view covers all rows of the tables it reads. ``Views(spark, folder).sales`` and so on are lazy DataFrames.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.clean import clean_metrics, clean_orders, clean_runs, clean_weekly
from ..operators.funnel import event_types
from ..operators.grouped import number_rows
from ..operators.intervals import OPEN_END
from ..operators.lists import ordered_names
from ..operators.subscription import plan_table
from .readers import Tables

# Campaign periods over the event dates (one gap, one overlap), item prices by part type, unit spellings
# by month, names for codes.
CAMPAIGNS = [
    ("early offer", "2024-01-02 00:00:00", "2024-01-08 23:59:59"),
    ("mid season", "2024-01-12 00:00:00", "2024-01-18 23:59:59"),
    ("flash sale", "2024-01-16 12:00:00", "2024-01-20 11:59:59"),
    ("late offer", "2024-01-22 00:00:00", "2024-01-30 23:59:59"),
]
ITEM_PRICES = {"LARGE": 12, "SMALL": 10}
KM_UNITS = [""] * 4 + ["km"] * 4 + [" km"] * 4
MINUTE_UNITS = [" minutes"] * 3 + [" mins"] * 3 + ["minutes"] * 3 + ["mins"] * 2 + [" minute"]
TXN_TYPE_BY_STATUS = {"O": "deposit", "F": "purchase", "P": "withdrawal"}
SEGMENT_CODES = {"AUTOMOBILE": "C1", "BUILDING": "C2", "FURNITURE": "F3", "HOUSEHOLD": "F4", "MACHINERY": "null"}
CUSTOMER_TYPES = {"O": "New", "F": "Existing", "P": "Guest"}


def lookup(column: Column, values: dict) -> Column:
    """A CASE over fixed values, NULL for others."""
    result = F.lit(None)
    for key, value in values.items():
        result = F.when(column == key, value).otherwise(result)
    return result


def by_month(values: list[str], month: Column) -> Column:
    """The value listed for a month: one literal array, which keeps the generated code small."""
    return F.get(F.array(*[F.lit(x) for x in values]), month - 1)


def priority_number(column: str = "o_orderpriority") -> Column:
    return F.substring(column, 1, 1).cast("int")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


class Views:
    """Lazy business-case tables over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.t = Tables(spark, folder)

    # Loyalty
    @cached_property
    def sales(self) -> DataFrame:
        orders = self.t.orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )
        lines = self.t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        return lines.join(orders, "order_id").select("customer_id", "order_date", "product_id")

    @cached_property
    def menu(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    @cached_property
    def members(self) -> DataFrame:
        """Customers outside the MACHINERY segment join a year after their first order."""
        first = self.t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("o_orderdate").alias("_first"))
        who = self.t.customer.filter(F.col("c_mktsegment") != "MACHINERY").select(F.col("c_custkey").alias("customer_id"))
        return first.join(who, "customer_id").select(
            "customer_id", F.date_add(F.col("_first").cast("date"), 365).alias("join_date")
        )

    # Delivery
    @staticmethod
    def _order_time() -> Column:
        """The order date plus 8 hours plus one second per ten currency units."""
        return F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(8), secs=F.floor(F.col("o_totalprice") / 10))

    @cached_property
    def raw_runs(self) -> DataFrame:
        gone = F.col("o_orderstatus") == "F"
        price, month = F.col("o_totalprice"), F.month("o_orderdate")
        pickup = self._order_time() + F.make_dt_interval(secs=F.lit(300) + F.floor(price / 250))
        tenths = F.floor(price / 2000).cast("int")
        km = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))
        km_unit = by_month(KM_UNITS, month)
        minute_unit = F.when(F.dayofmonth("o_orderdate") <= 6, "").otherwise(by_month(MINUTE_UNITS, month))
        return self.t.orders.select(
            F.col("o_orderkey").alias("order_id"),
            priority_number().alias("runner_id"),
            F.when(gone, "null").otherwise(F.date_format(pickup, "yyyy-MM-dd HH:mm:ss")).alias("pickup_time"),
            F.when(gone, "null").otherwise(F.concat(km, km_unit)).alias("distance"),
            F.when(gone, "null").otherwise(F.concat((F.floor(price / 20000) + 8).cast("string"), minute_unit)).alias("duration"),
            F.when(gone & (price < 200000), "Restaurant Cancellation").when(gone, "Customer Cancellation")
            .when(F.col("o_orderstatus") == "O", "").when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
            .otherwise("null").alias("cancellation"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        return clean_runs(self.raw_runs)

    @cached_property
    def raw_orders(self) -> DataFrame:
        """One row per line item with two dirty topping lists: NULL, empty text and the word null all mean none."""
        n = F.col("l_linenumber")
        text = lambda c: c.cast("string")
        exclusions = (
            F.when(F.col("l_tax") == 0, F.lit(None)).when(F.col("l_linestatus") == "F", "")
            .when(F.col("l_returnflag") == "A", "null").when(F.col("l_returnflag") == "N", text(n))
            .otherwise(F.concat(text(n), F.lit(", "), text(n + 8)))
        )
        extras = (
            F.when(F.col("l_discount") == 0, F.lit(None)).when(F.col("l_returnflag") == "N", "null")
            .when(F.col("l_quantity") < 15, "").when(F.col("l_quantity") < 30, text(8 - n))
            .otherwise(F.concat(text(8 - n), F.lit(", "), text(17 - n)))
        )
        lines = self.t.lineitem.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("pizza_id"),
            exclusions.alias("exclusions"), extras.alias("extras"),
        )
        orders = self.t.orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            self._order_time().alias("order_time"),
        )
        return lines.join(orders, "order_id").select(
            "order_id", "customer_id", "pizza_id", "exclusions", "extras", "order_time"
        )

    @cached_property
    def orders(self) -> DataFrame:
        return clean_orders(self.raw_orders)

    @cached_property
    def runners(self) -> DataFrame:
        """Customers as people who register on the day of their first order."""
        return self.t.orders.groupBy(F.col("o_custkey").alias("runner_id")).agg(
            F.min("o_orderdate").cast("date").alias("registration_date")
        )

    @cached_property
    def ratings(self) -> DataFrame:
        rated = self.t.orders.filter(F.col("o_orderpriority") != "5-LOW")
        return rated.select(F.col("o_orderkey").alias("order_id"), priority_number().alias("rating"))

    @cached_property
    def pizza_names(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("pizza_id"), F.col("p_name").alias("pizza_name"))

    @cached_property
    def prices(self) -> DataFrame:
        price = lookup(F.col("p_type"), ITEM_PRICES)
        priced = self.t.part.select(F.col("p_partkey").alias("pizza_id"), price.cast("int").alias("price"))
        return priced.filter("price IS NOT NULL")

    @cached_property
    def toppings(self) -> DataFrame:
        """The words of the part names, numbered alphabetically: one row per word of the vocabulary."""
        names = self.t.part.select("p_name").distinct()
        words = names.select(F.explode(F.split("p_name", " ")).alias("topping_name")).distinct()
        # Numbered within and across first letters, so that no task sees the whole vocabulary.
        numbered = number_rows(words.withColumn("_all", F.lit(0)), ["_all"], ["topping_name"], F.substring("topping_name", 1, 2), "topping_id")
        return numbered.select(F.col("topping_id").cast("int").alias("topping_id"), "topping_name")

    @cached_property
    def recipes(self) -> DataFrame:
        words = self.t.part.select("p_name").distinct().withColumn("topping_name", F.explode(F.split("p_name", " ")))
        lists = words.join(self.toppings, "topping_name").groupBy("p_name").agg(
            ordered_names("topping_id", "topping_id").alias("toppings")
        )
        return self.t.part.select(F.col("p_partkey").alias("pizza_id"), "p_name").join(lists, "p_name").select(
            "pizza_id", "toppings"
        )

    # Ledgers
    @cached_property
    def txns(self) -> DataFrame:
        return self.t.orders.select(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("txn_date"),
            lookup(F.col("o_orderstatus"), TXN_TYPE_BY_STATUS).alias("txn_type"),
            money("o_totalprice").alias("txn_amount"), F.col("o_orderkey").alias("txn_id"),
        )

    @staticmethod
    def wallet_rows(events: DataFrame) -> DataFrame:
        """Events as transactions with a time of day; works on a stream and on a table."""
        kind = F.col("event_type")
        return events.select(
            F.col("user_id").alias("customer_id"), F.col("ts").alias("txn_time"), F.col("ts").cast("date").alias("txn_date"),
            F.when(kind.isin("purchase", "signup"), "deposit").when(kind == "error", "withdrawal").otherwise("purchase").alias("txn_type"),
            money("value").alias("txn_amount"), F.col("event_id").alias("txn_id"),
        )

    @cached_property
    def wallet(self) -> DataFrame:
        return self.wallet_rows(self.t.events)

    # Validity intervals
    @cached_property
    def nodes(self) -> DataFrame:
        """A customer stays on a node (the order priority's number) from one order date to the day before the next.

        Nodes of one day follow each other by their numbers: all but the last are left on that day. An order without a
        priority counts only on a day that has no other.
        """
        # Windowed over days, of which a customer has few; a day has at most one entry per node.
        days = self.t.orders.groupBy(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("start_date")
        ).agg(F.array_sort(F.collect_set(priority_number())).alias("_nodes"))
        following = F.lead("start_date").over(Window.partitionBy("customer_id").orderBy("start_date"))
        until = days.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")))
        stays = until.select("customer_id", "start_date", "_nodes", "_until", F.posexplode_outer("_nodes").alias("_p", "node_id"))
        left_today = F.col("_p") + 1 < F.size("_nodes")
        return stays.withColumn("end_date", F.when(left_today, F.col("start_date")).otherwise(F.col("_until"))).drop(
            "_nodes", "_until", "_p"
        ).join(self.customer_regions.hint("merge"), "customer_id")  # compressed orders look small enough to be broadcast

    @cached_property
    def customer_regions(self) -> DataFrame:
        nations = self.t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region_id"))
        return self.t.customer.join(nations, "c_nationkey").select(F.col("c_custkey").alias("customer_id"), "region_id")

    @cached_property
    def regions(self) -> DataFrame:
        return self.t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))

    # Clickstream
    @cached_property
    def event_types(self) -> DataFrame:
        return event_types(self.spark)

    @cached_property
    def clicks(self) -> DataFrame:
        """A visit is one user on one day; the page is the part named in the event's JSON text."""
        codes = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
        day = F.col("ts").cast("date").cast("string")
        return self.t.events.select(
            F.concat_ws("-", F.col("user_id").cast("string"), day).alias("visit_id"),
            "user_id",
            self._cookie().alias("cookie_id"),
            F.from_json("props", "k bigint").getField("k").alias("page_id"),
            lookup(F.col("event_type"), codes).cast("int").alias("event_type"),
            F.col("event_id").alias("sequence_number"),
            F.col("ts").alias("event_time"),
        )

    @staticmethod
    def _cookie() -> Column:
        return F.concat_ws("h", F.col("user_id").cast("string"), F.hour("ts").cast("string"))

    @cached_property
    def users(self) -> DataFrame:
        """One cookie per user and hour of the day in which the user was seen."""
        return self.t.events.select("user_id", self._cookie().alias("cookie_id")).distinct()

    @cached_property
    def pages(self) -> DataFrame:
        """Parts as site pages; the smallest ones stand for checkout pages without a product."""
        plain = F.col("p_size") <= 5
        return self.t.part.select(
            F.col("p_partkey").alias("page_id"),
            F.when(plain, "Checkout").otherwise(F.col("p_name")).alias("page_name"),
            F.when(~plain, F.col("p_type")).alias("product_category"),
            F.when(~plain, F.col("p_partkey")).alias("product_id"),
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        rows = self.spark.createDataFrame(CAMPAIGNS, "campaign_name string, start_date string, end_date string")
        return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_date", "end_date")})

    # Monthly metrics
    @cached_property
    def raw_metrics(self) -> DataFrame:
        """Orders as metrics in text form; an unspecified priority loses its id, some of those their month as well."""
        no_id = F.col("o_orderpriority") == "4-NOT SPECIFIED"
        no_month = no_id & (F.col("o_orderstatus") == "F")
        word = F.lit("NULL")
        price = F.col("o_totalprice")
        return self.t.orders.select(
            F.when(no_month, word).otherwise(F.month("o_orderdate").cast("string")).alias("_month"),
            F.when(no_month, word).otherwise(F.year("o_orderdate").cast("string")).alias("_year"),
            F.when(no_month, word).otherwise(F.date_format("o_orderdate", "MM-yyyy")).alias("month_year"),
            F.when(no_id, word).otherwise(F.col("o_custkey").cast("string")).alias("interest_id"),
            money("o_totalprice").alias("composition"),
            F.floor(price / 500).cast("int").alias("ranking"),
            (F.floor(price / 50).cast("double") / 100).alias("percentile_ranking"),
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return clean_metrics(self.raw_metrics)

    @cached_property
    def registry(self) -> DataFrame:
        """Customers outside the FURNITURE segment with a creation time that depends on their balance."""
        known = self.t.customer.filter(F.col("c_mktsegment") != "FURNITURE")
        created = F.lit("1995-01-01 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            days=F.floor(F.abs("c_acctbal") / 10).cast("int")
        )
        return known.select(F.col("c_custkey").alias("id"), created.alias("created_at"))

    # Subscriptions
    @cached_property
    def plans(self) -> DataFrame:
        return plan_table(self.spark)

    @cached_property
    def subs(self) -> DataFrame:
        return self.t.orders.select(
            F.col("o_custkey").alias("customer_id"), (priority_number() - 1).alias("plan_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
        )

    # Weekly sales
    @cached_property
    def raw_weekly(self) -> DataFrame:
        people = self.t.customer.select(
            F.col("c_custkey").alias("customer_id"), lookup(F.col("c_mktsegment"), SEGMENT_CODES).alias("segment")
        )
        monday = F.date_sub("o_orderdate", F.weekday("o_orderdate"))
        orders = self.t.orders.select(
            F.col("o_custkey").alias("customer_id"),
            monday.alias("_week"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Shopify").otherwise("Retail").alias("platform"),
            lookup(F.col("o_orderstatus"), CUSTOMER_TYPES).alias("customer_type"),
            money("o_totalprice").alias("_amount"),
        )
        sold = orders.join(people, "customer_id").join(self.customer_regions, "customer_id")
        weekly = sold.groupBy("_week", "region_id", "platform", "segment", "customer_type").agg(
            F.count(F.lit(1)).alias("transactions"), F.sum("_amount").alias("sales")
        )
        return weekly.join(self.regions, "region_id").select(
            F.date_format("_week", "d/M/yyyy").alias("week_date"), F.col("region_name").alias("region"), "platform", "segment",
            "customer_type", "transactions", "sales",
        )

    @cached_property
    def weekly(self) -> DataFrame:
        return clean_weekly(self.raw_weekly, "d/M/yyyy")

    # Baskets
    @cached_property
    def lines(self) -> DataFrame:
        parts = self.t.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
            F.concat_ws("/", "p_type", "p_brand").alias("segment"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )
        lines = self.t.lineitem.select(
            F.col("l_orderkey").alias("txn_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"), F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        )
        return lines.join(parts, "product_id")

    @cached_property
    def member_lines(self) -> DataFrame:
        """Basket lines with a member flag: transactions of high priority belong to members."""
        flags = self.t.orders.select(
            F.col("o_orderkey").alias("txn_id"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "t").otherwise("f").alias("member"),
        )
        return self.lines.join(flags, "txn_id")

"""Validity-interval questions over customers' stays on nodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as op
from ..sources.views import Views
from .sqlviews import with_views


def region_counts(v: Views):
    return op.node_counts(v.nodes).join(v.regions, "region_id")


def stay_percentiles(v: Views):
    return op.nearest_rank(op.stay_days(v.nodes), ["region_id"], "days_stayed").join(v.regions, "region_id").select(
        "region_name", "percentile", "days_stayed"
    )


def campaign_map(v: Views):
    """Events per campaign running at the event's time; events outside every campaign have none."""
    joined = op.interval_join(v.clicks, v.campaigns, "event_time", "start_date", "end_date")
    return joined.groupBy("campaign_name").agg(F.count(F.lit(1)).alias("events"))


def stays_by_region(v: Views):
    """Stays and open stays per node, and the transactions on the days of its stays: an interval join with as many intervals
    as points, by customer and day. Open stays have no end here."""
    ends = F.when(F.col("end_date") != F.lit(op.OPEN_END).cast("date"), F.col("end_date"))
    stays = v.nodes.select("customer_id", "node_id", "start_date", ends.alias("end_date"))
    placed = op.interval_join(v.txns.select("customer_id", "txn_date"), stays, "txn_date", "start_date", "end_date", by=["customer_id"])
    per_node = placed.groupBy("node_id").agg(F.count("node_id").alias("txns"))
    counts = stays.groupBy("node_id").agg(F.count(F.lit(1)).alias("stays"), F.count_if(F.col("end_date").isNull()).alias("open_stays"))
    return counts.join(per_node, "node_id", "left").select("node_id", "stays", "open_stays", F.coalesce("txns", F.lit(0).cast("bigint")).alias("txns"))


QUERIES = {
    "unique_nodes": (lambda v: op.unique_nodes(v.nodes), with_views("nodes", "SELECT count(DISTINCT node_id) AS unique_nodes FROM nodes")),
    "region_counts": (region_counts, with_views("nodes", """
        SELECT region_id, count(*) AS node_rows, count(DISTINCT customer_id) AS customers, r_name AS region_name
        FROM nodes JOIN region ON r_regionkey = region_id GROUP BY region_id, r_name""")),
    "open_stays": (stays_by_region, with_views("nodes txns", """
        , held AS (SELECT n.node_id, count(*) AS txns FROM txns t JOIN nodes n ON n.customer_id = t.customer_id
          AND t.txn_date BETWEEN n.start_date AND n.end_date GROUP BY 1)
        SELECT node_id, stays, open_stays, coalesce(txns, 0) AS txns FROM (
          SELECT node_id, count(*) AS stays, count(*) FILTER (end_date = DATE '9999-12-31') AS open_stays FROM nodes GROUP BY 1)
          LEFT JOIN held USING (node_id)""")),
    "interval_days": (lambda v: op.average_stay(v.nodes), with_views("stays", """
        SELECT CAST(sum(days_stayed) // count(*) AS BIGINT) AS avg_days_int, CAST(sum(days_stayed) AS DOUBLE) / count(*) AS avg_days,
          count(*) AS stays FROM stays""")),
    "nearest_rank_pct": (stay_percentiles, with_views("stays", """
        , ranked AS (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY days_stayed) AS rn,
          count(*) OVER (PARTITION BY region_id) AS n FROM stays)
        SELECT r_name AS region_name, label AS percentile, days_stayed
        FROM ranked JOIN region ON r_regionkey = region_id,
          (VALUES ('median', CAST(0.5 AS DECIMAL(4,3))), ('80th percentile', 0.8), ('95th percentile', 0.95)) AS p(label, f)
        WHERE rn = greatest(1, round(CAST(n AS DECIMAL(12,0)) * f, 0))""")),
    "campaign_map": (campaign_map, with_views("clicks campaigns", """
        SELECT campaign_name, count(*) AS events FROM clicks LEFT JOIN campaigns ON event_time BETWEEN start_date AND end_date GROUP BY 1""")),
}

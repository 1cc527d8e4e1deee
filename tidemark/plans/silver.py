"""Enriched models: orders, shipments, support cases and the daily app funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.banding import issue_category, load_band
from tidemark.functions.numeric import any_flag, exact_sum, flag, pct, round_to, sum_where

CUSTOMER_COLUMNS = ["acquisition_channel", "signup_date", "account_status"]
PAYMENT_COLUMNS = ["payment_id", "payment_ts", "payment_method", "payment_status", "payment_amount_eur", "fraud_score"]
HUB_COLUMNS = ["warehouse_type", "daily_capacity", "automation_level", "baseline_reliability"]
CARRIER_COLUMNS = ["reliability_score", "scan_quality_score", "damage_rate_baseline", "loss_rate_baseline"]
SHIPMENT_COLUMNS = [
    "carrier_name", "service_tier", "route_name", "route_scope", "network_load_bucket", "actual_transit_hours",
    "delay_hours", "order_total_eur", "order_status", "payment_status",
]
# Event types of the funnel and the columns that count them.
FUNNEL_EVENTS = {
    "session_start_events": "session_start",
    "product_view_events": "product_view",
    "search_events": "search",
    "category_view_events": "category_view",
    "add_to_cart_events": "add_to_cart",
    "checkout_events": "checkout_started",
    "purchase_events": "purchase",
    "payment_failed_events": "payment_failed",
    "checkout_pending_events": "checkout_pending",
}


def item_summary(items: DataFrame) -> DataFrame:
    """Line count, units and values per order."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_row_count"),
        F.sum("quantity").cast("bigint").alias("item_units"),
        exact_sum("gross_value_eur").alias("item_gmv_eur"),
        exact_sum("discount_value_eur").alias("item_discount_eur"),
        exact_sum("net_value_eur").alias("item_net_value_eur"),
    )


def _attributes(dim: DataFrame, key: str, columns: list[str], prefix: str = "") -> DataFrame:
    return dim.select(key, *[F.col(c).alias(prefix + c) for c in columns if c in dim.columns])


def order_facts(payments: DataFrame, items: DataFrame) -> DataFrame:
    """Payment and line facts of every order that has either."""
    return payments.select("order_id", *PAYMENT_COLUMNS).join(item_summary(items), "order_id", "full")


def orders_enriched(orders: DataFrame, customers: DataFrame | None, facts: DataFrame) -> DataFrame:
    """One row per order with customer, payment and line facts, flags and the payment difference.

    ``facts`` has one row per order with payment and line columns, as from ``order_facts`` or from one grouping of
    lines that carry both. Without ``customers`` the orders bring the customer columns along.
    """
    joined = orders.join(facts, "order_id", "left")
    if customers is not None:
        people = customers.select(
            "customer_id",
            F.col("country").alias("customer_country"),
            *[c for c in CUSTOMER_COLUMNS if c in customers.columns],
        )
        joined = joined.join(people, "customer_id", "left")
    return joined.withColumns(
        {
            "order_date": F.to_date("order_ts"),
            "payment_paid_flag": flag(F.col("payment_status") == "Paid"),
            "payment_refunded_flag": flag(F.col("payment_status") == "Refunded"),
            "payment_failed_flag": flag(F.col("payment_status") == "Failed"),
            "purchase_realized_flag": flag(F.col("order_status").isin("Completed", "Returned")),
            "cancelled_order_flag": flag(F.col("order_status") == "Cancelled"),
            "payment_reconciliation_delta_eur": round_to(F.col("payment_amount_eur") - F.col("order_total_eur"), 2),
        }
    )


def shipments_enriched(
    shipments: DataFrame, orders: DataFrame, hubs: DataFrame, carriers: DataFrame
) -> DataFrame:
    """One row per shipment with order, hub and carrier facts, route, load band and issue category.

    ``orders`` is the enriched order model. Orders and carriers grow with the data and may be joined by shuffles, so they
    come first; hubs are few, and their columns are added when the wide rows have been moved.
    """
    order_facts = orders.select(
        "order_id",
        "customer_id",
        F.col("customer_segment").alias("order_customer_segment"),
        "sales_channel",
        "order_status",
        "order_total_eur",
        "payment_status",
    )
    origin = _attributes(hubs, "warehouse_id", HUB_COLUMNS, "origin_")
    target = _attributes(hubs, "warehouse_id", HUB_COLUMNS, "destination_")
    carrier = _attributes(carriers, "carrier_id", CARRIER_COLUMNS, "carrier_")
    joined = (
        shipments.join(order_facts, "order_id", "left")
        .join(carrier, "carrier_id", "left")
        .join(origin.withColumnRenamed("warehouse_id", "origin_warehouse_id"), "origin_warehouse_id", "left")
        .join(
            target.withColumnRenamed("warehouse_id", "destination_warehouse_id"), "destination_warehouse_id", "left"
        )
    )
    last = [c for c in carrier.columns if c != "carrier_id"]
    rest = [c for c in joined.columns if c not in carrier.columns]
    return joined.select("carrier_id", *rest, *last).withColumns(
        {
            "shipment_date": F.to_date("shipment_created_ts"),
            "route_name": F.concat("origin_city", F.lit(" → "), "destination_city"),
            "route_scope": F.when(F.col("cross_border") == 1, "Cross-border").otherwise("Domestic"),
            "network_load_bucket": load_band("network_load_factor"),
            "primary_issue_category": issue_category(),
            "any_issue_flag": any_flag("delayed_flag", "no_scan_flag", "damaged_flag", "lost_flag"),
        }
    )


def support_enriched(cases: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per case with the facts of its shipment. ``shipments`` is the enriched model."""
    facts = shipments.select(
        "shipment_id",
        *SHIPMENT_COLUMNS,
        F.col("origin_city").alias("shipment_origin_city"),
        F.col("origin_country").alias("shipment_origin_country"),
        F.col("destination_city").alias("shipment_destination_city"),
        F.col("destination_country").alias("shipment_destination_country"),
        F.col("sla_met").alias("shipment_sla_met"),
    )
    complex_case = (F.col("escalated_flag") == 1) | (F.col("reopened_flag") == 1)
    return cases.join(facts, "shipment_id", "left").withColumns(
        {
            "case_date": F.to_date("created_ts"),
            "high_priority_flag": flag(F.col("priority").isin("Critical", "High")),
            "support_sla_breach_flag": flag(F.col("support_sla_met") == 0),
            "complex_case_flag": flag(complex_case),
        }
    )


def app_funnel_daily(events: DataFrame) -> DataFrame:
    """Event counts per type, distinct sessions and customers, purchase value and funnel rates per day.

    Events are first reduced to (day, session, customer), so the two distinct counts run over that
    small set and a day with a third of all events is spread by session.
    """
    purchase = F.col("event_type") == "purchase"
    grain = events.groupBy(F.to_date("event_ts").alias("event_date"), "session_id", "customer_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in FUNNEL_EVENTS.items()],
        F.count_if(purchase & F.col("event_value_eur").isNull()).alias("purchase_value_null_count"),
        sum_where(purchase, "event_value_eur").alias("purchase_event_revenue_eur"),
    )
    counts = ["total_events", *FUNNEL_EVENTS, "purchase_value_null_count"]
    daily = grain.groupBy("event_date").agg(
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("customer_id").alias("active_customers"),
        *[F.sum(c).alias(c) for c in counts],
        F.coalesce(exact_sum("purchase_event_revenue_eur"), F.lit(0.0)).alias("purchase_event_revenue_eur"),
    )

    def rate(part: Column, whole: str) -> Column:
        return pct(part, F.col(whole))

    valued = F.col("purchase_events") - F.col("purchase_value_null_count")
    return daily.withColumns(
        {
            "view_to_cart_pct": rate(F.col("add_to_cart_events"), "product_view_events"),
            "cart_to_checkout_pct": rate(F.col("checkout_events"), "add_to_cart_events"),
            "checkout_to_purchase_pct": rate(F.col("purchase_events"), "checkout_events"),
            "purchase_value_completeness_pct": rate(valued, "purchase_events"),
        }
    )

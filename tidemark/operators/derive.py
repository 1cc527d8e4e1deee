"""Derived business columns: line values, order totals, SLA targets, delay risk, case triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.banding import first_match, load_band, lookup
from tidemark.functions.calendar import shift_hours
from tidemark.functions.geo import haversine_km
from tidemark.functions.numeric import clip, exact_sum, flag, flag_pct, pct, round_to
from tidemark.operators.joins import checked_join
from tidemark.operators.ranking import rank_in_buckets

# Shipping fee steps, status pairs, SLA base hours per tier, targets per priority, triage.
SHIPPING_FEES = [(80, 0.0), (40, 3.99)]
LOWEST_FEE_BASE = 6.99
ORDER_STATUS = {"Paid": "Completed", "Failed": "Cancelled", "Refunded": "Returned", "Pending": "Pending"}
TIER_HOURS = {"Economy": 72.0, "Standard": 48.0, "Premium": 36.0, "Express": 24.0}
HOURS_PER_KM = 0.012
RESPONSE_MINUTES = {"Critical": 30, "High": 120, "Medium": 360, "Low": 720}
RESOLUTION_HOURS = {"Critical": 12, "High": 24, "Medium": 48, "Low": 72}
CASE_TYPES = [
    ("lost_flag", "Lost Shipment"),
    ("damaged_flag", "Damaged Parcel"),
    ("no_scan_flag", "Tracking / No Scan"),
    ("delayed_flag", "Late Delivery"),
]
CASE_PRIORITY = {
    "Lost Shipment": "Critical",
    "Damaged Parcel": "High",
    "Late Delivery": "Medium",
    "Tracking / No Scan": "Medium",
}
CASE_TEAM = {
    "Lost Shipment": "Claims",
    "Damaged Parcel": "Claims",
    "Tracking / No Scan": "Tracking",
    "Late Delivery": "Delivery Support",
    "Delivery Question": "Delivery Support",
    "Proof of Delivery": "Delivery Support",
    "Address Change": "Customer Care",
    "General Inquiry": "Customer Care",
}
CASE_CAUSE = {
    "Lost Shipment": "Chain of Custody",
    "Damaged Parcel": "Handling Damage",
    "Tracking / No Scan": "Scan Quality",
    "Address Change": "Customer Request",
    "Proof of Delivery": "Delivery Confirmation",
}
TERMINAL_EVENTS = {"Completed": "purchase", "Returned": "purchase", "Cancelled": "payment_failed"}


def line_values(
    items: DataFrame, price: str = "unit_price_eur", quantity: str = "quantity", discount: str = "discount_pct"
) -> DataFrame:
    """Gross, discount and net value of each order line, each rounded to cents."""
    gross = round_to(F.col(price) * F.col(quantity), 2)
    return (
        items.withColumn("gross_value_eur", gross)
        .withColumn("discount_value_eur", round_to(F.col("gross_value_eur") * F.col(discount), 2))
        .withColumn("net_value_eur", round_to(F.col("gross_value_eur") - F.col("discount_value_eur"), 2))
    )


def shipping_fee(net: Column | str) -> Column:
    net = F.col(net) if isinstance(net, str) else net
    return first_match([(net >= edge, F.lit(fee)) for edge, fee in SHIPPING_FEES], F.lit(LOWEST_FEE_BASE))


def order_financials(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with line count, units, values, shipping fee and total. One row per order on both sides."""
    per_order = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").cast("bigint").alias("units"),
        exact_sum("gross_value_eur").alias("gross_merchandise_value_eur"),
        exact_sum("discount_value_eur").alias("discount_eur"),
        exact_sum("net_value_eur").alias("merchandise_revenue_eur"),
    )
    joined = checked_join(orders, per_order, ["order_id"], "left", "many_to_one")
    total = round_to(F.col("merchandise_revenue_eur") + F.col("shipping_fee_eur"), 2)
    return joined.withColumn("shipping_fee_eur", shipping_fee("merchandise_revenue_eur")).withColumn(
        "order_total_eur", total
    )


def order_status(payment_status: Column | str) -> Column:
    return lookup(payment_status, ORDER_STATUS)


def sla_hours(tier: Column | str, distance: Column | str) -> Column:
    """Delivery target: tier base plus time for the distance."""
    return round_to(lookup(tier, TIER_HOURS) + F.col(distance) * F.lit(HOURS_PER_KM), 2)


def delay_risk(
    load: Column, carrier_reliability: Column, hub_reliability: Column, distance: Column, ts: Column
) -> Column:
    """Additive delay risk between 0.02 and 0.45."""
    far = F.when(distance > 1200, 0.055).when(distance > 700, 0.025).otherwise(0.0)
    season = F.when(F.month(ts).isin(11, 12), 0.03).otherwise(0.0)
    weekend = F.when(F.dayofweek(ts).isin(1, 7), 0.015).otherwise(0.0)
    total = (
        F.lit(0.035)
        + F.greatest(load - 0.75, F.lit(0.0)) * 0.30
        + (1 - carrier_reliability) * 0.50
        + (1 - hub_reliability) * 0.08
        + far
        + season
        + weekend
    )
    return clip(total, 0.02, 0.45)


def route_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, floor_km: float = 25.0) -> Column:
    """Route length in km with one decimal, at least ``floor_km``."""
    return round_to(F.greatest(haversine_km(lat1, lon1, lat2, lon2), F.lit(floor_km)), 1)


def case_triage(shipments: DataFrame) -> DataFrame:
    """Case type from the shipment flags, then root cause, priority and team.

    A shipment without any issue becomes a general inquiry.
    """
    kind = first_match([(F.col(name) == 1, label) for name, label in CASE_TYPES], "General Inquiry")
    late = F.when(F.col("network_load_factor") >= 0.90, "Network Congestion").otherwise("Carrier Performance")
    cause = F.when(F.col("case_type") == "Late Delivery", late).otherwise(
        lookup("case_type", CASE_CAUSE, "General Service")
    )
    return shipments.withColumn("case_type", kind).withColumns(
        {
            "root_cause_category": cause,
            "priority": lookup("case_type", CASE_PRIORITY, "Low"),
            "support_team": lookup("case_type", CASE_TEAM),
        }
    )


def sla_evaluation(cases: DataFrame) -> DataFrame:
    """Response, resolution and overall SLA of each case, from the targets of its priority."""
    return (
        cases.withColumn("response_sla_minutes", lookup("priority", RESPONSE_MINUTES))
        .withColumn("resolution_sla_hours", lookup("priority", RESOLUTION_HOURS))
        .withColumn("response_sla_met", flag(F.col("first_response_minutes") <= F.col("response_sla_minutes")))
        .withColumn("resolution_sla_met", flag(F.col("resolution_hours") <= F.col("resolution_sla_hours")))
        .withColumn(
            "support_sla_met", flag((F.col("response_sla_met") == 1) & (F.col("resolution_sla_met") == 1))
        )
    )


def case_times(cases: DataFrame) -> DataFrame:
    """First response and resolution times from the case start and its durations."""
    first = shift_hours("created_ts", F.col("first_response_minutes") / 60.0)
    return cases.withColumn("first_response_ts", first).withColumn(
        "resolved_ts", shift_hours("first_response_ts", F.col("resolution_hours"))
    )


def event_sequence(
    events: DataFrame, key: str = "shipment_id", tie: str = "event_id", bucket: Column | None = None
) -> DataFrame:
    """Events numbered per shipment by time, then id. Days of one shipment (or the given buckets of time) are
    ranked apart, so a shipment with a large share of all events is spread over tasks."""
    bucket = F.to_date("event_ts") if bucket is None else bucket
    order = [F.col("event_ts"), F.col(tie)]
    return rank_in_buckets(events.drop("event_sequence"), [key], bucket, order, "event_sequence")


def contact_number(cases: DataFrame) -> DataFrame:
    """Position of each case among the cases of its shipment."""
    return rank_in_buckets(
        cases.drop("contact_number"),
        ["shipment_id"],
        F.to_date("created_ts"),
        [F.col("created_ts"), F.col("case_id")],
        "contact_number",
    )


def terminal_event(status: Column | str) -> Column:
    return lookup(status, TERMINAL_EVENTS, "checkout_pending")


def delay_by_load_band(shipments: DataFrame, right: bool = True) -> DataFrame:
    """Delay rate per load band."""
    banded = shipments.withColumn("load_band", load_band("network_load_factor", right))
    return (
        banded.where(F.col("load_band").isNotNull())
        .groupBy("load_band")
        .agg(F.count(F.lit(1)).alias("shipments"), flag_pct("delayed_flag").alias("delay_rate_pct"))
    )


def funnel_conversion(
    events: DataFrame, start: str = "checkout_started", end: str = "purchase"
) -> DataFrame:
    """Events of two funnel steps and the rate between them."""
    first, last = F.count_if(F.col("event_type") == start), F.count_if(F.col("event_type") == end)
    return events.agg(
        first.alias("checkout_events"), last.alias("purchase_events"), pct(last, first).alias("conversion_pct")
    )


def margin_pct(list_price: Column, unit_cost: Column) -> Column:
    return round_to((list_price - unit_cost) / F.nullif(list_price, F.lit(0.0)) * 100, 2)


def route_counts(shipments: DataFrame) -> DataFrame:
    """Distinct routes and distinct hubs used on either side."""
    ends = ["origin_warehouse_id", "destination_warehouse_id"]
    pairs = shipments.select(*ends).distinct()
    hub = F.inline(F.array(*[F.struct(F.col(e).alias("hub")) for e in ends]))
    counts = pairs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("routes").alias("item"), "n")
    hubs = pairs.select(hub).agg(F.count_distinct("hub").alias("n")).select(F.lit("hubs").alias("item"), "n")
    return counts.unionByName(hubs)

"""Reporting marts and their daily summaries.

Marts carry no global sort; order them where they are shown or exported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_spine, date_attributes
from tidemark.functions.numeric import (
    DISTANCE,
    HOURS,
    LOAD,
    count_where,
    exact_avg,
    exact_sum,
    flag,
    flag_pct,
    pct,
    round_to,
    sum_where,
    units,
    weighted_mean,
)
from tidemark.operators.touches import HUB, hub_touches, incident_days, incident_shipments

ORDER_STATES = {"completed": "Completed", "returned": "Returned", "cancelled": "Cancelled", "pending": "Pending"}
HUB_ATTRIBUTES = [
    "city", "country", "warehouse_type", "daily_capacity", "automation_level", "baseline_reliability",
]
CASE_DIMENSIONS = [
    "customer_segment", "destination_country", "carrier_id", "carrier_name", "case_type", "root_cause_category",
    "priority", "support_team", "channel",
]


def in_period(df: DataFrame, day: str, start=None, end=None) -> DataFrame:
    """Rows whose day lies between two dates, both included; all rows without dates."""
    return df if start is None else df.where(F.col(day).between(start, end))


def _load_pct(column: str = "network_load_factor") -> Column:
    return round_to(exact_avg(column, LOAD) * 100, 2)


# --- daily summaries -------------------------------------------------------------------------------


def commerce_daily(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("order_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        round_to(exact_sum("order_total_eur"), 2).alias("total_order_value_eur"),
        round_to(exact_avg("order_total_eur"), 2).alias("avg_order_value_eur"),
    )


def logistics_daily(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy(F.col("shipment_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("shipments"),
        flag_pct("delayed_flag").alias("delay_rate_pct"),
        flag_pct("sla_met").alias("delivery_sla_pct"),
        _load_pct().alias("avg_network_load_pct"),
    )


def _support_rates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("support_cases"),
        flag_pct("support_sla_met").alias("support_sla_pct"),
        round_to(F.avg("csat_score"), 2).alias("avg_csat"),
        flag_pct("escalated_flag").alias("escalation_rate_pct"),
    ]


def support_daily(cases: DataFrame) -> DataFrame:
    return cases.groupBy(F.col("case_date").alias("report_date")).agg(*_support_rates())


# --- executive -------------------------------------------------------------------------------------


def _executive_commerce(orders: DataFrame) -> DataFrame:
    realized = F.col("purchase_realized_flag") == 1
    return orders.groupBy(F.col("order_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("purchase_realized_flag").alias("realized_orders"),
        F.sum("cancelled_order_flag").alias("cancelled_orders"),
        round_to(sum_where(realized, "order_total_eur"), 2).alias("realized_revenue_eur"),
        round_to(exact_avg("order_total_eur"), 2).alias("avg_order_value_eur"),
    )


def _executive_logistics(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy(F.col("shipment_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("delayed_flag").alias("delayed_shipments"),
        flag_pct("sla_met").alias("delivery_sla_pct"),
        flag_pct("delayed_flag").alias("delay_rate_pct"),
        _load_pct().alias("avg_network_load_pct"),
        round_to(exact_avg("actual_transit_hours", HOURS), 2).alias("avg_transit_hours"),
        F.sum("no_scan_flag").alias("no_scan_shipments"),
        F.sum("damaged_flag").alias("damaged_shipments"),
        F.sum("lost_flag").alias("lost_shipments"),
    )


def _executive_support(cases: DataFrame) -> DataFrame:
    return cases.groupBy(F.col("case_date").alias("report_date")).agg(
        *_support_rates(), flag_pct("reopened_flag").alias("reopen_rate_pct")
    )


def _executive_app(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        F.col("event_date").alias("report_date"),
        F.col("total_events").alias("app_events"),
        "sessions",
        "active_customers",
        "product_view_events",
        "add_to_cart_events",
        "checkout_events",
        "purchase_events",
        "payment_failed_events",
        "purchase_value_null_count",
        "purchase_event_revenue_eur",
        "checkout_to_purchase_pct",
        "purchase_value_completeness_pct",
    )


def _executive_reconciliation(days: DataFrame) -> DataFrame:
    return days.select(
        F.col("date").alias("report_date"),
        "expected_purchase_count",
        "observed_purchase_count",
        "expected_revenue_eur",
        "observed_revenue_eur",
        "missing_purchase_pct",
        "purchase_value_null_pct",
        round_to(F.col("purchase_count_ratio") * 100, 2).alias("purchase_event_coverage_pct"),
        round_to(F.col("revenue_ratio") * 100, 2).alias("revenue_capture_pct"),
        F.col("incident_flag").alias("data_incident_flag"),
    )


def executive_daily(
    orders: DataFrame,
    shipments: DataFrame,
    cases: DataFrame,
    funnel: DataFrame,
    reconciliation: DataFrame,
    bounds: DataFrame,
) -> DataFrame:
    """One row per calendar day between the ``start_date`` and ``end_date`` of the one-row ``bounds``.

    Every source is reduced to days before it is joined to the calendar. Counts and sums of days
    without rows are 0, rates stay NULL.
    """
    parts = [
        _executive_commerce(orders),
        _executive_logistics(shipments),
        _executive_support(cases),
        _executive_app(funnel),
        _executive_reconciliation(reconciliation),
    ]
    days = calendar_spine(bounds, "start_date", "end_date")
    joined = reduce(lambda left, right: left.join(right, "report_date", "left"), parts, days)
    zero = [
        "orders", "realized_orders", "cancelled_orders", "realized_revenue_eur", "shipments", "delayed_shipments",
        "no_scan_shipments", "damaged_shipments", "lost_shipments", "support_cases", "app_events", "sessions",
        "active_customers", "product_view_events", "add_to_cart_events", "checkout_events", "purchase_events",
        "payment_failed_events", "purchase_value_null_count", "purchase_event_revenue_eur", "data_incident_flag",
    ]
    trust = F.when(F.col("data_incident_flag") == 1, "FAILED").otherwise("PASSED")
    return joined.na.fill(0, zero).withColumn("data_trust_status", trust)


def date_dimension(bounds: DataFrame, periods: dict[str, DataFrame] | None = None) -> DataFrame:
    """Calendar attributes per day; one 0/1 column per named set of days (``report_date``)."""
    days = calendar_spine(bounds, "start_date", "end_date", "date").withColumns(date_attributes("date"))
    for name, marked in (periods or {}).items():
        hit = marked.select(F.col("report_date").alias("date")).distinct().withColumn(name, F.lit(1))
        days = days.join(hit, "date", "left").na.fill(0, [name])
    return days


# --- logistics -------------------------------------------------------------------------------------


def logistics_performance(
    shipments: DataFrame, hubs: DataFrame, incidents: DataFrame, start=None, end=None
) -> DataFrame:
    """Day x hub x role x carrier x tier x route, with incident flag and operational status.

    Rows are first reduced per shipment, which settles the distinct shipment count; both hubs of a
    shipment then come from that one set. Hub attributes and incident days join the grouped rows.
    """
    dims = ["report_date", "carrier_id", "carrier_name", "service_tier", "route_name", "route_scope"]
    flags = {
        "delayed_shipments": "delayed_flag",
        "sla_met_shipments": "sla_met",
        "no_scan_shipments": "no_scan_flag",
        "damaged_shipments": "damaged_flag",
        "lost_shipments": "lost_flag",
        "issue_shipments": "any_issue_flag",
    }
    measures = {
        "load": ("network_load_factor", LOAD),
        "transit": ("actual_transit_hours", HOURS),
        "delay": ("delay_hours", HOURS),
        "distance": ("distance_km", DISTANCE),
        "value": ("order_total_eur", 2),
    }
    facts = in_period(shipments.withColumn("report_date", F.col("shipment_date")), "report_date", start, end)
    ends = ["origin_warehouse_id", "destination_warehouse_id"]
    sums = [F.sum(source).alias(name) for name, source in flags.items()]
    counts = [F.count(source).alias(f"{name}_n") for name, source in flags.items()]
    for name, (source, places) in measures.items():
        sums.append(F.sum(units(source, places)).alias(name))
        counts.append(F.count(source).alias(f"{name}_n"))
    per_shipment = facts.groupBy(*dims, *ends, "shipment_id").agg(F.count(F.lit(1)).alias("touches"), *sums, *counts)
    added = ["touches", *flags, *measures, *[f"{n}_n" for n in [*flags, *measures]]]
    keys = [dims[0], HUB, "warehouse_role", *dims[1:]]
    grouped = (
        hub_touches(per_shipment, [*dims, "shipment_id", *added])
        .groupBy(*keys)
        .agg(F.count("shipment_id").alias("shipments"), *[F.sum(c).alias(c) for c in added])
    )
    marked = (
        incident_days(incidents.where(F.col("classification") == "BUSINESS_INCIDENT_CANDIDATE"))
        .groupBy(HUB, "report_date")
        .agg(F.max("anomaly_score").alias("day_score"))
        .withColumn("hit", F.lit(1))
    )
    rows = grouped.join(hubs.select(HUB, *[c for c in HUB_ATTRIBUTES if c in hubs.columns]), HUB, "left").join(
        marked, [HUB, "report_date"], "left"
    )

    def share(name: str) -> Column:
        return round_to(F.col(name) / F.nullif(F.col(f"{name}_n"), F.lit(0)) * 100, 2)

    def mean(name: str) -> Column:
        scale = F.lit(float(10 ** measures[name][1]))
        return F.col(name) / scale / F.nullif(F.col(f"{name}_n"), F.lit(0))

    mart = rows.select(
        "report_date",
        HUB,
        *[c for c in HUB_ATTRIBUTES if c in hubs.columns],
        "warehouse_role",
        *dims[1:],
        F.col("touches").alias("shipment_touches"),
        "shipments",
        *flags,
        share("sla_met_shipments").alias("delivery_sla_pct"),
        share("delayed_shipments").alias("delay_rate_pct"),
        round_to(mean("load") * 100, 2).alias("avg_network_load_pct"),
        round_to(mean("transit"), 2).alias("avg_transit_hours"),
        round_to(mean("delay"), 2).alias("avg_delay_hours"),
        round_to(mean("distance"), 1).alias("avg_distance_km"),
        round_to(F.col("value") / 100.0, 2).alias("handled_order_value_eur"),
        F.coalesce("hit", F.lit(0)).alias("business_incident_flag"),
        F.coalesce("day_score", F.lit(0.0)).alias("anomaly_score"),
    )
    status = (
        F.when(F.col("business_incident_flag") == 1, "Business Incident")
        .when(F.col("avg_network_load_pct") > 100, "Over Capacity")
        .when(F.col("delay_rate_pct") >= 30, "Performance Risk")
        .otherwise("Normal")
    )
    return mart.withColumn("operational_status", status)


def incident_hub_snapshot(mart: DataFrame) -> DataFrame:
    """Visible span, rates and top score of every hub with incident rows."""
    rows = mart.where(F.col("business_incident_flag") == 1)
    return rows.groupBy("city", "country").agg(
        F.min("report_date").alias("first_visible_date"),
        F.max("report_date").alias("last_visible_date"),
        F.sum("shipment_touches").alias("shipment_touches"),
        pct(F.sum("delayed_shipments"), F.sum("shipments")).alias("delay_rate_pct"),
        pct(F.sum("sla_met_shipments"), F.sum("shipments")).alias("delivery_sla_pct"),
        round_to(weighted_mean("avg_network_load_pct", "shipments"), 2).alias("avg_network_load_pct"),
        F.max("anomaly_score").alias("max_anomaly_score"),
    )


# --- customers -------------------------------------------------------------------------------------


def customer_experience(
    cases: DataFrame, shipments: DataFrame, incidents: DataFrame, start=None, end=None
) -> DataFrame:
    """Day x eleven dimensions of support cases, with the incident their shipment took part in.

    All incident classes count. A case whose shipment is in two incidents appears under both;
    ``incident_vs_normal`` counts distinct cases. Shipments are counted by the first case of each in a group: a second
    distinct count would send every case three times, and a task would hold all three.
    """
    hits = incident_shipments(shipments, incident_days(incidents), ["candidate_incident_id", "anomaly_score"])
    base = cases.join(hits, "shipment_id", "left").withColumns(
        {
            "report_date": F.col("case_date"),
            "business_incident_flag": flag(F.col("candidate_incident_id").isNotNull()),
            "anomaly_score": F.coalesce("anomaly_score", F.lit(0.0)),
        }
    )
    base = in_period(base, "report_date", start, end)
    dims = ["report_date", *CASE_DIMENSIONS, "business_incident_flag", "candidate_incident_id"]
    # The shipment leads, so that the rows may stay where the join by shipment left them.
    same_shipment = Window.partitionBy("shipment_id", *dims).orderBy("shipment_id")
    base = base.withColumn("nth_case", F.row_number().over(same_shipment))
    return base.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("support_cases"),
        F.count_distinct("customer_id").alias("customers_contacting"),
        F.count_if((F.col("nth_case") == 1) & F.col("shipment_id").isNotNull()).alias("shipments_with_cases"),
        round_to(exact_avg("first_response_minutes"), 2).alias("avg_first_response_minutes"),
        round_to(exact_avg("resolution_hours", HOURS), 2).alias("avg_resolution_hours"),
        flag_pct("response_sla_met").alias("response_sla_pct"),
        flag_pct("resolution_sla_met").alias("resolution_sla_pct"),
        flag_pct("support_sla_met").alias("support_sla_pct"),
        flag_pct("escalated_flag").alias("escalation_rate_pct"),
        flag_pct("reopened_flag").alias("reopen_rate_pct"),
        round_to(F.avg("csat_score"), 2).alias("avg_csat"),
        F.sum("shipment_delayed_flag").alias("delayed_shipment_cases"),
        F.sum("shipment_no_scan_flag").alias("no_scan_cases"),
        F.sum("shipment_damaged_flag").alias("damaged_cases"),
        F.sum("shipment_lost_flag").alias("lost_cases"),
        _load_pct().alias("avg_network_load_pct"),
        F.max("anomaly_score").alias("anomaly_score"),
    )


def incident_vs_normal(cases: DataFrame, shipments: DataFrame, incidents: DataFrame) -> DataFrame:
    """Support rates of cases on incident shipments and of all others; each case counts once."""
    hits = incident_shipments(shipments, incident_days(incidents), []).withColumn("hit", F.lit(1))
    rows = cases.join(hits, "shipment_id", "left")
    group = F.when(F.col("hit") == 1, "incident").otherwise("normal")
    return rows.groupBy(group.alias("case_group")).agg(
        F.count(F.lit(1)).alias("support_cases"),
        flag_pct("support_sla_met").alias("support_sla_pct"),
        round_to(F.avg("csat_score"), 2).alias("avg_csat"),
        flag_pct("escalated_flag").alias("escalation_rate_pct"),
        F.min("case_date").alias("first_case_date"),
        F.max("case_date").alias("last_case_date"),
    )


# --- commerce --------------------------------------------------------------------------------------


def commerce_performance(
    orders: DataFrame,
    gross: str = "gross_merchandise_value_eur",
    discount: str = "discount_eur",
    start=None,
    end=None,
) -> DataFrame:
    """Day x segment x channel x country x payment method of the enriched orders."""
    rows = in_period(orders.withColumn("report_date", F.col("order_date")), "report_date", start, end)
    status, paid = F.col("order_status"), F.col("payment_status")
    return rows.groupBy(
        "report_date", "customer_segment", "sales_channel", "destination_country", "payment_method"
    ).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("item_units").alias("units"),
        *[count_where(status == value).alias(f"{name}_orders") for name, value in ORDER_STATES.items()],
        round_to(exact_sum(gross), 2).alias("gross_merchandise_value_eur"),
        round_to(exact_sum(discount), 2).alias("discount_eur"),
        round_to(exact_sum("order_total_eur"), 2).alias("total_order_value_eur"),
        round_to(sum_where(status == "Completed", "order_total_eur"), 2).alias("completed_revenue_eur"),
        round_to(sum_where(status == "Returned", "order_total_eur"), 2).alias("returned_value_eur"),
        round_to(sum_where(status == "Cancelled", "order_total_eur"), 2).alias("cancelled_value_eur"),
        round_to(exact_avg("order_total_eur"), 2).alias("avg_order_value_eur"),
        count_where(paid == "Paid").alias("paid_payments"),
        count_where(paid == "Refunded").alias("refunded_payments"),
        count_where(paid == "Failed").alias("failed_payments"),
        round_to(sum_where(paid == "Paid", "payment_amount_eur"), 2).alias("paid_payment_value_eur"),
        round_to(sum_where(paid == "Refunded", "payment_amount_eur"), 2).alias("refunded_payment_value_eur"),
        round_to(exact_avg("fraud_score", 4), 4).alias("avg_fraud_score"),
        flag_pct("payment_paid_flag").alias("payment_success_rate_pct"),
        count_where(F.abs("payment_reconciliation_delta_eur") > 0.01).alias("reconciliation_mismatch_orders"),
    )


def payment_kpis(mart: DataFrame) -> DataFrame:
    """Payment success rate and mean value of completed orders over the commerce mart."""
    aov = exact_sum("completed_revenue_eur") / F.nullif(F.sum("completed_orders"), F.lit(0))
    return mart.agg(
        pct(F.sum("paid_payments"), F.sum("orders")).alias("payment_success_pct"),
        round_to(aov, 2).alias("completed_aov"),
    )

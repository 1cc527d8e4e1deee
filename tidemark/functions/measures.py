"""Mart measures as aggregate columns: ``mart.groupBy(...).agg(*measures("commerce"))``.

Rates are ratios of sums or weighted means; a percentage is never summed. All ratios are shares
(0 to 1) except the network load, which stays in percent as its mart column is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_where, exact_sum, safe_ratio, weighted_mean


def _sum(name: str) -> Column:
    return F.sum(name)


def _executive() -> dict[str, Column]:
    return {
        "total_orders": _sum("orders"),
        "total_shipments": _sum("shipments"),
        "purchase_events": _sum("purchase_events"),
        "data_incident_days": _sum("data_incident_flag"),
    }


def _commerce() -> dict[str, Column]:
    return {
        "total_order_value": exact_sum("total_order_value_eur"),
        "completed_revenue": exact_sum("completed_revenue_eur"),
        "returned_value": exact_sum("returned_value_eur"),
        "total_commerce_orders": _sum("orders"),
        "completed_orders": _sum("completed_orders"),
        "returned_orders": _sum("returned_orders"),
        "cancelled_orders": _sum("cancelled_orders"),
        "pending_orders": _sum("pending_orders"),
        "completed_aov": safe_ratio(exact_sum("completed_revenue_eur"), _sum("completed_orders")),
        "payment_success": safe_ratio(_sum("paid_payments"), _sum("orders")),
    }


def _logistics() -> dict[str, Column]:
    touches = _sum("shipment_touches")
    incident = F.when(F.col("business_incident_flag") == 1, F.col("shipment_touches")).otherwise(0)
    return {
        "shipment_touches": touches,
        "delayed_shipments": _sum("delayed_shipments"),
        "sla_met_shipments": _sum("sla_met_shipments"),
        "delay_rate": safe_ratio(_sum("delayed_shipments"), touches),
        "delivery_sla": safe_ratio(_sum("sla_met_shipments"), touches),
        "avg_network_load_pct": weighted_mean("avg_network_load_pct", "shipment_touches"),
        "incident_shipment_touches": F.sum(incident),
    }


def _reliability() -> dict[str, Column]:
    expected, observed = _sum("expected_purchase_count"), _sum("observed_purchase_count")
    wanted, seen = exact_sum("expected_revenue_eur"), exact_sum("observed_event_revenue_eur")
    return {
        "expected_purchases": expected,
        "observed_purchases": observed,
        "missing_purchase_events": _sum("missing_purchase_events"),
        "event_coverage": safe_ratio(observed, expected),
        "expected_revenue": wanted,
        "observed_event_revenue": seen,
        "revenue_capture": safe_ratio(seen, wanted),
        "data_trust_failed_days": count_where(F.col("data_trust_status") == "FAILED"),
    }


def _support() -> dict[str, Column]:
    incident = F.when(F.col("business_incident_flag") == 1, F.col("support_cases")).otherwise(0)
    return {
        "support_cases": _sum("support_cases"),
        # A sum of distinct counts per group; use count_distinct on the cases for distinct customers.
        "affected_customers": _sum("customers_contacting"),
        "support_sla": weighted_mean("support_sla_pct", "support_cases") / F.lit(100.0),
        "avg_csat": weighted_mean("avg_csat", "support_cases"),
        "escalation_rate": weighted_mean("escalation_rate_pct", "support_cases") / F.lit(100.0),
        "incident_support_cases": F.sum(incident),
    }


def _incidents() -> dict[str, Column]:
    return {
        "total_incidents": F.count(F.lit(1)),
        "data_incidents": count_where(F.col("classification") == "DATA_INCIDENT"),
        "business_incidents": count_where(F.col("classification") == "BUSINESS_INCIDENT"),
        "failed_trust_incidents": count_where(F.col("data_trust_status") == "FAILED"),
        "critical_incidents": count_where(F.col("severity") == "Critical"),
        "max_incident_confidence": F.max("confidence_score"),
        "max_anomaly_score": F.max("anomaly_score"),
    }


CATALOG = {
    "executive": _executive,
    "commerce": _commerce,
    "logistics": _logistics,
    "reliability": _reliability,
    "support": _support,
    "incidents": _incidents,
}


def measures(mart: str) -> list[Column]:
    """All measures of one mart, named."""
    return [column.alias(name) for name, column in CATALOG[mart]().items()]

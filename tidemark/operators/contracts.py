"""Contracts of built tables: an observed total next to the total it must equal.

Each side is an aggregate in long form, (check, value). The two sides meet by check name in one small
grouping, so a contract is one aggregate per table whatever the number of checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_where, exact_sum
from tidemark.operators.census import Census, Source, Use


def days_since_epoch(day: Column) -> Column:
    """A date as a number, so that dates and totals fit one value column."""
    return F.unix_date(day)


def totals(df: DataFrame, side: str, checks: dict[str, Column]) -> DataFrame:
    """Named aggregates of a table as (check, side, value) rows."""
    names = {check: f"c{i}" for i, check in enumerate(checks)}
    row = df.agg(*[agg.cast("double").alias(names[check]) for check, agg in checks.items()])
    items = [F.struct(F.lit(check).alias("check_name"), F.col(n).alias("value")) for check, n in names.items()]
    return row.select(F.lit(side).alias("side"), F.inline(F.array(*items)))


def observed(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return totals(df, "observed", checks)


def expected(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return totals(df, "expected", checks)


def must_be(df: DataFrame, checks: dict[str, float]) -> DataFrame:
    """Expected constants, as rows next to the observed ones. ``df`` only lends the session."""
    rows = [(check, float(value)) for check, value in checks.items()]
    frame = df.sparkSession.createDataFrame(rows, "check_name string, value double")
    return frame.select(F.lit("expected").alias("side"), "check_name", "value")


def contract(name: str, sides: list[DataFrame], tolerance: float = 0.01) -> DataFrame:
    """One row per check: expected, observed and PASS or FAIL. A missing side fails."""
    rows = reduce(lambda a, b: a.unionByName(b), sides)
    paired = rows.groupBy("check_name").agg(
        F.max(F.when(F.col("side") == "expected", F.col("value"))).alias("expected"),
        F.max(F.when(F.col("side") == "observed", F.col("value"))).alias("observed"),
    )
    close = F.abs(F.col("expected") - F.col("observed")) <= tolerance
    return paired.select(
        F.lit(name).alias("contract"),
        "check_name",
        "expected",
        "observed",
        F.when(F.coalesce(close, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
    )


def surplus_rows(df: DataFrame, key: str, check: str) -> DataFrame:
    """Rows of a key beyond its first, as an observed total."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return observed(counts, {check: F.coalesce(F.sum(F.col("n") - 1), F.lit(0))})


def enforce(checks: DataFrame) -> DataFrame:
    """The checks themselves, failing the job at the first one that did not pass."""
    message = F.concat_ws(" ", "contract", "check_name", F.lit("failed"))
    status = F.when(F.col("status") == "PASS", F.col("status")).otherwise(F.raise_error(message))
    return checks.withColumn("status", status)


def row_count_contract(tables: dict[str, DataFrame], counts: dict[str, int], name: str = "row_counts") -> DataFrame:
    """Row counts of the tables against the given numbers."""
    sides = [observed(tables[t], {t: F.count(F.lit(1))}) for t in counts]
    return contract(name, [*sides, must_be(next(iter(tables.values())), counts)])


def silver_contract(
    orders: DataFrame,
    shipments: DataFrame,
    cases: DataFrame,
    funnel: DataFrame,
    sources: dict[str, DataFrame],
) -> DataFrame:
    """Enriched models keep the rows and keys of their sources, payments agree, purchases add up."""
    n = F.count(F.lit(1))
    mismatch = count_where(F.abs("payment_reconciliation_delta_eur") > 0.01)
    purchases = count_where(F.col("event_type") == "purchase")
    zeros = {"order_duplicates": 0, "shipment_duplicates": 0, "case_duplicates": 0, "payment_mismatches": 0}
    return contract(
        "silver",
        [
            observed(orders, {"orders": n, "payment_mismatches": mismatch}),
            observed(shipments, {"shipments": n}),
            observed(cases, {"cases": n}),
            observed(funnel, {"purchases": F.coalesce(F.sum("purchase_events"), F.lit(0))}),
            surplus_rows(orders, "order_id", "order_duplicates"),
            surplus_rows(shipments, "shipment_id", "shipment_duplicates"),
            surplus_rows(cases, "case_id", "case_duplicates"),
            expected(sources["orders"], {"orders": n}),
            expected(sources["shipments"], {"shipments": n}),
            expected(sources["support_cases"], {"cases": n}),
            expected(sources["app_events"], {"purchases": purchases}),
            must_be(orders, zeros),
        ],
    )


def executive_contract(
    mart: DataFrame, bounds: DataFrame, orders: DataFrame, shipments: DataFrame, cases: DataFrame, events: DataFrame
) -> DataFrame:
    """One row per calendar day between the bounds, and totals as in the sources."""
    n = F.count(F.lit(1))
    span = F.datediff(F.max("end_date"), F.min("start_date")) + 1
    return contract(
        "executive_daily",
        [
            observed(
                mart,
                {
                    "rows": n,
                    "unique_dates": F.count_distinct("report_date"),
                    "min_date": days_since_epoch(F.min("report_date")),
                    "max_date": days_since_epoch(F.max("report_date")),
                    "orders": F.sum("orders"),
                    "shipments": F.sum("shipments"),
                    "support_cases": F.sum("support_cases"),
                    "purchase_events": F.sum("purchase_events"),
                },
            ),
            expected(
                bounds,
                {
                    "rows": span,
                    "unique_dates": span,
                    "min_date": days_since_epoch(F.min("start_date")),
                    "max_date": days_since_epoch(F.max("end_date")),
                },
            ),
            expected(orders, {"orders": n}),
            expected(shipments, {"shipments": n}),
            expected(cases, {"support_cases": n}),
            expected(events, {"purchase_events": count_where(F.col("event_type") == "purchase")}),
        ],
    )


def logistics_contract(mart: DataFrame, shipments: DataFrame, incidents: DataFrame) -> DataFrame:
    """Touches are twice the shipments, the dates agree, and incidents show where there are any."""
    incident = F.sum(F.when(F.col("business_incident_flag") == 1, F.col("shipment_touches")).otherwise(0))
    return contract(
        "logistics_performance",
        [
            observed(
                mart,
                {
                    "shipment_touches": F.sum("shipment_touches"),
                    "min_date": days_since_epoch(F.min("report_date")),
                    "max_date": days_since_epoch(F.max("report_date")),
                    "incident_visible": (incident > 0).cast("int"),
                },
            ),
            expected(
                shipments,
                {
                    "shipment_touches": F.count(F.lit(1)) * 2,
                    "min_date": days_since_epoch(F.min("shipment_date")),
                    "max_date": days_since_epoch(F.max("shipment_date")),
                },
            ),
            expected(incidents, {"incident_visible": (F.count(F.lit(1)) > 0).cast("int")}),
        ],
    )


def reliability_contract(mart: DataFrame, days: DataFrame, incident: DataFrame) -> DataFrame:
    """One row per reconciled day, and incident totals as in the incident record."""
    bad = F.col("data_incident_flag") == 1

    def within(name: str) -> Column:
        return F.sum(F.when(bad, F.col(name)).otherwise(0))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    n = F.count(F.lit(1))
    return contract(
        "data_reliability",
        [
            observed(
                mart,
                {
                    "rows": n,
                    "unique_dates": F.count_distinct("report_date"),
                    "incident_days": F.sum("data_incident_flag"),
                    "expected_purchases": within("expected_purchase_count"),
                    "observed_purchases": within("observed_purchase_count"),
                    "missing_purchases": within("missing_purchase_events"),
                    "null_values": within("purchase_value_null_count"),
                },
            ),
            expected(days, {"rows": n, "unique_dates": n}),
            expected(
                incident,
                {
                    "incident_days": total("anomalous_days"),
                    "expected_purchases": total("expected_purchase_events"),
                    "observed_purchases": total("observed_purchase_events"),
                    "missing_purchases": total("missing_purchase_events"),
                    "null_values": total("null_purchase_values"),
                },
            ),
        ],
    )


def customer_contract(mart: DataFrame, cases: DataFrame, repeated: DataFrame) -> DataFrame:
    """All cases are in the mart; a case in several incidents counts once more for each further one.

    ``repeated`` holds (shipment_id, incidents) of the shipments on incident days.
    """
    extra = cases.join(repeated, "shipment_id", "left").select(
        F.greatest(F.coalesce("incidents", F.lit(1)), F.lit(1)).alias("times")
    )
    return contract(
        "customer_experience",
        [
            observed(mart, {"support_cases": F.sum("support_cases")}),
            expected(extra, {"support_cases": F.sum("times")}),
        ],
    )


def commerce_contract(mart: DataFrame, orders: DataFrame) -> DataFrame:
    """Seven totals of the mart equal those of the enriched orders, and the statuses add up."""
    states = ["completed", "returned", "cancelled", "pending"]
    by_state = {
        f"{s}_orders": count_where(F.col("order_status") == s.capitalize()) for s in states
    }
    summed = reduce(lambda a, b: a + b, [F.sum(f"{s}_orders") for s in states])
    mismatch = count_where(F.abs("payment_reconciliation_delta_eur") > 0.01)
    n = F.count(F.lit(1))
    return contract(
        "commerce_performance",
        [
            observed(
                mart,
                {
                    "orders": F.sum("orders"),
                    "status_total": summed,
                    **{f"{s}_orders": F.sum(f"{s}_orders") for s in states},
                    "units": F.sum("units"),
                    "order_value": exact_sum("total_order_value_eur"),
                    "mismatches": F.sum("reconciliation_mismatch_orders"),
                },
            ),
            expected(
                orders,
                {
                    "orders": n,
                    "status_total": n,
                    **by_state,
                    "units": F.sum("item_units"),
                    "order_value": exact_sum("order_total_eur"),
                    "mismatches": mismatch,
                },
            ),
        ],
    )


def command_center_contract(center: DataFrame, registry: DataFrame) -> DataFrame:
    """Class and trust counts, windows and key figures of the view equal those of the registry."""

    def checks(start: str, end: str) -> dict[str, Column]:
        def of(column: str, value: str) -> Column:
            return count_where(F.col(column) == value)

        return {
            "incidents": F.count(F.lit(1)),
            "data_incidents": of("classification", "DATA_INCIDENT"),
            "business_incidents": of("classification", "BUSINESS_INCIDENT"),
            "failed_trust": of("data_trust_status", "FAILED"),
            "passed_trust": of("data_trust_status", "PASSED"),
            "first_start": days_since_epoch(F.min(start)),
            "last_end": days_since_epoch(F.max(end)),
            "missing_records": F.sum("missing_records"),
            "affected_records": F.sum("affected_records"),
            "max_confidence": F.max("confidence_score"),
        }

    return contract(
        "incident_command_center",
        [
            observed(center, checks("incident_start_date", "incident_end_date")),
            expected(registry, checks("detected_start_date", "detected_end_date")),
        ],
    )


def source_assertions(t: dict[str, DataFrame]) -> DataFrame:
    """Rules that hold between the raw tables: keys, references, ranges, dates, funnel, disjoint sets.

    ``t`` maps the table names of the domain to frames. All but the signup rule come from one tagged census, which reads
    every table once; that rule compares each order with its customer and needs a join.
    """
    checks = {
        "orders": {"order_total_eur >= 0": F.col("order_total_eur") < 0},
        "order_items": {"net_value_eur >= 0": F.col("net_value_eur") < 0},
        "shipments": {
            "actual_transit_hours > 0": F.col("actual_transit_hours") <= 0,
            "distance_km > 0": F.col("distance_km") <= 0,
            "delivered has delivery_ts": (F.col("lost_flag") == 0) & F.col("delivery_ts").isNull(),
            "lost has no delivery_ts": (F.col("lost_flag") == 1) & F.col("delivery_ts").isNotNull(),
        },
        "support_cases": {
            "first_response_ts >= created_ts": F.col("first_response_ts") < F.col("created_ts"),
            "resolved_ts >= first_response_ts": F.col("resolved_ts") < F.col("first_response_ts"),
            "first_response_minutes > 0": F.col("first_response_minutes") <= 0,
            "resolution_hours > 0": F.col("resolution_hours") <= 0,
            "csat_score 1..5": ~F.col("csat_score").between(1, 5),
        },
    }
    uses = {
        "customers": [Use("customer", "customers", "customer_id")],
        "orders": [Use("order", "orders", "order_id"), Use("customer", "orders", "customer_id")],
        "order_items": [Use("item", "order_items", "order_item_id"), Use("order", "order_items", "order_id")],
        "payments": [Use("payment", "payments", "payment_id"), Use("order", "payments", "order_id")],
        "warehouses": [Use("hub", "warehouses", "warehouse_id")],
        "carriers": [Use("carrier", "carriers", "carrier_id")],
        "shipments": [
            Use("shipment", "shipments", "shipment_id"),
            Use("shipment", "unscanned", "shipment_id", F.col("no_scan_flag") == 1),
            Use("order", "shipments", "order_id"),
            Use("hub", "origins", "origin_warehouse_id"),
            Use("hub", "destinations", "destination_warehouse_id"),
            Use("carrier", "shipments", "carrier_id"),
        ],
        "tracking_events": [
            Use("tracking", "tracking_events", "event_id"),
            Use("shipment", "tracking_events", "shipment_id"),
            Use("shipment", "scans", "shipment_id", F.col("event_type") == "ORIGIN_SCAN"),
        ],
        "support_cases": [
            Use("case", "support_cases", "case_id"),
            Use("order", "support_cases", "order_id"),
            Use("shipment", "support_cases", "shipment_id"),
        ],
        "app_events": [
            Use("event", "app_events", "event_id"),
            Use("order", "app_events", "order_id", F.col("order_id").isNotNull()),
        ],
    }
    found = Census([
        Source(t[name], uses[name], {f"{name}.{rule}": broken for rule, broken in checks.get(name, {}).items()}) for name in uses
    ])
    unique = {
        "orders.order_id": "order", "order_items.order_item_id": "item", "payments.payment_id": "payment",
        "shipments.shipment_id": "shipment", "tracking_events.event_id": "tracking", "support_cases.case_id": "case",
        "app_events.event_id": "event",
    }
    known = {
        "orders.customer_id": ("customer", "orders", "customers"),
        **{f"{child}.order_id": ("order", child, "orders") for child in ("order_items", "payments", "shipments", "support_cases", "app_events")},
        "shipments.origin_warehouse_id": ("hub", "origins", "warehouses"),
        "shipments.destination_warehouse_id": ("hub", "destinations", "warehouses"),
        "shipments.carrier_id": ("carrier", "shipments", "carriers"),
        **{f"{child}.shipment_id": ("shipment", child, "shipments") for child in ("tracking_events", "support_cases")},
    }
    linked, scans, unscanned = (found.count(*x) for x in (("order", "app_events"), ("shipment", "scans"), ("shipment", "unscanned")))
    wanted = {f"{column}.unique": found.surplus(kind, column.split(".")[0]) for column, kind in unique.items()}
    wanted |= {column: found.orphans(*sides) for column, sides in known.items()}
    wanted |= {f"{name}.{rule}": found.broken(f"{name}.{rule}") for name, rules in checks.items() for rule in rules}
    wanted["app_events five per linked order"] = found.keys_where("order", (linked > 0) & (linked != 5))
    wanted["no-scan shipments have no origin scan"] = found.keys_where("shipment", (unscanned > 0) & (scans > 0))
    rows = found.rows(wanted, lambda name, value: F.struct(F.lit(name).alias("assertion"), value.alias("failing_rows")))
    signups = t["customers"].select("customer_id", "signup_date")
    early = t["orders"].select("customer_id", F.to_date("order_ts").alias("day")).join(signups, "customer_id")
    early = early.agg(count_where(F.col("day") < F.col("signup_date")).cast("bigint").alias("failing_rows"))
    rows = rows.unionByName(early.select(F.lit("orders.order_ts >= signup_date").alias("assertion"), "failing_rows"))
    return rows.withColumn("status", F.when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL"))

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.measures import measures
from tidemark.operators import contracts, derive, profile
from tidemark.plans import gold, silver, staging
from tidemark.sources.schemas import TABLES, columns_of

D = dt.date


def test_daily_marts_and_conservation(spark, frame):
    orders = frame(
        [("o1", "c1", "2024-01-01", 10.0), ("o2", "c1", "2024-01-03", 5.5)],
        "order_id string, customer_id string, order_date date, order_total_eur double",
    )
    rows = gold.commerce_daily(orders).orderBy("report_date").collect()
    assert [(r.orders, r.total_order_value_eur) for r in rows] == [(1, 10.0), (1, 5.5)]


def funnel_events(frame):
    return frame(
        [
            ("2024-01-01 10:00:00", "s1", "c1", "product_view", None),
            ("2024-01-01 10:01:00", "s1", "c1", "add_to_cart", None),
            ("2024-01-01 10:02:00", "s2", "c1", "purchase", 9.99),
            ("2024-01-01 10:03:00", None, None, "purchase", None),
            ("2024-01-02 00:00:00", "s3", "c2", "search", None),
        ],
        "event_ts timestamp_ntz, session_id string, customer_id string, event_type string, event_value_eur double",
    )


def test_funnel_counts_nulls_and_zero_denominators(frame):
    rows = {str(r.event_date): r for r in silver.app_funnel_daily(funnel_events(frame)).collect()}
    first, second = rows["2024-01-01"], rows["2024-01-02"]
    assert (first.total_events, first.sessions, first.active_customers) == (4, 2, 1)
    assert (first.purchase_events, first.purchase_value_null_count, first.purchase_event_revenue_eur) == (2, 1, 9.99)
    assert (first.view_to_cart_pct, first.checkout_to_purchase_pct, first.purchase_value_completeness_pct) == (100.0, None, 50.0)
    assert (second.search_events, second.purchase_event_revenue_eur, second.view_to_cart_pct) == (1, 0.0, None)


def logistics_rows(spark):
    columns = (
        "shipment_id string, shipment_date date, carrier_id string, carrier_name string, service_tier string, "
        "route_name string, route_scope string, origin_warehouse_id string, destination_warehouse_id string, "
        "delayed_flag int, sla_met int, no_scan_flag int, damaged_flag int, lost_flag int, any_issue_flag int, "
        "network_load_factor double, actual_transit_hours double, delay_hours double, distance_km double, "
        "order_total_eur double"
    )

    def row(sid, day, a, b, load=0.5, total=10.0):
        return (sid, D(2024, 1, day), "k", "K", "Economy", f"{a} → {b}", "Domestic", a, b, 0, 1, 0, 0, 0, 0, load, 5.0, 0.0, 9.0, total)

    rows = [row("s1", 1, "A", "B"), row("s1", 1, "A", "B"), row("s2", 1, "A", "B", None, None), row("s3", 2, "A", "A", 1.2)]
    return spark.createDataFrame(rows, columns)


def hubs(spark):
    return spark.createDataFrame([("A", "a", "x"), ("B", "b", "x")], "warehouse_id string, city string, country string")


def incidents(spark, kind="BUSINESS_INCIDENT_CANDIDATE"):
    return spark.createDataFrame(
        [("i1", kind, "A", D(2024, 1, 2), D(2024, 1, 3), 80.0), ("i2", kind, "A", D(2024, 1, 2), D(2024, 1, 2), 90.0)],
        "candidate_incident_id string, classification string, warehouse_id string, start_date date, end_date date, "
        "anomaly_score double",
    )


def test_logistics_touches_distinct_shipments_and_incidents(spark):
    mart = gold.logistics_performance(logistics_rows(spark), hubs(spark), incidents(spark)).cache()
    origin = mart.where("warehouse_id = 'A' and warehouse_role = 'Origin' and report_date = '2024-01-01'").first()
    assert (origin.shipment_touches, origin.shipments, origin.handled_order_value_eur) == (3, 2, 20.0)
    assert origin.avg_network_load_pct == 50.0 and origin.business_incident_flag == 0
    same = mart.where("report_date = '2024-01-02'").collect()
    assert {r.warehouse_role for r in same} == {"Origin", "Destination"}
    assert all((r.anomaly_score, r.operational_status) == (90.0, "Business Incident") for r in same)
    assert mart.agg(F.sum("shipment_touches")).first()[0] == 8
    other = gold.logistics_performance(logistics_rows(spark), hubs(spark), incidents(spark, "OTHER"))
    assert other.where("operational_status = 'Over Capacity'").count() == 2
    checks = contracts.logistics_contract(mart, logistics_rows(spark), incidents(spark)).collect()
    assert {c.status for c in checks} == {"PASS"}
    load = mart.agg(*measures("logistics")).first()
    assert load.incident_shipment_touches == 2 and load.delay_rate == 0.0


def test_case_in_two_incidents(spark):
    cases = spark.createDataFrame(
        [("x1", "s3", D(2024, 1, 5), "c1", 1, 3, 0), ("x2", "s1", D(2024, 1, 5), "c1", 0, 5, 1)],
        "case_id string, shipment_id string, case_date date, customer_id string, support_sla_met int, csat_score int, "
        "escalated_flag int",
    )
    names = [c for c in [*gold.CASE_DIMENSIONS] if c not in cases.columns]
    flags = ["response_sla_met", "resolution_sla_met", "reopened_flag"]
    flags += [f"shipment_{f}_flag" for f in ("delayed", "no_scan", "damaged", "lost")]
    full = cases.withColumns(
        {**{c: F.lit("v") for c in names}, **{c: F.lit(0) for c in flags}}
        | {c: F.lit(1.0) for c in ("first_response_minutes", "resolution_hours", "network_load_factor")}
    )
    ships = logistics_rows(spark)
    mart = gold.customer_experience(full, ships, incidents(spark))
    assert mart.agg(F.sum("support_cases")).first()[0] == 3
    both = {r.case_group: r.support_cases for r in gold.incident_vs_normal(full, ships, incidents(spark)).collect()}
    assert both == {"incident": 1, "normal": 1}
    repeated = spark.createDataFrame([("s3", 2)], "shipment_id string, incidents bigint")
    assert contracts.customer_contract(mart, full, repeated).first().status == "PASS"


def enriched(spark):
    """Shipments with known, unknown and missing keys; one carrier is there twice."""
    flags = ["delayed_flag", "no_scan_flag", "damaged_flag", "lost_flag"]
    rows = [("s1", 1, 10, "A", "B"), ("s2", 1, 11, "A", "A"), ("s3", None, 12, None, "Z"), ("s4", 9, None, "B", None)]
    shipments = spark.createDataFrame(rows, "shipment_id string, order_id bigint, carrier_id bigint, origin_warehouse_id string, destination_warehouse_id string")
    shipments = shipments.withColumns({c: F.lit(0) for c in [*flags, "cross_border"]} | {c: F.lit("c") for c in ("origin_city", "destination_city")})
    shipments = shipments.withColumns({"network_load_factor": F.lit(0.5), "shipment_created_ts": F.lit("2024-01-02").cast("timestamp_ntz")})
    orders = spark.createDataFrame([(1, 7, "x", "w", "Completed", 2.5, "Paid")], "order_id bigint, customer_id bigint, customer_segment string, sales_channel string, order_status string, order_total_eur double, payment_status string")
    hubs = spark.createDataFrame([("A", "Gateway", 5), ("B", "Regional", 6)], "warehouse_id string, warehouse_type string, daily_capacity int")
    carriers = spark.createDataFrame([(10, 0.9), (10, 0.8), (12, 0.7)], "carrier_id bigint, reliability_score double")
    return silver.shipments_enriched(shipments, orders, hubs, carriers)


def test_enriched_shipments_with_unknown_and_repeated_keys(spark):
    df = enriched(spark)
    columns = ["shipment_id", "customer_id", "origin_warehouse_type", "destination_daily_capacity", "carrier_reliability_score"]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, [
        ("s1", 7, "Gateway", 6, 0.8), ("s1", 7, "Gateway", 6, 0.9), ("s2", 7, "Gateway", 5, None), ("s3", None, None, None, 0.7), ("s4", None, "Regional", None, None),
    ]))
    assert df.columns[:4] == ["carrier_id", "destination_warehouse_id", "origin_warehouse_id", "order_id"]
    assert df.columns.index("carrier_reliability_score") == df.columns.index("destination_daily_capacity") + 1


def test_enriched_shipments_meet_hubs_after_the_joins_that_may_shuffle(spark):
    plan = enriched(spark)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 4
    assert ["warehouse_id" in line for line in joins] == [True, True, False, False]


def case_rows(spark, rows):
    """Cases of one day that differ in id, shipment, customer and priority only."""
    cases = spark.createDataFrame([(*r, D(2024, 1, 5)) for r in rows], "case_id string, shipment_id string, customer_id bigint, priority string, case_date date")
    names = [c for c in gold.CASE_DIMENSIONS if c not in cases.columns]
    flags = ["support_sla_met", "escalated_flag", "csat_score", "response_sla_met", "resolution_sla_met", "reopened_flag"]
    flags += [f"shipment_{f}_flag" for f in ("delayed", "no_scan", "damaged", "lost")]
    return cases.withColumns(
        {**{c: F.lit(None).cast("string") if c == "carrier_name" else F.lit("v") for c in names}, **{c: F.lit(0) for c in flags}}
        | {c: F.lit(1.0) for c in ("first_response_minutes", "resolution_hours", "network_load_factor")}
    )


def test_customers_and_shipments_of_cases_are_distinct_counts(spark):
    rows = [("x1", "s1", 1, "Low"), ("x1", "s1", 1, "Low"), ("x2", "s1", 2, "Low"), ("x3", "s9", 2, "Low"), ("x4", None, 2, "Low"), ("x5", None, None, "Low"),
            ("x6", "s1", 1, None), ("x7", None, None, None), ("x8", "s3", 1, "High"), ("x9", "s3", 1, "High")]
    mart = gold.customer_experience(case_rows(spark, rows), logistics_rows(spark), incidents(spark)).collect()
    got = {(r.priority, r.candidate_incident_id): (r.support_cases, r.customers_contacting, r.shipments_with_cases) for r in mart}
    assert got == {("Low", None): (6, 2, 2), (None, None): (2, 1, 1), ("High", "i1"): (2, 1, 1), ("High", "i2"): (2, 1, 1)}
    assert gold.customer_experience(case_rows(spark, []), logistics_rows(spark), incidents(spark)).count() == 0


def test_customer_mart_sends_each_case_once(spark):
    mart = gold.customer_experience(case_rows(spark, [("x1", "s1", 1, "Low")]), logistics_rows(spark), incidents(spark))
    assert "Expand" not in mart._jdf.queryExecution().executedPlan().toString()


def test_executive_days_without_rows(spark, frame):
    bounds = frame([("2024-01-01", "2024-01-04")], "start_date date, end_date date")
    orders = spark.createDataFrame(
        [("o", D(2024, 1, 2), 1, 0, 12.5)],
        "order_id string, order_date date, purchase_realized_flag int, cancelled_order_flag int, order_total_eur double",
    )
    cases = spark.createDataFrame(
        [], "case_date date, support_sla_met int, csat_score int, escalated_flag int, reopened_flag int"
    )
    days = spark.createDataFrame(
        [],
        "date date, expected_purchase_count bigint, observed_purchase_count bigint, expected_revenue_eur double, "
        "observed_revenue_eur double, missing_purchase_pct double, purchase_value_null_pct double, "
        "purchase_count_ratio double, revenue_ratio double, incident_flag int",
    )
    funnel = silver.app_funnel_daily(funnel_events(frame))
    mart = gold.executive_daily(orders, logistics_rows(spark), cases, funnel, days, bounds)
    rows = {r.report_date.day: r for r in mart.collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert (rows[2].orders, rows[2].realized_revenue_eur, rows[1].orders, rows[1].avg_order_value_eur) == (1, 12.5, 0, None)
    assert (rows[4].shipments, rows[4].delivery_sla_pct, rows[4].data_trust_status) == (0, None, "PASSED")


def test_contract_reports_and_enforces(spark):
    df = spark.range(3)
    checks = contracts.row_count_contract({"a": df, "b": df}, {"a": 3, "b": 4})
    assert {r.check_name: r.status for r in checks.collect()} == {"a": "PASS", "b": "FAIL"}
    with pytest.raises(Exception, match="row_counts b failed"):
        contracts.enforce(checks).collect()


def test_staging_casts(spark):
    times = columns_of(TABLES["orders"], "timestamp_ntz")
    names = columns_of(TABLES["orders"])
    row = tuple("2025-01-02 03:04:05" if name in times else None for name in names)
    df = spark.createDataFrame([row], ", ".join(f"{name} string" for name in names))
    staged = staging.stage("orders", df)
    assert str(staged.first().order_date) == "2025-01-02"
    assert staged.schema["order_ts"].dataType.simpleString() == "timestamp_ntz"


def test_line_values_and_fees(spark):
    items = spark.createDataFrame([(1, 3, 9.99, 0.1), (2, 1, 50.0, 0.0)], "order_id int, quantity int, unit_price_eur double, discount_pct double")
    orders = spark.createDataFrame([(1,), (2,), (3,)], "order_id int")
    rows = {r.order_id: r for r in derive.order_financials(orders, derive.line_values(items)).collect()}
    assert (rows[1].merchandise_revenue_eur, rows[1].shipping_fee_eur, rows[1].order_total_eur) == (26.97, 6.99, 33.96)
    assert rows[2].shipping_fee_eur == 3.99
    edge = spark.createDataFrame([(80.0,), (79.99,), (40.0,), (39.99,)], "n double")
    assert [r[0] for r in edge.select(derive.shipping_fee("n")).collect()] == [0.0, 3.99, 3.99, 6.99]


def test_triage_and_sla(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1, 0.5), (0, 1, 1, 1, 0.5), (0, 0, 1, 1, 0.5), (0, 0, 0, 1, 0.9), (0, 0, 0, 1, 0.8), (0, 0, 0, 0, 0.5)],
        "lost_flag int, damaged_flag int, no_scan_flag int, delayed_flag int, network_load_factor double",
    )
    rows = derive.case_triage(df).collect()
    assert [r.priority for r in rows] == ["Critical", "High", "Medium", "Medium", "Medium", "Low"]
    assert [r.root_cause_category for r in rows] == [
        "Chain of Custody", "Handling Damage", "Scan Quality", "Network Congestion", "Carrier Performance", "General Service",
    ]
    assert rows[-1].support_team == "Customer Care"
    cases = spark.createDataFrame([("Critical", 30.0, 12.0), ("Critical", 30.1, 12.0), ("Low", 1.0, 72.1)], "priority string, first_response_minutes double, resolution_hours double")
    assert [r.support_sla_met for r in derive.sla_evaluation(cases).collect()] == [1, 0, 0]


def test_delay_risk_bounds(spark, frame):
    df = frame([("2025-11-01 00:00:00", 2.0, 0.1, 0.1, 2000.0), ("2025-06-04 00:00:00", 0.1, 1.0, 1.0, 10.0)], "t timestamp_ntz, l double, c double, h double, d double")
    got = [r[0] for r in df.select(derive.delay_risk(*[F.col(c) for c in "lchdt"])).collect()]
    assert got == [0.45, 0.035]


def test_profile_and_value_counts(spark):
    df = spark.createDataFrame([("a", 1, 2.5), ("a", 0, 3.5), (None, 1, None)], "k string, f int, x double")
    got = {r.metric: r.value for r in profile.table_profile(df, "t", ["k"], ["f"], ["x"], ["x"]).collect()}
    assert got == {"rows": "3", "f.share_pct": "66.67", "x.mean": "3.00", "x.sum": "600", "k.distinct": "1"}


def test_event_sequence_and_contacts(frame):
    df = frame(
        [("e1", "s", "2024-01-02 00:00:00"), ("e2", "s", "2024-01-01 05:00:00"), ("e0", "s", "2024-01-02 00:00:00")],
        "event_id string, shipment_id string, event_ts timestamp_ntz",
    )
    got = {r.event_id: r.event_sequence for r in derive.event_sequence(df).collect()}
    assert got == {"e2": 1, "e0": 2, "e1": 3}

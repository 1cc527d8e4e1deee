import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, reconciliation
from tidemark.operators.quality import ColumnRules, TableRules


def by_id(df):
    return {r.control_id: r for r in df.collect()}


def test_table_controls_edge_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "c"), (None, "d"), (None, "e")], "id int, v string")
    rows = by_id(quality.table_controls(df, "things", TableRules(["id"], ["id", "v", "w"], ["id", "v"])))
    assert rows["THINGS_SCHEMA"].details == "Missing columns: w"
    assert (rows["THINGS_PK"].observed, rows["THINGS_PK"].status) == ("3", "FAIL")
    assert rows["THINGS_CRITICAL_NULLS"].observed_num == 3.0


def test_table_controls_without_key_or_rows(spark):
    df = spark.createDataFrame([], "v string")
    rows = by_id(quality.table_controls(df, "t", TableRules(["id"], ["id"], ["v"])))
    assert set(rows) == {"T_SCHEMA", "T_CRITICAL_NULLS"}
    assert rows["T_CRITICAL_NULLS"].status == "PASS"


def test_reference_control_counts_rows_not_keys(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    row = quality.reference_control(child, "k", parent, "k", "child", "parent").first()
    assert (row.control_id, row.observed, row.status) == ("CHILD_PARENT_FK", "3", "FAIL")


def test_amount_control_tolerance_and_missing_payment(spark):
    orders = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 10.0), (4, 5.0)], "order_id int, order_total_eur double")
    paid = spark.createDataFrame([(1, 10.0), (2, 10.005), (3, 10.02)], "order_id int, payment_amount_eur double")
    assert quality.amount_control(orders, paid).first().observed == "1"
    twice = paid.union(paid)
    with pytest.raises(Exception, match="duplicate key"):
        quality.amount_control(orders, twice).collect()


def test_terminal_control(spark, frame):
    ships = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("d", 1), ("e", None)], "shipment_id string, lost_flag int")
    events = frame(
        [
            ("a", "DELIVERED", "2024-01-01 00:00:00", 1),
            ("a", "LOST", "2023-12-31 00:00:00", 2),
            ("c", "LOST", "2024-01-01 00:00:00", 1),
            ("c", "DELIVERED", "2024-01-01 00:00:00", 2),
            ("d", "LOST", "2024-01-01 00:00:00", 1),
            ("d", "IN_TRANSIT", "2024-01-09 00:00:00", 2),
        ],
        "shipment_id string, event_type string, event_ts timestamp_ntz, event_sequence bigint",
    )
    # b has no terminal event; c ends in DELIVERED at the same time but a later sequence.
    assert quality.terminal_control(ships, events).first().observed == "2"


def test_chronology_passes_equal_and_null(frame):
    df = frame(
        [
            ("2024-01-01 00:00:00", "2024-01-01 00:00:00", None),
            ("2024-01-02 00:00:00", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
            ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-01 12:00:00"),
        ],
        "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz",
    )
    assert quality.chronology_control(df, ["a", "b", "c"]).first().observed == "2"


def test_health_and_trust(spark):
    def row(domain, status, severity):
        return ("x", domain, "t", status, severity, "0", 0.0, "0", "")

    rows = [row("shipments", "PASS", "High"), row("app_events", "FAIL", "Critical"), row("orders", "PASS", "Low")]
    df = spark.createDataFrame(rows, quality.CONTROL_SCHEMA)
    assert quality.health_score(df).first()[0] == 44.44
    assert tuple(quality.domain_trust(df).first()) == (1, 0, 1)
    assert tuple(quality.trust_summary(df).first()) == (3, 1, 0)
    summary = quality.control_summary(df, spark.range(2)).first()
    assert tuple(summary) == (44.44, 3, 2, 1, 2)


def test_no_controls_means_trusted_and_healthy(spark):
    empty = quality.no_controls(spark)
    assert quality.health_score(empty).first()[0] == 100.0
    assert quality.domain_trust(empty).first().trusted == 1


def test_column_tests(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, None), (None, "z")], "id int, s string")
    rules = ColumnRules(["id"], ["id"], {"s": ["x", "y"]})
    got = {r.test: r.failing_rows for r in quality.column_tests(df, "m", rules).collect()}
    assert got == {"not_null": 2, "unique": 1, "accepted_values": 1}


# --- reconciliation ---

FEED = "date date, id int, amount double"


def feed(frame, day_counts, nulls=None, amount=1.0):
    rows = []
    for day, count in day_counts.items():
        blank = (nulls or {}).get(day, 0)
        rows += [(day, i, None if i < blank else amount) for i in range(count)]
    return frame(rows, FEED)


def days_of(frame, expected, observed, nulls=None, amount=1.0):
    df = reconciliation.daily_reconciliation(feed(frame, expected), feed(frame, observed, nulls, amount))
    return {str(r.date): r for r in df.collect()}


def test_reconciliation_gates(frame):
    d = [f"2024-01-0{i}" for i in range(1, 8)]
    expected = {d[0]: 19, d[1]: 20, d[2]: 20, d[3]: 100, d[4]: 100, d[5]: 20}
    observed = {d[0]: 5, d[1]: 17, d[2]: 16, d[3]: 100, d[4]: 100, d[6]: 50}
    rows = days_of(frame, expected, observed, {d[3]: 20, d[4]: 21})
    assert d[6] not in rows  # observed only
    assert rows[d[0]].incident_flag == 0  # under the gate
    assert rows[d[1]].incident_flag == 0 and rows[d[1]].purchase_count_ratio == 0.85
    assert rows[d[2]].incident_flag == 1
    assert rows[d[3]].incident_flag == 0 and rows[d[3]].purchase_value_null_pct == 20.0
    assert rows[d[4]].incident_flag == 1
    missing = rows[d[5]]
    assert (missing.observed_purchase_count, missing.purchase_value_null_pct, missing.revenue_ratio) == (0, 100.0, 0.0)


def test_reconciliation_revenue_edge_and_surplus(frame):
    rows = days_of(frame, {"2024-01-01": 20}, {"2024-01-01": 20}, amount=0.7)
    assert rows["2024-01-01"].revenue_ratio == 0.7 and rows["2024-01-01"].incident_flag == 0
    more = days_of(frame, {"2024-01-01": 20}, {"2024-01-01": 30})
    assert more["2024-01-01"].missing_purchase_pct == 0.0


def test_all_null_amounts_sum_to_zero(frame):
    rows = days_of(frame, {"2024-01-01": 20}, {"2024-01-01": 20}, {"2024-01-01": 20})
    assert rows["2024-01-01"].observed_revenue_eur == 0.0


def test_reliability_critical_while_trusted(frame):
    df = reconciliation.daily_reconciliation(feed(frame, {"2024-01-01": 10}), feed(frame, {"2024-01-01": 2}))
    row = reconciliation.reliability_daily(df).first()
    assert (row.data_trust_status, row.reliability_status) == ("PASSED", "Critical")


def test_incident_and_control(frame):
    good = reconciliation.daily_reconciliation(feed(frame, {"2024-01-01": 20}), feed(frame, {"2024-01-01": 20}))
    assert reconciliation.reconciliation_incident(good).count() == 0
    assert reconciliation.reconciliation_control(good).first().status == "PASS"
    days = {"2024-01-01": 20, "2024-01-03": 40, "2024-01-05": 20}
    bad = reconciliation.daily_reconciliation(feed(frame, days), feed(frame, {**days, "2024-01-01": 10, "2024-01-05": 10}))
    row = reconciliation.reconciliation_incident(bad).first()
    assert (str(row.start_date), str(row.end_date), row.anomalous_days) == ("2024-01-01", "2024-01-05", 2)
    assert (row.missing_purchase_events, row.observed_vs_expected_pct) == (20, 50.0)
    assert reconciliation.reconciliation_control(bad).first().observed == "2 anomalous days"
    assert bad.where(F.col("incident_flag") == 1).count() == 2

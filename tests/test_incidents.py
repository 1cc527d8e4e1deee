import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import briefs, grounding, registry

D = dt.date


def registry_frame(spark, rows):
    defaults = dict.fromkeys(registry.REGISTRY_COLUMNS)
    base = {
        "severity": "High", "domain": "d", "detected_start_date": D(2025, 9, 8), "detected_end_date": D(2025, 9, 14),
        "confidence_score": 97.5, "primary_cause": "Purchase Telemetry Failure", "affected_records": 523,
        "missing_records": 219, "data_trust_status": "FAILED", "business_metric": "m", "business_impact": "i",
        "recommended_action": "a", "evidence": "one. | two.", "duration_days": 7,
    }
    full = [{**defaults, **base, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[c] for c in registry.REGISTRY_COLUMNS) for r in full], registry.registry_schema()
    )


def data_incident(spark, **changes):
    row = {
        "domain": "app_events", "start_date": D(2025, 9, 8), "end_date": D(2025, 9, 14),
        "expected_purchase_events": 523, "observed_purchase_events": 304, "missing_purchase_events": 219,
        "null_purchase_values": 136, "observed_vs_expected_pct": 58.13, "revenue_capture_pct": 29.28, "evidence": "e",
        **changes,
    }
    return spark.createDataFrame([tuple(row.values())], (
        "domain string, start_date date, end_date date, expected_purchase_events bigint, "
        "observed_purchase_events bigint, missing_purchase_events bigint, null_purchase_values bigint, "
        "observed_vs_expected_pct double, revenue_capture_pct double, evidence string"))  # fmt: skip


@pytest.mark.parametrize("failures, want", [(0, 99.0), (2, 94.0)])
def test_data_record(spark, failures, want):
    trust = spark.createDataFrame([(failures,)], "non_app_failures bigint")
    row = registry.data_records(data_incident(spark), trust).first()
    assert (row.severity, row.confidence_score, row.null_value_pct) == ("Critical", want, 44.74)
    assert row.business_impact.startswith("219 purchase events missing; event revenue captured at 29.28%")


def test_data_severity_steps(spark):
    df = spark.createDataFrame([(60.0, 40.0), (80.0, 70.0), (59.9, 90.0), (79.0, 90.0)], "c double, r double")
    got = [r[0] for r in df.select(registry.data_severity(F.col("c"), F.col("r"))).collect()]
    assert got == ["High", "Medium", "Critical", "High"]


def test_business_record_without_report(spark):
    row = spark.createDataFrame(
        [("c1", "City", "Land", D(2025, 11, 18), D(2025, 12, 1), 27, 76.0, 4, "own evidence")],
        "candidate_incident_id string, city string, country string, start_date date, end_date date, shipments bigint, "
        "anomaly_score double, affected_support_cases bigint, evidence string",
    )
    reports = spark.createDataFrame(
        [],
        "candidate_incident_id string, confidence_score double, primary_root_cause string, "
        "baseline_metrics struct<delay_pct:double,avg_load_pct:double>, "
        "incident_metrics struct<delay_pct:double,avg_load_pct:double>, incident_support struct<cases:bigint>, "
        "data_trust struct<trusted:int>, evidence array<string>",
    )
    got = registry.business_records(row, reports).first()
    assert (got.confidence_score, got.severity, got.data_trust_status) == (76.0, "High", "PASSED")
    assert got.primary_cause == "Operational Performance Degradation"
    assert got.business_impact == (
        "27 shipments evaluated; delay rate n/a% -> n/a%; network load n/a% -> n/a%; 4 support cases affected."
    )
    assert got.evidence == "own evidence"


def test_registry_order_and_duration(spark):
    trust = spark.createDataFrame([(0,)], "non_app_failures bigint")
    data = registry.data_records(data_incident(spark), trust)
    business = data.withColumns(
        {"classification": F.lit("BUSINESS_INCIDENT"), "detected_start_date": F.lit(D(2025, 9, 8))}
    ).union(data.withColumn("detected_start_date", F.lit(D(2025, 9, 1))))
    rows = registry.incident_registry(data, business, "X-").orderBy("incident_id").collect()
    assert [(r.incident_id, r.classification, r.duration_days) for r in rows] == [
        ("X-001", "DATA_INCIDENT", 14),
        ("X-002", "BUSINESS_INCIDENT", 7),
        ("X-003", "DATA_INCIDENT", 7),
    ]


def test_briefs_by_class(spark):
    df = registry_frame(spark, [
        {"incident_id": "a", "classification": "DATA_INCIDENT", "event_coverage_pct": 58.13, "revenue_capture_pct": 29.28},
        {"incident_id": "b", "classification": "BUSINESS_INCIDENT", "location": "W, P", "anomaly_score": 98.63,
         "data_trust_status": "PASSED"},
        {"incident_id": "c", "classification": "OTHER"},
    ])
    rows = {r.incident_id: r for r in briefs.decision_briefs(df).collect()}
    assert rows["a"].decision_status == "PAUSE_KPI_DECISIONS" and "Only 58.13% of" in rows["a"].executive_summary
    assert rows["a"].key_metrics["missing_purchase_events"] == 219.0
    assert rows["b"].key_metrics == {"anomaly_score": 98.63, "affected_shipments": 523.0}
    assert "detected in W, P." in rows["b"].executive_summary
    assert (rows["c"].decision_status, rows["c"].key_metrics) == ("REVIEW_REQUIRED", {})
    assert rows["a"].evidence == ["one.", "two."]
    center = {r.incident_id: r for r in briefs.command_center(df, briefs.decision_briefs(df)).collect()}
    assert center["b"].investigation_path == "Investigate Business Operations"
    assert (center["a"].command_center_status, center["a"].severity_rank) == ("Do Not Trust KPI", 3)
    markdown = briefs.brief_markdown(briefs.decision_briefs(df)).where("incident_id = 'a'").first().markdown
    assert "- one.\n- two." in markdown and "**Confidence:** 97.50%" in markdown


def test_brief_contract_and_prompt_packs(spark):
    df = registry_frame(spark, [
        {"incident_id": "a", "classification": "DATA_INCIDENT", "event_coverage_pct": 1.0, "revenue_capture_pct": 1.0}])
    good = briefs.decision_briefs(df)
    assert briefs.brief_violations(good).first().violations == []
    pack = briefs.prompt_packs(good, "Report.", "Evidence:").first()
    assert pack.system_prompt == "Report."
    context = json.loads(pack.user_prompt.removeprefix("Evidence:\n\n"))
    assert context["incident"]["incident_id"] == "a" and context["incident"]["location"] is None
    assert context["analysis"]["evidence"] == ["one.", "two."]
    assert pack.guardrails.grounded_only and not pack.guardrails.allow_metric_invention
    preview = briefs.prompt_preview(briefs.prompt_packs(good, "", "")).first().markdown
    assert preview.startswith("## a\n\n**Classification:** DATA_INCIDENT") and "- Limitations required" in preview
    texts = spark.createDataFrame([("a", "text")], "incident_id string, report string")
    assert briefs.report_markdown(texts).first().markdown == "# a\n\ntext\n\n---"
    bad = good.withColumns({"classification": F.lit("X"), "confidence_score": F.lit(101.0)})
    assert len(briefs.brief_violations(bad).first().violations) == 2
    assert briefs.brief_violations(good.drop("evidence")).first().violations == ["missing required field: evidence"]
    with pytest.raises(Exception, match="Unsupported incident classification: X"):
        briefs.prompt_packs(bad, "", "").collect()


EVIDENCE = (
    "incident_id string, classification string, data_trust_status string, primary_cause string, start_date date, "
    "end_date date, confidence_score double"
)
GOOD = (
    "INC-001 is a data incident from 2025‑09‑08 to 2025-09-14, a seven-day window. The cause was a purchase "
    "telemetry failure; confidence 98. The data should not be trusted."
)


def check(spark, report, **changes):
    row = {
        "incident_id": "INC-001", "classification": "DATA_INCIDENT", "data_trust_status": "FAILED",
        "primary_cause": "Purchase Telemetry Failure", "start_date": D(2025, 9, 8), "end_date": D(2025, 9, 14),
        "confidence_score": 97.5, **changes,
    }
    evidence = spark.createDataFrame([tuple(row.values())], EVIDENCE)
    reports = spark.createDataFrame([("INC-001", report)], "incident_id string, report string")
    return grounding.validate_reports(reports, evidence).first()


def test_grounded_report_has_no_warnings(spark):
    assert check(spark, GOOD).warnings == []


def test_confidence_ties_go_to_even(spark):
    assert check(spark, GOOD.replace("98", "96"), confidence_score=96.5).warnings == []


@pytest.mark.parametrize(
    "change, count, word",
    [
        (("seven-day", "six-day"), 1, "report says 6 days, evidence implies 7 days"),
        (("seven-day", "6 day"), 1, "report says 6 days"),
        (("INC-001", "INC-002"), 1, "Incident ID"),
        (("purchase telemetry failure", "outage"), 1, "root cause"),
        (("2025-09-14", "14 Sept"), 1, "end date"),
        (("should not be trusted", "is fine"), 1, "failed data trust"),
        (("cause was", "cause was guaranteed and 100% certain"), 2, "Unsupported certainty"),
        (("data incident", "event"), 1, "classification"),
        (("confidence 98", "confidence 5"), 1, "confidence score"),
    ],
)
def test_single_faults(spark, change, count, word):
    row = check(spark, GOOD.replace(*change))
    assert row.warning_count == count and any(word in w for w in row.warnings)


def test_fault_at_the_end_of_a_long_text(spark):
    row = check(spark, GOOD + " filler" * 20000 + " a 9 day period, again a 9-day window")
    assert row.warnings == ["Incorrect incident duration: report says 9 days, evidence implies 7 days."] * 2


def test_business_trust_wording(spark):
    changes = {"classification": "BUSINESS_INCIDENT", "data_trust_status": "PASSED"}
    text = GOOD.replace("data incident", "business incident").replace("The data should not be trusted", "Controls passed")
    assert check(spark, text, **changes).warnings == []
    assert check(spark, text.replace("passed", "ran"), **changes).warning_count == 1


def test_concepts_rollup_and_corrections(spark):
    good = check(spark, GOOD)
    df = spark.createDataFrame([good, check(spark, "nothing")])
    both = df.withColumn("user_prompt", F.lit("EVIDENCE"))
    total = grounding.warning_rollup(both).first()
    assert (total.reports, total.reports_with_warnings, total.grounding_status) == (2, 1, "REVIEW")
    request = grounding.correction_requests(both, "Mend it.").collect()
    assert len(request) == 1 and "- Incident ID is missing from report.\n- " in request[0].correction_request
    assert request[0].correction_request.startswith("Mend it.\n\n") and request[0].correction_request.endswith("\n\nEVIDENCE")
    found = df.select(grounding.concept_warnings(F.col("report")).alias("w")).collect()
    # "should not be trusted" is none of the short check's trust words.
    assert found[0].w == [
        "Missing expected concepts: root cause, business impact, recommended",
        "Data incident report may not clearly communicate failed data trust.",
    ]
    assert len(found[1].w) == 2


def test_reports_that_cannot_be_checked_do_not_pass(spark):
    evidence = spark.createDataFrame([], EVIDENCE)
    reports = spark.createDataFrame([("INC-009", GOOD), ("INC-009", None), (None, "text")], "incident_id string, report string")
    rows = grounding.validate_reports(reports, evidence)
    assert [(r.checked, r.warnings, r.warning_count) for r in rows.collect()] == [(0, [], 0)] * 3
    total = grounding.warning_rollup(rows).first()
    assert (total.reports, total.reports_unchecked, total.total_warnings, total.grounding_status) == (3, 3, 0, "REVIEW")


def test_business_summary_tells_the_trust_verdict(spark):
    rows = [
        {"incident_id": i, "classification": "BUSINESS_INCIDENT", "data_trust_status": trust, "location": "W, P"}
        for i, trust in (("a", "PASSED"), ("b", "FAILED"), ("c", None))
    ]
    got = {r.incident_id: r.executive_summary for r in briefs.decision_briefs(registry_frame(spark, rows)).collect()}
    assert "controls passed" in got["a"]
    assert all("did not pass" in got[i] and "controls passed" not in got[i] for i in "bc")

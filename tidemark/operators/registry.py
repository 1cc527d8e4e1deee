"""One registry of data incidents and business incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import days_inclusive
from tidemark.functions.numeric import clip, round_to
from tidemark.functions.text import join_list, number, place
from tidemark.operators.ranking import number_all, numbered_id

REGISTRY_COLUMNS = [
    "incident_id", "classification", "severity", "domain", "location", "detected_start_date", "detected_end_date",
    "confidence_score", "primary_cause", "affected_records", "missing_records", "data_trust_status",
    "anomaly_score", "event_coverage_pct", "revenue_capture_pct", "null_value_pct", "business_metric",
    "business_impact", "recommended_action", "evidence", "duration_days",
]
# Wording and default cause of the records.
DATA_CAUSE = "Purchase Telemetry Failure"
DATA_METRIC = "Purchase Events / Event Revenue"
DATA_ACTION = (
    "Do not use affected purchase-event revenue for decision-making. "
    "Investigate telemetry pipeline, schema changes and purchase event emission."
)
DATA_IMPACT = "%d purchase events missing; event revenue captured at %s%% of trusted operational revenue."
BUSINESS_IMPACT = (
    "%d shipments evaluated; delay rate %s%% -> %s%%; network load %s%% -> %s%%; %d support cases affected."
)
BUSINESS_CAUSE = "Operational Performance Degradation"
BUSINESS_METRIC = "Delivery SLA / Delay Rate"
BUSINESS_ACTION = (
    "Investigate warehouse capacity, network load and operational throughput. "
    "Prioritize load balancing and temporary capacity mitigation."
)


def data_severity(coverage: Column, capture: Column) -> Column:
    return (
        F.when((capture < 40) | (coverage < 60), "Critical")
        .when((capture < 70) | (coverage < 80), "High")
        .otherwise("Medium")
    )


def business_severity(confidence: Column, shipments: Column) -> Column:
    critical = (confidence >= 90) & (shipments >= 100)
    return F.when(critical, "Critical").when(confidence >= 75, "High").otherwise("Medium")


def data_records(incidents: DataFrame, trust: DataFrame) -> DataFrame:
    """Registry rows of the data incidents; ``trust`` is the one-row control summary."""
    rows = incidents.withColumn("non_app_failures", trust.select("non_app_failures").scalar())
    coverage, capture = F.col("observed_vs_expected_pct"), F.col("revenue_capture_pct")
    observed = F.greatest(F.col("observed_purchase_events").cast("double"), F.lit(1.0))
    null_rate = F.col("null_purchase_values") / observed * 100
    confidence = (
        clip((100 - coverage) / 40 * 100, 0.0, 100.0) * 0.35
        + clip((100 - capture) / 60 * 100, 0.0, 100.0) * 0.35
        + clip(null_rate / 30 * 100, 0.0, 100.0) * 0.20
        + F.when(F.coalesce("non_app_failures", F.lit(0)) == 0, 100.0).otherwise(40.0) * 0.10
    )
    impact = F.format_string(DATA_IMPACT, F.col("missing_purchase_events"), number(capture))
    return rows.select(
        F.lit("DATA_INCIDENT").alias("classification"),
        data_severity(coverage, capture).alias("severity"),
        "domain",
        F.lit(None).cast("string").alias("location"),
        F.col("start_date").alias("detected_start_date"),
        F.col("end_date").alias("detected_end_date"),
        round_to(clip(confidence, 0.0, 99.0), 2).alias("confidence_score"),
        F.lit(DATA_CAUSE).alias("primary_cause"),
        F.col("expected_purchase_events").alias("affected_records"),
        F.col("missing_purchase_events").alias("missing_records"),
        F.lit("FAILED").alias("data_trust_status"),
        F.lit(None).cast("double").alias("anomaly_score"),
        round_to(coverage, 2).alias("event_coverage_pct"),
        capture.alias("revenue_capture_pct"),
        round_to(null_rate, 2).alias("null_value_pct"),
        F.lit(DATA_METRIC).alias("business_metric"),
        impact.alias("business_impact"),
        F.lit(DATA_ACTION).alias("recommended_action"),
        "evidence",
    )


def business_records(incidents: DataFrame, reports: DataFrame) -> DataFrame:
    """Registry rows of the business incidents.

    An incident without a finished report falls back to its anomaly score, the default cause, its own
    support count and its own evidence; missing metrics read "n/a".
    """
    facts = reports.select(
        "candidate_incident_id",
        F.col("confidence_score").alias("rca_confidence"),
        "primary_root_cause",
        F.col("baseline_metrics.delay_pct").alias("delay_before"),
        F.col("incident_metrics.delay_pct").alias("delay_after"),
        F.col("baseline_metrics.avg_load_pct").alias("load_before"),
        F.col("incident_metrics.avg_load_pct").alias("load_after"),
        F.col("incident_support.cases").alias("rca_cases"),
        F.col("data_trust.trusted").alias("trusted"),
        F.col("evidence").alias("rca_evidence"),
    )
    rows = incidents.join(facts, "candidate_incident_id", "left")
    confidence = F.coalesce("rca_confidence", "anomaly_score", F.lit(0.0))
    metrics = [number(c) for c in ("delay_before", "delay_after", "load_before", "load_after")]
    cases = F.coalesce("rca_cases", "affected_support_cases", F.lit(0).cast("bigint"))
    impact = F.format_string(BUSINESS_IMPACT, F.col("shipments"), *metrics, cases)
    missing = F.lit(None).cast("double")
    return rows.select(
        F.lit("BUSINESS_INCIDENT").alias("classification"),
        business_severity(confidence, F.col("shipments")).alias("severity"),
        F.lit("logistics").alias("domain"),
        place("city", "country").alias("location"),
        F.col("start_date").alias("detected_start_date"),
        F.col("end_date").alias("detected_end_date"),
        round_to(confidence, 2).alias("confidence_score"),
        F.coalesce("primary_root_cause", F.lit(BUSINESS_CAUSE)).alias("primary_cause"),
        F.col("shipments").cast("bigint").alias("affected_records"),
        F.lit(0).cast("bigint").alias("missing_records"),
        F.when(F.coalesce("trusted", F.lit(1)) == 1, "PASSED").otherwise("FAILED").alias("data_trust_status"),
        round_to("anomaly_score", 2).alias("anomaly_score"),
        missing.alias("event_coverage_pct"),
        missing.alias("revenue_capture_pct"),
        missing.alias("null_value_pct"),
        F.lit(BUSINESS_METRIC).alias("business_metric"),
        impact.alias("business_impact"),
        F.lit(BUSINESS_ACTION).alias("recommended_action"),
        F.coalesce(join_list("rca_evidence"), F.col("evidence")).alias("evidence"),
    )


def incident_registry(data: DataFrame, business: DataFrame, prefix: str = "INC-") -> DataFrame:
    """All incidents, numbered by start date, then class, location and end date."""
    rows = data.unionByName(business, allowMissingColumns=True)
    order = [F.col("classification"), F.col("location").asc_nulls_first(), F.col("detected_end_date")]
    order += [F.col("anomaly_score").desc_nulls_last()]
    numbered = number_all(rows, F.col("detected_start_date"), order, "_ordinal")
    return numbered.withColumns(
        {
            "incident_id": numbered_id(prefix, "_ordinal"),
            "duration_days": days_inclusive("detected_start_date", "detected_end_date"),
        }
    ).select(*REGISTRY_COLUMNS)


def registry_schema() -> T.StructType:
    """Types of the registry, for reading it back from CSV or JSON."""
    kinds = {
        "detected_start_date": T.DateType(),
        "detected_end_date": T.DateType(),
        "affected_records": T.LongType(),
        "missing_records": T.LongType(),
        "duration_days": T.IntegerType(),
    }
    doubles = {
        "confidence_score", "anomaly_score", "event_coverage_pct", "revenue_capture_pct", "null_value_pct",
    }
    return T.StructType(
        [
            T.StructField(c, T.DoubleType() if c in doubles else kinds.get(c, T.StringType()))
            for c in REGISTRY_COLUMNS
        ]
    )


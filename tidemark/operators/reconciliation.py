"""Daily agreement between trusted operational records and observed telemetry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_sum, flag, pct, round_to, safe_ratio
from tidemark.operators.quality import Control

# When a day counts as anomalous, and the wording of the verdicts.
MIN_EXPECTED = 20
MIN_COUNT_RATIO = 0.85
MAX_NULL_PCT = 20.0
MIN_REVENUE_RATIO = 0.70
EVIDENCE = "Operational orders remain present while purchase telemetry is missing and/or incomplete."
AGREES = "Purchase tracking agrees with operational orders."
DIFFERS = "Purchase tracking disagrees with operational order records."
FAILED_MESSAGE = "Purchase telemetry does not reconcile with trusted operational records"
PASSED_MESSAGE = "Purchase telemetry reconciles with operational records"
RULES_TEXT = "count ratio >= 0.85; null rate <= 20%; revenue ratio >= 0.70"


@dataclass(frozen=True)
class DayRules:
    min_expected: int = MIN_EXPECTED
    min_count_ratio: float = MIN_COUNT_RATIO
    max_null_pct: float = MAX_NULL_PCT
    min_revenue_ratio: float = MIN_REVENUE_RATIO


def daily_reconciliation(expected: DataFrame, observed: DataFrame, rules: DayRules = DayRules()) -> DataFrame:
    """Compare two (date, id, amount) feeds day by day.

    Days are those of the expected feed. Missing observed values count as 0, NULL amounts are
    skipped in the revenue and counted on their own.
    """
    wanted = expected.groupBy("date").agg(
        F.count("id").alias("expected_purchase_count"),
        F.coalesce(exact_sum("amount"), F.lit(0.0)).alias("expected_revenue_eur"),
    )
    seen = observed.groupBy("date").agg(
        F.count("id").alias("observed_purchase_count"),
        F.coalesce(exact_sum("amount"), F.lit(0.0)).alias("observed_revenue_eur"),
        F.count_if(F.col("amount").isNull()).alias("purchase_value_null_count"),
    )
    filled = ["observed_purchase_count", "observed_revenue_eur", "purchase_value_null_count"]
    days = wanted.join(seen, "date", "left").na.fill(0, filled)
    exp, obs = F.col("expected_purchase_count"), F.col("observed_purchase_count")
    exp_rev, obs_rev = F.col("expected_revenue_eur"), F.col("observed_revenue_eur")
    nulls = F.col("purchase_value_null_count")
    days = days.withColumns(
        {
            "purchase_count_ratio": safe_ratio(obs, exp),
            "missing_purchase_pct": F.greatest(safe_ratio(exp - obs, exp) * 100, F.lit(0.0)),
            "purchase_value_null_pct": F.when(obs > 0, safe_ratio(nulls, obs) * 100).otherwise(100.0),
            "revenue_ratio": F.when(exp_rev > 0, safe_ratio(obs_rev, exp_rev)).otherwise(1.0),
        }
    )
    suspicious = (
        (F.col("purchase_count_ratio") < rules.min_count_ratio)
        | (F.col("purchase_value_null_pct") > rules.max_null_pct)
        | (F.col("revenue_ratio") < rules.min_revenue_ratio)
    )
    return days.withColumn("incident_flag", flag((exp >= rules.min_expected) & suspicious))


def reconciliation_control(days: DataFrame) -> DataFrame:
    """The verdict over all days as one control row."""
    flagged = days.agg(F.count_if(F.col("incident_flag") == 1).alias("n"))
    spec = dict(
        control_id="APP_PURCHASE_RECONCILIATION",
        domain="app_events",
        check_type="Cross-System Reconciliation",
        severity="Critical",
        threshold=RULES_TEXT,
    )
    agrees = Control(**spec, details=AGREES)
    differs = Control(**spec, details=DIFFERS)
    text = F.concat(F.col("n").cast("string"), F.lit(" anomalous days"))
    verdict = F.when(F.col("n") == 0, agrees.column(F.col("n"), text)).otherwise(
        differs.column(F.col("n"), text)
    )
    return flagged.select(F.inline(F.array(verdict)))


def reconciliation_incident(days: DataFrame) -> DataFrame:
    """At most one incident: the span of all anomalous days with its totals."""
    total = days.where(F.col("incident_flag") == 1).agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.count(F.lit(1)).alias("anomalous_days"),
        F.sum("expected_purchase_count").alias("expected_purchase_events"),
        F.sum("observed_purchase_count").alias("observed_purchase_events"),
        F.sum("purchase_value_null_count").alias("null_purchase_values"),
        exact_sum("expected_revenue_eur").alias("expected_revenue_eur"),
        exact_sum("observed_revenue_eur").alias("observed_event_revenue_eur"),
    )
    exp, obs = F.col("expected_purchase_events"), F.col("observed_purchase_events")
    return total.where(F.col("anomalous_days") > 0).select(
        F.lit("DQ-CAND-001").alias("candidate_incident_id"),
        F.lit("DATA_INCIDENT_CANDIDATE").alias("classification"),
        F.lit("app_events").alias("domain"),
        F.lit("APP_PURCHASE_RECONCILIATION").alias("control"),
        "start_date",
        "end_date",
        "anomalous_days",
        exp,
        obs,
        (exp - obs).alias("missing_purchase_events"),
        round_to(safe_ratio(obs, exp) * 100, 2).alias("observed_vs_expected_pct"),
        "null_purchase_values",
        "expected_revenue_eur",
        "observed_event_revenue_eur",
        round_to(safe_ratio(F.col("observed_event_revenue_eur"), F.col("expected_revenue_eur")) * 100, 2).alias(
            "revenue_capture_pct"
        ),
        F.lit(EVIDENCE).alias("evidence"),
    )


def reliability_daily(days: DataFrame, start=None, end=None) -> DataFrame:
    """The reconciliation as a reporting mart with trust, status and message.

    The Critical status looks at the ratios alone, so a day under the minimum count can be Critical
    while its trust is PASSED.
    """
    if start is not None:
        days = days.where(F.col("date").between(start, end))
    bad = F.col("incident_flag") == 1
    critical = (F.col("purchase_count_ratio") < 0.60) | (F.col("revenue_ratio") < 0.40)
    return days.select(
        F.col("date").alias("report_date"),
        "expected_purchase_count",
        "observed_purchase_count",
        (F.col("expected_purchase_count") - F.col("observed_purchase_count")).alias("missing_purchase_events"),
        round_to(F.col("purchase_count_ratio") * 100, 2).alias("purchase_event_coverage_pct"),
        "purchase_value_null_count",
        round_to("purchase_value_null_pct", 2).alias("purchase_value_null_pct"),
        round_to("expected_revenue_eur", 2).alias("expected_revenue_eur"),
        round_to("observed_revenue_eur", 2).alias("observed_event_revenue_eur"),
        round_to(F.col("revenue_ratio") * 100, 2).alias("revenue_capture_pct"),
        round_to("missing_purchase_pct", 2).alias("missing_purchase_pct"),
        F.col("incident_flag").alias("data_incident_flag"),
        F.when(bad, "FAILED").otherwise("PASSED").alias("data_trust_status"),
        F.when(critical, "Critical").when(bad, "High").otherwise("Normal").alias("reliability_status"),
        F.when(bad, FAILED_MESSAGE).otherwise(PASSED_MESSAGE).alias("reliability_message"),
    )


def incident_totals(mart: DataFrame) -> DataFrame:
    """Window, counts, coverage and capture over the anomalous days of the reliability mart."""
    days = mart.where(F.col("data_incident_flag") == 1)
    return days.agg(
        F.min("report_date").alias("incident_start"),
        F.max("report_date").alias("incident_end"),
        F.sum("expected_purchase_count").alias("expected_purchases"),
        F.sum("observed_purchase_count").alias("observed_purchases"),
        F.sum("missing_purchase_events").alias("missing_purchases"),
        F.sum("purchase_value_null_count").alias("null_values"),
        pct(F.sum("observed_purchase_count"), F.sum("expected_purchase_count")).alias("event_coverage_pct"),
        pct(exact_sum("observed_event_revenue_eur"), exact_sum("expected_revenue_eur")).alias(
            "revenue_capture_pct"
        ),
    )

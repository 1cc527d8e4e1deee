"""Ranked root-cause hypotheses for every candidate incident at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import DISTANCE, HOURS, LOAD, clip, round_to, safe_ratio, units
from tidemark.functions.text import number
from tidemark.operators.anomaly import support_cells
from tidemark.operators.joins import interval_days
from tidemark.operators.touches import HUB, hub_touches

BASELINE_DAYS = 60
INCIDENT = "candidate_incident_id"
# Hypothesis names in the order that settles equal scores.
CAUSES = [
    ("congestion_score", "Network Congestion / Warehouse Overload"),
    ("carrier_score", "Carrier-Specific Performance"),
    ("route_score", "Route / Distance Mix"),
    ("seasonality_score", "Network Seasonality"),
]
# Evidence sentences.
LOAD_EVIDENCE = "Warehouse/network load increased by %s pp."
DELAY_EVIDENCE = "Delay rate changed by %s pp."
SPREAD_EVIDENCE = "%s%% of carriers present in the incident showed material delay deterioration."
TRUST_EVIDENCE = {
    True: "Logistics Data Quality controls passed.",
    False: "Logistics Data Quality controls did not pass.",
}
_RATES = {
    # metric: (sum, non-NULL count, decimals of the summed units, factor)
    "delay_pct": ("delayed", "delayed_n", 0, 100.0),
    "sla_pct": ("sla", "sla_n", 0, 100.0),
    "avg_load_pct": ("load", "load_n", LOAD, 100.0),
    "avg_transit_hours": ("transit", "transit_n", HOURS, 1.0),
    "avg_distance_km": ("distance", "distance_n", DISTANCE, 1.0),
    "cross_border_pct": ("cross", "cross_n", 0, 100.0),
}


def analysis_days(incidents: DataFrame, baseline_days: int = BASELINE_DAYS) -> DataFrame:
    """One row per incident, period and day: the incident window and the days just before it."""
    period = F.inline(
        F.array(
            F.struct(F.lit("incident").alias("period"), F.col("start_date").alias("s"), F.col("end_date").alias("e")),
            F.struct(
                F.lit("baseline").alias("period"),
                F.date_sub("start_date", baseline_days).alias("s"),
                F.date_sub("start_date", 1).alias("e"),
            ),
        )
    )
    spans = incidents.select(INCIDENT, HUB, "start_date", "end_date", period)
    return interval_days(spans, "s", "e", "report_date", [INCIDENT, HUB, "period"])


def carrier_periods(shipments: DataFrame, days: DataFrame) -> DataFrame:
    """Additive facts per incident, period and carrier.

    Only touches on incident hub-days are grouped; the days are few, so that filter needs no shuffle of the history.
    A shipment whose two hubs are the same counts once.
    """
    columns = [
        "carrier_id",
        "carrier_name",
        F.col("shipment_date").alias("report_date"),
        "delayed_flag",
        "sla_met",
        units("network_load_factor", LOAD).alias("load_u"),
        units("actual_transit_hours", HOURS).alias("transit_u"),
        units("distance_km", DISTANCE).alias("distance_u"),
        "cross_border",
    ]
    sources = {
        "delayed": "delayed_flag",
        "sla": "sla_met",
        "load": "load_u",
        "transit": "transit_u",
        "distance": "distance_u",
        "cross": "cross_border",
    }
    cells = (
        hub_touches(shipments, columns, once=True)
        .join(days.select(HUB, "report_date").distinct(), [HUB, "report_date"], "left_semi")
        .groupBy(HUB, "report_date", "carrier_id", "carrier_name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(c).alias(name) for name, c in sources.items()],
            *[F.count(c).alias(f"{name}_n") for name, c in sources.items()],
        )
    )
    added = ["n", *sources, *[f"{name}_n" for name in sources]]
    return (
        days.join(cells, [HUB, "report_date"], "left")
        .groupBy(INCIDENT, "period", "carrier_id", "carrier_name")
        .agg(*[F.sum(c).alias(c) for c in added])
    )


def carrier_shares(shipments: DataFrame, days: DataFrame, shares: int) -> list[DataFrame]:
    """The facts in shares by the day: a frame each, to be made one after the other and put together by ``joined_periods``.

    Where the days are too many for a broadcast, touches are dealt out by hub and day to meet them.
    """
    if shares == 1:
        return [carrier_periods(shipments, days)]

    def share(df: DataFrame, day: str, number: int) -> DataFrame:
        return df.where(F.pmod(F.xxhash64(day), F.lit(shares)) == number)

    return [carrier_periods(share(shipments, "shipment_date", i), share(days, "report_date", i)) for i in range(shares)]


def joined_periods(shares: DataFrame) -> DataFrame:
    """Facts of all shares together; a day is in one share only, so their sums add up."""
    keys = [INCIDENT, "period", "carrier_id", "carrier_name"]
    return shares.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in shares.columns if c not in keys])


def _metrics(prefix: str) -> list[Column]:
    def part(name: str) -> Column:
        return F.sum(F.when(F.col("period") == prefix, F.col(name)))

    rates = [
        (safe_ratio(part(total), part(count)) / F.lit(float(10**places)) * F.lit(factor)).alias(f"{prefix}_{metric}")
        for metric, (total, count, places, factor) in _RATES.items()
    ]
    carriers = F.count_distinct(F.when((F.col("period") == prefix), F.col("carrier_id")))
    return [
        F.coalesce(part("n"), F.lit(0)).alias(f"{prefix}_shipments"),
        *rates,
        carriers.alias(f"{prefix}_carriers"),
    ]


def period_metrics(facts: DataFrame) -> DataFrame:
    """Shipments, rates and carrier count of both periods, one row per incident."""
    return facts.groupBy(INCIDENT).agg(*_metrics("baseline"), *_metrics("incident"))


def carrier_contribution(facts: DataFrame) -> DataFrame:
    """Each carrier of the incident window against its own baseline.

    A carrier without baseline shipments is held against the mean of all baseline shipments.
    """

    def part(period: str, name: str) -> Column:
        return F.sum(F.when(F.col("period") == period, F.col(name)))

    carriers = (
        facts.where(F.col("carrier_id").isNotNull() & F.col("carrier_name").isNotNull())
        .groupBy(INCIDENT, "carrier_id", "carrier_name")
        .agg(
            part("baseline", "n").alias("baseline_shipments"),
            (safe_ratio(part("baseline", "delayed"), part("baseline", "delayed_n")) * 100).alias("own_baseline"),
            part("incident", "n").alias("incident_shipments"),
            (safe_ratio(part("incident", "delayed"), part("incident", "delayed_n")) * 100).alias(
                "incident_delay_pct"
            ),
        )
        .where(F.col("incident_shipments") > 0)
    )
    overall = facts.groupBy(INCIDENT).agg(
        (safe_ratio(part("baseline", "delayed"), part("baseline", "delayed_n")) * 100).alias("overall")
    )
    totals = carriers.groupBy(INCIDENT).agg(F.sum("incident_shipments").alias("total"))
    rows = carriers.join(overall, INCIDENT).join(totals, INCIDENT)
    baseline = F.coalesce("own_baseline", "overall")
    return rows.select(
        INCIDENT,
        "carrier_id",
        "carrier_name",
        "incident_shipments",
        "incident_delay_pct",
        "baseline_shipments",
        baseline.alias("baseline_delay_pct"),
        (F.col("incident_delay_pct") - baseline).alias("delay_delta_pp"),
        (safe_ratio(F.col("incident_shipments"), F.col("total")) * 100).alias("incident_share_pct"),
    )


def carrier_spread(contribution: DataFrame, material_pp: float = 25.0) -> DataFrame:
    """How widely the delay is spread over carriers, and how concentrated it is."""
    material = F.count_if(F.col("delay_delta_pp") >= material_pp)
    return contribution.groupBy(INCIDENT).agg(
        safe_ratio(material, F.count(F.lit(1))).alias("spread_ratio"),
        F.max("incident_share_pct").alias("max_share"),
        F.max("delay_delta_pp").alias("max_delta"),
    )


def support_periods(
    shipments: DataFrame, cases: DataFrame, days: DataFrame, cells: DataFrame | None = None
) -> DataFrame:
    """Support cases, SLA, CSAT and escalation of both periods, one row per incident. ``cells`` has the cases per hub and
    day where they are stored."""
    cells = support_cells(shipments, cases) if cells is None else cells
    facts = days.join(cells, [HUB, "report_date"])

    def columns(prefix: str) -> list[Column]:
        def part(name: str) -> Column:
            return F.sum(F.when(F.col("period") == prefix, F.col(name)))

        return [
            F.coalesce(part("cases"), F.lit(0)).alias(f"{prefix}_cases"),
            round_to(safe_ratio(part("sla"), part("sla_n")) * 100, 2).alias(f"{prefix}_support_sla_pct"),
            round_to(safe_ratio(part("csat"), part("csat_n")), 2).alias(f"{prefix}_avg_csat"),
            round_to(safe_ratio(part("escalated"), part("escalated_n")) * 100, 2).alias(f"{prefix}_escalation_pct"),
        ]

    return facts.groupBy(INCIDENT).agg(*columns("baseline"), *columns("incident"))


def network_seasonality(shipments: DataFrame, days: DataFrame) -> DataFrame:
    """Change of the delay rate over all hubs between the two periods; 0 where one is empty."""
    network = shipments.groupBy(F.col("shipment_date").alias("report_date")).agg(
        F.sum("delayed_flag").alias("delayed"), F.count("delayed_flag").alias("n")
    )
    facts = days.select(INCIDENT, "period", "report_date").join(network, "report_date", "left")

    def rate(period: str) -> Column:
        here = F.col("period") == period
        return safe_ratio(F.sum(F.when(here, F.col("delayed"))), F.sum(F.when(here, F.col("n"))))

    change = (rate("incident") - rate("baseline")) * 100
    return facts.groupBy(INCIDENT).agg(F.coalesce(change, F.lit(0.0)).alias("network_delta"))


def cause_scores(
    metrics: DataFrame, spread: DataFrame, seasonality: DataFrame, trust: DataFrame
) -> DataFrame:
    """Four hypothesis scores with their deltas, one wide row per incident.

    Incidents without shipments in one of the periods get status ``INSUFFICIENT_DATA`` and no scores.
    """
    rows = metrics.join(spread, INCIDENT, "left").join(seasonality, INCIDENT, "left")
    # The trust verdict is one row, read as scalar subqueries instead of a join without a key.
    rows = rows.withColumns({c: trust.select(c).scalar() for c in ("checks", "failures", "trusted")})
    enough = (F.col("baseline_shipments") > 0) & (F.col("incident_shipments") > 0)

    def delta(metric: str) -> Column:
        return F.col(f"incident_{metric}") - F.col(f"baseline_{metric}")

    def score(value: Column) -> Column:
        return clip(value, 0.0, 100.0)

    load = score(delta("avg_load_pct") / 30 * 100)
    delay = score(delta("delay_pct") / 50 * 100)
    systemic = score(F.col("spread_ratio") * 100)
    quality = F.when(F.col("trusted") == 1, 100.0).otherwise(0.0)
    concentration = score((F.col("max_share") - 25) / 50 * 100)
    worst = score(F.col("max_delta") / 70 * 100)
    distance = score(F.abs(delta("avg_distance_km")) / 500 * 100)
    cross = score(F.abs(delta("cross_border_pct")) / 25 * 100)
    values = {
        "congestion_score": load * 0.45 + systemic * 0.25 + delay * 0.20 + quality * 0.10,
        "carrier_score": concentration * 0.45 + worst * 0.30 + (100 - systemic) * 0.25,
        "route_score": distance * 0.65 + cross * 0.35,
        "seasonality_score": score(F.col("network_delta") / 15 * 100),
    }
    return rows.select(
        INCIDENT,
        F.when(enough, "ANALYZED").otherwise("INSUFFICIENT_DATA").alias("rca_status"),
        *[F.when(enough, round_to(v, 2)).alias(name) for name, v in values.items()],
        round_to(delta("avg_load_pct"), 2).alias("load_delta_pp"),
        round_to(delta("delay_pct"), 2).alias("delay_delta_pp"),
        round_to(delta("avg_distance_km"), 1).alias("distance_delta_km"),
        round_to(delta("cross_border_pct"), 2).alias("cross_border_delta_pp"),
        round_to("network_delta", 2).alias("network_delay_delta_pp"),
        round_to(F.col("spread_ratio") * 100, 2).alias("carrier_spread_pct"),
        round_to(F.col("spread_ratio") * 100, 1).alias("spread_pct_short"),
        "checks",
        "failures",
        "trusted",
    )


def cause_rows(scores: DataFrame) -> DataFrame:
    """The scores in long form: incident, cause, score."""
    items = [F.struct(F.lit(label).alias("cause"), F.col(name).alias("score")) for name, label in CAUSES]
    return scores.select(INCIDENT, F.inline(F.array(*items)))


def cause_verdict(scores: DataFrame) -> DataFrame:
    """Primary cause and confidence next to the scores; the earlier cause wins equal scores."""
    ranked = F.array(*[F.col(name) for name, _ in CAUSES])
    best = F.greatest(*[F.col(name) for name, _ in CAUSES])
    primary = reduce(
        lambda rest, item: F.when(F.col(item[0]) == best, item[1]).otherwise(rest),
        reversed(CAUSES),
        F.lit(None).cast("string"),
    )
    ordered = F.sort_array(ranked, asc=False)
    margin = ordered[0] - ordered[1]
    quality = F.when(F.col("trusted") == 1, 100.0).otherwise(0.0)
    confidence = ordered[0] * 0.65 + quality * 0.20 + F.least(margin * 2, F.lit(100.0)) * 0.15
    analyzed = F.col("rca_status") == "ANALYZED"
    return scores.withColumns(
        {
            "primary_root_cause": primary,
            "margin": F.when(analyzed, margin),
            "confidence_score": F.when(analyzed, round_to(clip(confidence, 0.0, 99.0), 2)),
        }
    )


def cause_evidence() -> Column:
    """The four evidence sentences of a report, from the verdict columns."""
    return F.array(
        F.format_string(LOAD_EVIDENCE, number("load_delta_pp", 2, signed=True)),
        F.format_string(DELAY_EVIDENCE, number("delay_delta_pp", 2, signed=True)),
        F.format_string(SPREAD_EVIDENCE, number("spread_pct_short", 1)),
        F.when(F.col("trusted") == 1, TRUST_EVIDENCE[True]).otherwise(TRUST_EVIDENCE[False]),
    )


def cause_reports(
    incidents: DataFrame, verdict: DataFrame, metrics: DataFrame, support: DataFrame
) -> DataFrame:
    """One nested report per incident: windows, metrics of both periods, scores, support, evidence."""
    rates = ["shipments", *_RATES, "carriers"]
    support_fields = ["cases", "support_sla_pct", "avg_csat", "escalation_pct"]

    def nested(prefix: str, names: list[str]) -> Column:
        return F.struct(*[F.col(f"{prefix}_{n}").alias(n) for n in names])

    base = incidents.select(
        INCIDENT,
        HUB,
        F.concat_ws(", ", "city", "country").alias("location"),
        "start_date",
        "end_date",
    )
    rows = base.join(verdict, INCIDENT).join(metrics, INCIDENT).join(support, INCIDENT, "left")
    rows = rows.na.fill(0, ["baseline_cases", "incident_cases"])
    labels = F.array(*[F.lit(label) for _, label in CAUSES])
    return rows.select(
        INCIDENT,
        F.lit("BUSINESS_INCIDENT").alias("classification"),
        "location",
        HUB,
        F.struct(F.col("start_date").alias("start"), F.col("end_date").alias("end")).alias("detected_window"),
        F.struct(
            F.date_sub("start_date", BASELINE_DAYS).alias("start"), F.date_sub("start_date", 1).alias("end")
        ).alias("baseline_window"),
        "rca_status",
        "primary_root_cause",
        "confidence_score",
        F.struct("checks", "failures", "trusted").alias("data_trust"),
        nested("baseline", rates).alias("baseline_metrics"),
        nested("incident", rates).alias("incident_metrics"),
        F.struct(
            "load_delta_pp",
            "delay_delta_pp",
            "distance_delta_km",
            "cross_border_delta_pp",
            "network_delay_delta_pp",
        ).alias("metric_deltas"),
        F.map_from_arrays(labels, F.array(*[F.col(name) for name, _ in CAUSES])).alias("root_cause_scores"),
        "carrier_spread_pct",
        nested("baseline", support_fields).alias("baseline_support"),
        nested("incident", support_fields).alias("incident_support"),
        F.when(F.col("rca_status") == "ANALYZED", cause_evidence()).alias("evidence"),
    )

"""Trailing-window KPI anomalies per hub."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import fill_gap_days
from tidemark.functions.numeric import HOURS, LOAD, clip, exact_avg, round_to, safe_ratio, units
from tidemark.operators.ranking import number_all, numbered_id
from tidemark.operators.touches import HUB, hub_touches, incident_days

# The evidence by the verdict on the logistics data.
EVIDENCE = (
    "Delivery deterioration coincides with abnormal warehouse/network load "
    "while logistics data contracts remain valid."
)
DOUBTFUL_EVIDENCE = (
    "Delivery deterioration coincides with abnormal warehouse/network load; "
    "logistics data contracts are violated, so the figures need confirmation."
)


@dataclass(frozen=True)
class WindowRules:
    """Window length, gate thresholds (percentage points, touches, score) of a candidate.

    The baseline of a window is the hub's whole history, or with ``exclude_window`` all of it but the window.
    """

    days: int = 14
    min_touches: int = 20
    min_delay_pp: float = 18.0
    min_load_pp: float = 20.0
    min_score: float = 75.0
    exclude_window: bool = False


def touch_rows(shipments: DataFrame) -> DataFrame:
    columns = ["shipment_id", F.col("shipment_date").alias("date"), "delayed_flag", "sla_met"]
    return hub_touches(shipments, [*columns, "network_load_factor", "actual_transit_hours"])


def hub_baselines(shipments: DataFrame) -> DataFrame:
    """Whole-history touch count and mean rates per hub (incident days included)."""
    return (
        touch_rows(shipments)
        .groupBy(HUB)
        .agg(
            F.count("shipment_id").alias("baseline_shipments"),
            F.avg("delayed_flag").alias("baseline_delay_rate"),
            F.avg("sla_met").alias("baseline_sla_rate"),
            exact_avg("network_load_factor", LOAD).alias("baseline_load"),
            exact_avg("actual_transit_hours", HOURS).alias("baseline_transit_hours"),
        )
    )


def _hub_day_sums(shipments: DataFrame) -> DataFrame:
    """Additive hub-day facts; load and hours as scaled integers with their non-NULL counts."""
    return (
        touch_rows(shipments)
        .groupBy(HUB, "date")
        .agg(
            F.count("shipment_id").alias("n"),
            F.coalesce(F.sum("delayed_flag"), F.lit(0)).alias("delayed"),
            F.count("delayed_flag").alias("delayed_n"),
            F.coalesce(F.sum("sla_met"), F.lit(0)).alias("sla"),
            F.count("sla_met").alias("sla_n"),
            F.sum(units("network_load_factor", LOAD)).alias("load"),
            F.count("network_load_factor").alias("load_n"),
            F.sum(units("actual_transit_hours", HOURS)).alias("transit"),
            F.count("actual_transit_hours").alias("transit_n"),
        )
    )


def _mean(total: str, count: str, places: int) -> Column:
    return F.col(total) / F.lit(float(10**places)) / F.nullif(F.col(count), F.lit(0))


def hub_daily(shipments: DataFrame) -> DataFrame:
    """Touches, delayed and on-time counts, mean load and mean transit hours per hub and day."""
    return _hub_day_sums(shipments).select(
        HUB,
        "date",
        F.col("n").alias("shipments"),
        F.col("delayed").alias("delayed_shipments"),
        F.col("sla").alias("sla_met_shipments"),
        _mean("load", "load_n", LOAD).alias("avg_load"),
        _mean("transit", "transit_n", HOURS).alias("avg_transit_hours"),
    )


def hub_windows(shipments: DataFrame, rules: WindowRules = WindowRules()) -> DataFrame:
    """Trailing windows over a gap-free calendar per hub, next to the hub's whole-history baseline.

    A fact scan is reduced to hub-days first. Gap filling, trailing sums and baselines then share one
    shuffle by hub, whose rows are bounded by hubs x calendar days.
    """
    # A day's mean stands for all its touches, so days with NULL loads are weighted by all touches.
    days = _hub_day_sums(shipments)
    weighted = {
        f"{m}_w": F.coalesce(F.rint(F.col(m) * F.col("n") / F.nullif(F.col(f"{m}_n"), F.lit(0))), F.lit(0.0)).cast(
            "bigint"
        )
        for m in ("load", "transit")
    }
    days = days.withColumns(weighted).na.fill(0, ["load", "transit"])
    sums = ["n", "delayed", "sla", "load_w", "transit_w"]
    base = ["n", "delayed", "sla", "delayed_n", "sla_n", "load", "load_n", "transit", "transit_n"]
    # The baseline counts undated touches as well; only dated ones fall into windows.
    whole = Window.partitionBy(HUB)
    totals = [F.sum(c).over(whole).alias(f"all_{c}") for c in base]
    own = [c for c in base if c not in sums]
    dated = days.select(HUB, "date", *sums, *own, *totals).where(F.col("date").isNotNull())
    dense = fill_gap_days(dated, [HUB], "date", sums + own)
    trailing = Window.partitionBy(HUB).orderBy("date").rowsBetween(1 - rules.days, 0)
    rest = lambda c: F.col(f"all_{c}") - (F.sum(c).over(trailing) if rules.exclude_window else F.lit(0))
    rolled = dense.select(
        HUB,
        F.col("date").alias("window_end"),
        *[F.sum(c).over(trailing).alias(c) for c in sums],
        *[rest(c).alias(f"all_{c}") for c in base],
    ).where(F.col("n") >= rules.min_touches)
    windows = rolled.select(
        HUB,
        F.date_sub("window_end", rules.days - 1).alias("window_start"),
        "window_end",
        F.col("n").alias("window_shipments"),
        (F.col("delayed") / F.col("n")).alias("window_delay_rate"),
        (F.col("sla") / F.col("n")).alias("window_sla_rate"),
        _mean("load_w", "n", LOAD).alias("window_avg_load"),
        _mean("transit_w", "n", HOURS).alias("window_avg_transit_hours"),
        F.col("all_n").alias("baseline_shipments"),
        safe_ratio(F.col("all_delayed"), F.col("all_delayed_n")).alias("baseline_delay_rate"),
        safe_ratio(F.col("all_sla"), F.col("all_sla_n")).alias("baseline_sla_rate"),
        _mean("all_load", "all_load_n", LOAD).alias("baseline_load"),
        _mean("all_transit", "all_transit_n", HOURS).alias("baseline_transit_hours"),
    )
    deltas = {
        "delay_delta_pp": (F.col("window_delay_rate") - F.col("baseline_delay_rate")) * 100,
        "sla_delta_pp": (F.col("window_sla_rate") - F.col("baseline_sla_rate")) * 100,
        "load_delta_pp": (F.col("window_avg_load") - F.col("baseline_load")) * 100,
        "transit_delta_hours": F.col("window_avg_transit_hours") - F.col("baseline_transit_hours"),
    }
    return windows.withColumns(deltas)


def anomaly_score() -> Column:
    """0-100 score of a window: delay 35 %, load 30 %, SLA loss 25 %, transit 10 %."""
    delay = clip(F.col("delay_delta_pp") / 40.0, 0.0, 1.0)
    load = clip(F.col("load_delta_pp") / 30.0, 0.0, 1.0)
    sla = clip(-F.col("sla_delta_pp") / 40.0, 0.0, 1.0)
    transit = clip(F.col("transit_delta_hours") / 20.0, 0.0, 1.0)
    return round_to((delay * 0.35 + load * 0.30 + sla * 0.25 + transit * 0.10) * 100, 2)


def scored_windows(shipments: DataFrame, rules: WindowRules = WindowRules()) -> DataFrame:
    return hub_windows(shipments, rules).withColumn("anomaly_score", anomaly_score())


def window_candidates(windows: DataFrame, rules: WindowRules = WindowRules()) -> DataFrame:
    """Scored windows that pass every threshold."""
    return windows.where(
        (F.col("delay_delta_pp") >= rules.min_delay_pp)
        & (F.col("load_delta_pp") >= rules.min_load_pp)
        & (F.col("window_shipments") >= rules.min_touches)
        & (F.col("anomaly_score") >= rules.min_score)
    )


def drop_overlaps(candidates: DataFrame) -> DataFrame:
    """Keep the best window of each hub, then every further one that overlaps no kept window.

    Order: score, delay delta, then the earlier end. Windows that share a day overlap. A hub holds at
    most one window per calendar day, which bounds the array that one task walks.
    """
    rest = [c for c in candidates.columns if c != HUB]
    key = [(-F.col("anomaly_score")).alias("_score"), (-F.col("delay_delta_pp")).alias("_delay")]
    item = F.struct(*key, F.col("window_end").alias("_end"), F.struct(*rest).alias("w"))
    ranked = candidates.groupBy(HUB).agg(F.sort_array(F.collect_list(item)).alias("ranked"))
    kept_type = f"array<{ranked.schema['ranked'].dataType.elementType.simpleString()}>"

    def overlaps(kept: Column, item: Column) -> Column:
        return F.exists(
            kept,
            lambda k: (item["w"]["window_end"] >= k["w"]["window_start"])
            & (item["w"]["window_start"] <= k["w"]["window_end"]),
        )

    kept = F.aggregate(
        "ranked",
        F.array().cast(kept_type),
        lambda acc, item: F.when(overlaps(acc, item), acc).otherwise(F.concat(acc, F.array(item))),
    )
    picked = ranked.select(HUB, F.explode(kept).alias("_item"))
    return picked.select(HUB, "_item.w.*").select(*candidates.columns)


def candidate_ids(candidates: DataFrame) -> DataFrame:
    """Number the kept windows by falling score, then falling delay delta, hub and end."""
    order = [F.col("delay_delta_pp").desc(), F.col(HUB), F.col("window_end")]
    # Scores have two decimals between 0 and 100, so there are at most 10,001 buckets.
    numbered = number_all(candidates, -F.col("anomaly_score"), order, "ordinal")
    named = numbered_id("BIZ-CAND-", "ordinal").alias("candidate_incident_id")
    return numbered.select(named, *candidates.columns)


def support_impact(
    candidates: DataFrame, shipments: DataFrame, cases: DataFrame, cells: DataFrame | None = None
) -> DataFrame:
    """Support cases of the shipments that touch a candidate's hub in its window.

    Cases are reduced to hub-days before they meet the days of the windows; ``cells`` has them where they are stored.
    """
    spans = candidates.withColumns({"start_date": F.col("window_start"), "end_date": F.col("window_end")})
    days = incident_days(spans, ["candidate_incident_id", HUB])
    cells = support_cells(shipments, cases) if cells is None else cells
    return days.join(cells, [HUB, "report_date"]).groupBy("candidate_incident_id").agg(
        F.sum("cases").alias("affected_support_cases"),
        safe_ratio(F.sum("sla"), F.sum("sla_n")).alias("support_sla_rate"),
        safe_ratio(F.sum("csat"), F.sum("csat_n")).alias("avg_csat"),
    )


def cases_per_shipment(cases: DataFrame) -> DataFrame:
    return cases.groupBy("shipment_id").agg(
        F.count(F.lit(1)).alias("cases"),
        F.sum("support_sla_met").alias("sla"),
        F.count("support_sla_met").alias("sla_n"),
        F.sum("csat_score").alias("csat"),
        F.count("csat_score").alias("csat_n"),
        F.sum("escalated_flag").alias("escalated"),
        F.count("escalated_flag").alias("escalated_n"),
    )


def support_cells(shipments: DataFrame, cases: DataFrame) -> DataFrame:
    """Case sums per hub and day of the shipments that touch the hub; each shipment counts once per hub and day."""
    places = ["shipment_id", "origin_warehouse_id", "destination_warehouse_id", "shipment_date"]
    counted = cases_per_shipment(cases)
    sums = [c for c in counted.columns if c != "shipment_id"]
    rows = shipments.select(*places).join(counted, "shipment_id").dropDuplicates(places)
    touches = hub_touches(rows, [F.col("shipment_date").alias("report_date"), *sums], once=True)
    return touches.groupBy(HUB, "report_date").agg(*[F.sum(c).alias(c) for c in sums])


def support_shares(shipments: DataFrame, cases: DataFrame, shares: int) -> list[DataFrame]:
    """The cells in shares by the shipment: a frame each, to be made one after the other and put together by ``joined_cells``."""
    if shares == 1:
        return [support_cells(shipments, cases)]

    def share(df: DataFrame, number: int) -> DataFrame:
        return df.where(F.pmod(F.xxhash64("shipment_id"), F.lit(shares)) == number)

    return [support_cells(share(shipments, i), share(cases, i)) for i in range(shares)]


def joined_cells(shares: DataFrame) -> DataFrame:
    """Cells of all shares together; a shipment is in one share only, so their sums add up."""
    return shares.groupBy(HUB, "report_date").agg(*[F.sum(c).alias(c) for c in shares.columns if c not in (HUB, "report_date")])


def incident_records(
    candidates: DataFrame, hubs: DataFrame, shipments: DataFrame, cases: DataFrame, trust: DataFrame, cells: DataFrame | None = None
) -> DataFrame:
    """Candidate incidents with place, rounded metrics, support impact and evidence by the one-row trust verdict."""
    trusted = trust.select("trusted").scalar() == 1
    places = hubs.select(HUB, "city", "country").dropDuplicates([HUB])
    impact = support_impact(candidates, shipments, cases, cells)
    rows = candidates.join(places, HUB, "left").join(impact, "candidate_incident_id", "left")
    percent = {
        "baseline_delay_pct": "baseline_delay_rate",
        "incident_delay_pct": "window_delay_rate",
        "baseline_load_pct": "baseline_load",
        "incident_load_pct": "window_avg_load",
        "support_sla_pct": "support_sla_rate",
    }
    plain = {
        "delay_increase_pp": "delay_delta_pp",
        "load_increase_pp": "load_delta_pp",
        "sla_change_pp": "sla_delta_pp",
        "transit_increase_hours": "transit_delta_hours",
        "average_csat": "avg_csat",
    }
    return rows.select(
        "candidate_incident_id",
        F.lit("BUSINESS_INCIDENT_CANDIDATE").alias("classification"),
        F.lit("logistics").alias("domain"),
        HUB,
        "city",
        "country",
        F.col("window_start").alias("start_date"),
        F.col("window_end").alias("end_date"),
        F.col("window_shipments").alias("shipments"),
        *[round_to(F.col(source) * 100, 2).alias(name) for name, source in percent.items()],
        *[round_to(source, 2).alias(name) for name, source in plain.items()],
        F.coalesce("affected_support_cases", F.lit(0)).alias("affected_support_cases"),
        "anomaly_score",
        F.when(trusted, EVIDENCE).otherwise(DOUBTFUL_EVIDENCE).alias("evidence"),
    )


def anomaly_summary(windows: DataFrame, incidents: DataFrame, trust: DataFrame) -> DataFrame:
    """Windows evaluated, candidates kept and the logistics trust counts, in one row."""

    def counts(df: DataFrame, **kept: Column) -> DataFrame:
        names = ["windows", "candidates", "checks", "failures"]
        return df.select(*[kept.get(n, F.lit(None)).cast("bigint").alias(n) for n in names])

    rows = counts(windows.agg(F.count(F.lit(1)).alias("c")), windows=F.col("c"))
    rows = rows.unionByName(counts(incidents.agg(F.count(F.lit(1)).alias("c")), candidates=F.col("c")))
    rows = rows.unionByName(counts(trust, checks=F.col("checks"), failures=F.col("failures")))
    return rows.agg(
        F.sum("windows").alias("windows_evaluated"),
        F.sum("candidates").alias("business_incident_candidates"),
        F.sum("checks").alias("logistics_controls_checked"),
        F.sum("failures").alias("logistics_failures"),
        (F.sum("failures") == 0).cast("int").alias("logistics_data_passed"),
    )

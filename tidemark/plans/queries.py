"""Every registered query over the star-schema tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import distinct_sets
from tidemark.functions.measures import measures
from tidemark.functions.numeric import exact_avg, exact_sum, round_to
from tidemark.functions.text import join_list
from tidemark.operators import anomaly, briefs, contracts, derive, grounding, intervals, joins, profile, quality
from tidemark.operators import reconciliation as recon
from tidemark.operators import registry as reg
from tidemark.operators import rootcause
from tidemark.operators.ranking import rank_in_buckets
from tidemark.operators.touches import HUB, hub_touches, incident_days, incident_shipments
from tidemark.plans import gold, staging
from tidemark.plans.bindings import RULES, SCHEMAS, Tables, hub_id
from tidemark.session import materialize, snapshot
from tidemark.sources import layers, ordered, readers, schemas, writers
from tidemark.sources import run_log as run_log_file

Query = Callable[[Tables], DataFrame]
CATALOG: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under the name of its function."""
    CATALOG[build.__name__] = build
    return build


_TABLES: dict[tuple[str, str], Tables] = {}
# The caller's texts around the evidence; they name what the checks look for.
INSTRUCTIONS = "Report on one incident from its evidence. Id, class, cause, dates, data trust and confidence will be checked."
REQUEST = "Evidence of the incident as JSON:"
CORRECTION = "These checks failed for the report below; its evidence follows it."


def tables_for(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder, one object per session and state of its files, so stored layers are built once."""
    folder = folder.rstrip("/")
    label = snapshot(spark, folder, sorted(SCHEMAS))
    key = (spark.sparkContext.applicationId, f"{folder}@{label}")
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, folder, label)
    return _TABLES[key]


_UNTRUSTED: dict[tuple[str, str], Tables] = {}


def _untrusted(t: Tables) -> Tables:
    """The same tables as if the logistics controls had failed."""
    key = (t.spark.sparkContext.applicationId, f"{t.folder}@{t.label}")
    if key not in _UNTRUSTED:
        _UNTRUSTED[key] = t.judged(False)
    return _UNTRUSTED[key]


def release(spark: SparkSession) -> None:
    """Delete all stored layers of the session and forget them."""
    own = spark.sparkContext.applicationId
    for held in (_UNTRUSTED, _TABLES):
        for key in [k for k in held if k[0] == own]:
            held.pop(key).release()


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """The frame of a query. Building it writes the stored layers that it reads, where that has not happened yet."""
    return CATALOG[name](tables_for(spark, folder))


# --- staging and enriched models -------------------------------------------------------------------


@query
def stg_customers(t: Tables) -> DataFrame:
    return staging.stage("customers", t.customers)


@query
def stg_orders(t: Tables) -> DataFrame:
    return staging.stage("orders", t.orders)


@query
def stg_payments(t: Tables) -> DataFrame:
    return staging.stage("payments", t.payments)


@query
def stg_shipments(t: Tables) -> DataFrame:
    return staging.stage("shipments", t.shipments)


@query
def stg_support_cases(t: Tables) -> DataFrame:
    return staging.stage("support_cases", t.cases)


@query
def stg_app_events(t: Tables) -> DataFrame:
    return staging.stage("app_events", t.app_events)


@query
def app_funnel_daily(t: Tables) -> DataFrame:
    return t.funnel


@query
def orders_enriched(t: Tables) -> DataFrame:
    return t.orders_enriched


@query
def shipments_enriched(t: Tables) -> DataFrame:
    return t.shipments_enriched


@query
def support_enriched(t: Tables) -> DataFrame:
    return t.support_enriched


# --- marts -----------------------------------------------------------------------------------------


@query
def commerce_daily(t: Tables) -> DataFrame:
    return gold.commerce_daily(staging.stage("orders", t.orders))


@query
def logistics_daily(t: Tables) -> DataFrame:
    return gold.logistics_daily(staging.stage("shipments", t.stored_shipments))


@query
def support_daily(t: Tables) -> DataFrame:
    return gold.support_daily(staging.stage("support_cases", t.cases))


@query
def commerce_performance(t: Tables) -> DataFrame:
    return gold.commerce_performance(t.stored_orders, "item_gmv_eur", "item_discount_eur")


@query
def payment_kpis(t: Tables) -> DataFrame:
    return gold.payment_kpis(commerce_performance(t))


@query
def executive_daily(t: Tables) -> DataFrame:
    cases = staging.stage("support_cases", t.cases)
    return gold.executive_daily(
        t.stored_orders, t.stored_shipments, cases, t.funnel, t.reconciliation, t.bounds
    )


@query
def dim_date(t: Tables) -> DataFrame:
    data = joins.interval_days(t.data_incidents, "start_date", "end_date", "report_date", [])
    periods = {"data_incident_period_flag": data, "business_incident_period_flag": incident_days(t.incidents)}
    return gold.date_dimension(t.bounds, periods)


@query
def logistics_performance(t: Tables) -> DataFrame:
    return gold.logistics_performance(t.stored_enriched, t.hubs, t.incidents)


@query
def incident_hub_snapshot(t: Tables) -> DataFrame:
    return gold.incident_hub_snapshot(logistics_performance(t))


def _customer_experience(t: Tables, *period: str) -> DataFrame:
    cases = t.cases.join(t.carriers.select("carrier_id", "carrier_name"), "carrier_id", "left")
    cases = cases.withColumn("case_date", F.to_date("created_ts"))
    return gold.customer_experience(cases, t.stored_shipments, t.incidents, *period)


@query
def customer_experience(t: Tables) -> DataFrame:
    return _customer_experience(t)


@query
def customers_contacting(t: Tables) -> DataFrame:
    """Exact distinct customers per priority, next to the sum over the mart's groups, which counts some twice."""
    mart = customer_experience(t).groupBy("priority").agg(F.sum("customers_contacting").alias("customers_in_groups"))
    exact = t.cases.groupBy("priority").agg(F.count_distinct("customer_id").alias("customers"))
    return exact.join(mart, "priority")


@query
def incident_vs_normal(t: Tables) -> DataFrame:
    cases = t.cases.withColumn("case_date", F.to_date("created_ts"))
    return gold.incident_vs_normal(cases, t.stored_shipments, t.incidents)


# --- marts of one year -----------------------------------------------------------------------------

YEAR = ("1997-01-01", "1997-12-31")


@query
def commerce_performance_1997(t: Tables) -> DataFrame:
    return gold.commerce_performance(t.stored_orders, "item_gmv_eur", "item_discount_eur", *YEAR)


@query
def logistics_performance_1997(t: Tables) -> DataFrame:
    return gold.logistics_performance(t.stored_enriched, t.hubs, t.incidents, *YEAR)


@query
def customer_experience_1997(t: Tables) -> DataFrame:
    return _customer_experience(t, *YEAR)


@query
def data_reliability_1997(t: Tables) -> DataFrame:
    return recon.reliability_daily(t.reconciliation, *YEAR)


# --- quality ---------------------------------------------------------------------------------------


@query
def dq_controls(t: Tables) -> DataFrame:
    return t.controls


@query
def dq_health_score(t: Tables) -> DataFrame:
    return quality.health_score(t.controls)


@query
def dq_summary(t: Tables) -> DataFrame:
    return quality.control_summary(t.controls, t.data_incidents)


@query
def dq_domain_trust(t: Tables) -> DataFrame:
    return quality.domain_trust(t.controls)


@query
def dq_trust_summary(t: Tables) -> DataFrame:
    return quality.trust_summary(t.controls)


@query
def orphan_lines(t: Tables) -> DataFrame:
    """Part keys of lines that no part has, with their rows."""
    return joins.missing_keys(t.order_items, "product_id", t.products, "product_id").select(
        F.col("key").alias("product_id"), "child_rows"
    )


@query
def events_without_orders(t: Tables) -> DataFrame:
    """Order keys of purchase events that no order has, with their rows."""
    linked = t.app_events.where(F.col("order_id").isNotNull())
    return joins.missing_keys(linked, "order_id", t.order_heads, "order_id").select(F.col("key").alias("order_id"), "child_rows")


@query
def distinct_customers_by_month(t: Tables) -> DataFrame:
    """Different customers per month and case type, united from a mart of customer sets per day, segment and case type."""
    cases = t.cases.select(F.to_date("created_ts").alias("day"), "customer_segment", "case_type", "customer_id")
    mart = materialize(distinct_sets.distinct_sets(cases, ["day", "customer_segment", "case_type"], "customer_id"), f"{t.label}/customer_sets")
    months = mart.withColumn("month", F.date_format("day", "yyyy-MM"))
    return distinct_sets.distinct_counts(months, ["month", "case_type"], "customers")


@query
def orders_without_lines(t: Tables) -> DataFrame:
    """Orders that no line, and so no payment, belongs to."""
    return joins.missing_keys(t.orders, "order_id", t.payments, "order_id").select(
        F.col("key").alias("order_id"), "child_rows"
    )


@query
def customers_on_both_sides(t: Tables) -> DataFrame:
    """Customers with an order that are also customers of the event stream: the two sets are not disjoint."""
    return joins.shared_keys(t.orders.select("customer_id"), t.app_events.select("customer_id"), "customer_id")


@query
def amount_mismatches(t: Tables) -> DataFrame:
    return quality.amount_mismatches(t.orders, "order_total_eur", t.payments, "payment_amount_eur", "order_id")


@query
def terminal_events(t: Tables) -> DataFrame:
    return quality.last_terminal_event(t.tracking)


@query
def column_tests(t: Tables) -> DataFrame:
    frames = {
        "customers": t.customers,
        "orders": t.orders,
        "payments": t.payments,
        "shipments": t.stored_shipments,
        "support_cases": t.cases,
        "app_events": t.app_events,
    }
    tests = [quality.column_tests(df, f"stg_{name}", staging.TESTS[name]) for name, df in frames.items()]
    return quality.union_controls(tests)


@query
def source_assertions(t: Tables) -> DataFrame:
    frames = {
        "customers": t.customer_heads,
        "orders": t.order_heads,
        "order_items": t.order_items,
        "payments": t.payments,
        "warehouses": t.raw("nation").select(hub_id("n_nationkey").alias("warehouse_id")),
        "carriers": t.carriers,
        "shipments": t.stored_shipments,
        "tracking_events": t.tracking,
        "support_cases": t.cases,
        "app_events": t.app_events,
    }
    return contracts.source_assertions(frames)


# --- reconciliation --------------------------------------------------------------------------------


@query
def daily_reconciliation(t: Tables) -> DataFrame:
    return t.reconciliation


@query
def recon_incident(t: Tables) -> DataFrame:
    return t.data_incidents


@query
def data_reliability_daily(t: Tables) -> DataFrame:
    return recon.reliability_daily(t.reconciliation)


@query
def reliability_totals(t: Tables) -> DataFrame:
    return recon.incident_totals(recon.reliability_daily(t.reconciliation))


# --- anomalies -------------------------------------------------------------------------------------


@query
def hub_baselines(t: Tables) -> DataFrame:
    return anomaly.hub_baselines(t.stored_shipments)


@query
def hub_daily(t: Tables) -> DataFrame:
    return anomaly.hub_daily(t.stored_shipments)


@query
def hub_windows(t: Tables) -> DataFrame:
    return t.windows


@query
def hub_windows_excluded(t: Tables) -> DataFrame:
    """Windows against a baseline without the window itself."""
    return anomaly.scored_windows(t.stored_shipments, replace(RULES, exclude_window=True))


@query
def hub_candidates(t: Tables) -> DataFrame:
    return anomaly.window_candidates(t.windows, RULES)


@query
def hub_incidents(t: Tables) -> DataFrame:
    return t.incidents


@query
def hub_summary(t: Tables) -> DataFrame:
    return anomaly.anomaly_summary(t.windows, t.incidents, t.logistics_trust)


@query
def incident_shipment_pairs(t: Tables) -> DataFrame:
    days = incident_days(t.incidents)
    return incident_shipments(t.stored_shipments, days, ["candidate_incident_id", "anomaly_score"])


@query
def incident_pairs_by_blocks(t: Tables) -> DataFrame:
    """The same pairs, with windows cut into aligned blocks instead of days."""
    windows = t.incidents.select(HUB, "candidate_incident_id", "anomaly_score", "start_date", "end_date")
    touches = hub_touches(t.stored_shipments, ["shipment_id", F.col("shipment_date").alias("day")], once=True)
    near = touches.select(HUB, "shipment_id", "day").join(windows.select(HUB).distinct(), HUB, "left_semi")
    pairs = intervals.points_in_intervals(near, "day", windows, "start_date", "end_date", [HUB])
    return pairs.select("shipment_id", "candidate_incident_id", "anomaly_score").distinct()


# --- root causes -----------------------------------------------------------------------------------


@query
def rca_period_metrics(t: Tables) -> DataFrame:
    return t.period_metrics


@query
def rca_carriers(t: Tables) -> DataFrame:
    return rootcause.carrier_contribution(t.carrier_facts)


@query
def rca_spread(t: Tables) -> DataFrame:
    return rootcause.carrier_spread(rootcause.carrier_contribution(t.carrier_facts))


@query
def rca_support(t: Tables) -> DataFrame:
    return t.support_periods


@query
def rca_seasonality(t: Tables) -> DataFrame:
    return rootcause.network_seasonality(t.stored_shipments, t.analysis_days)


@query
def rca_scores(t: Tables) -> DataFrame:
    return rootcause.cause_rows(t.cause_verdict)


@query
def rca_verdict(t: Tables) -> DataFrame:
    return t.cause_verdict


@query
def rca_reports(t: Tables) -> DataFrame:
    return t.cause_reports.select(
        "candidate_incident_id",
        "classification",
        "location",
        "warehouse_id",
        F.col("detected_window.start").alias("window_start"),
        F.col("detected_window.end").alias("window_end"),
        F.col("baseline_window.start").alias("baseline_start"),
        F.col("baseline_window.end").alias("baseline_end"),
        "rca_status",
        "primary_root_cause",
        "confidence_score",
        F.col("incident_support.cases").alias("incident_cases"),
        join_list("evidence").alias("evidence"),
    )


@query
def rca_verdict_untrusted(t: Tables) -> DataFrame:
    return _untrusted(t).cause_verdict


# --- incidents, briefs and texts -------------------------------------------------------------------


@query
def data_incident_records(t: Tables) -> DataFrame:
    return reg.data_records(t.data_incidents, quality.trust_summary(t.controls))


@query
def business_incident_records(t: Tables) -> DataFrame:
    return reg.business_records(t.incidents, t.cause_reports)


@query
def incident_registry(t: Tables) -> DataFrame:
    return t.registry


def _briefs(t: Tables) -> DataFrame:
    return t.briefs.select(
        "incident_id",
        "classification",
        F.col("detected_window.start").alias("window_start"),
        F.col("detected_window.end").alias("window_end"),
        "decision_status",
        "decision_label",
        "executive_summary",
        join_list("recommended_actions").alias("recommended_actions"),
        join_list("evidence").alias("evidence"),
        F.col("key_metrics")["event_coverage_pct"].alias("event_coverage_pct"),
        F.col("key_metrics")["missing_purchase_events"].alias("missing_purchase_events"),
        F.col("key_metrics")["anomaly_score"].alias("anomaly_score"),
        F.col("key_metrics")["affected_shipments"].alias("affected_shipments"),
    )


@query
def decision_briefs(t: Tables) -> DataFrame:
    return _briefs(t)


@query
def decision_briefs_untrusted(t: Tables) -> DataFrame:
    return _briefs(_untrusted(t))


@query
def brief_markdown(t: Tables) -> DataFrame:
    return briefs.brief_markdown(t.briefs)


@query
def brief_contract(t: Tables) -> DataFrame:
    return briefs.brief_violations(t.briefs).select("incident_id", F.size("violations").alias("violations"))


@query
def incident_command_center(t: Tables) -> DataFrame:
    return briefs.command_center(t.registry, t.briefs)


@query
def incident_command_center_untrusted(t: Tables) -> DataFrame:
    other = _untrusted(t)
    return briefs.command_center(other.registry, other.briefs)


@query
def prompt_packs(t: Tables) -> DataFrame:
    packs = briefs.prompt_packs(t.briefs, INSTRUCTIONS, REQUEST)
    return packs.select("incident_id", "system_prompt", "user_prompt", F.to_json("guardrails").alias("guardrails"))


@query
def prompt_preview(t: Tables) -> DataFrame:
    return briefs.prompt_preview(briefs.prompt_packs(t.briefs, INSTRUCTIONS, REQUEST))


def _validated(t: Tables) -> DataFrame:
    return grounding.checked_reports(t.reports)


@query
def report_validation(t: Tables) -> DataFrame:
    columns = ["conv_id", "turn", "incident_id", "checked", join_list("warnings").alias("warnings"), "warning_count"]
    return _validated(t).select(*columns)


@query
def named_report_validation(t: Tables) -> DataFrame:
    """Every turn against every incident that it names."""
    columns = ["conv_id", "turn", "incident_id", "checked", join_list("warnings").alias("warnings"), "warning_count"]
    return t.named_checks.select(*columns)


@query
def named_incident_ids(t: Tables) -> DataFrame:
    """Which incidents turns name, where in the text, and whether there is such an incident."""
    return t.named_checks.where(F.col("incident_id").isNotNull()).select("conv_id", "turn", "incident_id", "start", "known", "unknown_id")


@query
def report_concepts(t: Tables) -> DataFrame:
    found = grounding.concept_warnings(F.col("report"))
    return t.reports.select("conv_id", "turn", join_list(found).alias("warnings"), F.size(found).alias("warning_count"))


@query
def report_rollup(t: Tables) -> DataFrame:
    return grounding.warning_rollup(_validated(t))


@query
def correction_requests(t: Tables) -> DataFrame:
    packs = briefs.prompt_packs(t.briefs, INSTRUCTIONS, REQUEST).select("incident_id", "user_prompt")
    rows = grounding.correction_requests(_validated(t).join(packs, "incident_id", "left"), CORRECTION)
    return rows.select("conv_id", "turn", "incident_id", "correction_request")


# --- sources and sinks -----------------------------------------------------------------------------


@query
def csv_round_trip(t: Tables) -> DataFrame:
    """The incidents, written as CSV and read by their declared schema."""
    path = t.scratch("incidents_csv")
    writers.write_csv(t.incidents, path)
    return readers.read_csv(t.spark, path, schemas.BUSINESS_INCIDENTS, schemas.INCIDENT_COLUMNS)


@query
def json_round_trip(t: Tables) -> DataFrame:
    """The registry, written as JSON lines and read by its schema."""
    path = t.scratch("registry_json")
    writers.write_json(t.registry, path)
    return readers.read_json(t.spark, path, reg.registry_schema())


@query
def parquet_round_trip(t: Tables) -> DataFrame:
    """The reconciliation mart, written by month and read as a named dataset of a layer."""
    folder = t.scratch("gold")
    days = data_reliability_daily(t).withColumn("month", F.date_format("report_date", "yyyy-MM"))
    writers.write_parquet(days, f"{folder}/data_reliability.parquet", partition_by="month")
    paths = readers.dataset_names(t.spark, folder)
    return readers.read_table(t.spark, "gold", "data_reliability", paths["data_reliability"]).drop("month")


@query
def export_counts(t: Tables) -> DataFrame:
    """Rows of the marts as counted while they were exported, sorted by day."""
    marts = {
        "commerce_performance": commerce_performance(t),
        "data_reliability": data_reliability_daily(t),
        "incident_command_center": incident_command_center(t),
    }
    order = {"commerce_performance": ["report_date"], "data_reliability": ["report_date"]}
    return writers.export_marts(marts, t.scratch("export"), order)


@query
def run_log(t: Tables) -> DataFrame:
    """The run-log row of the raw layer, without its time stamps."""
    inventory = profile.table_inventory({name: t.raw(name) for name in SCHEMAS}, "bronze")
    return writers.run_row(inventory).drop("run_id", "run_ts")


@query
def row_count_contract(t: Tables) -> DataFrame:
    """Row counts of derived tables against what their parent tables say, and of the two tables that never grow."""
    n = F.count(F.lit(1))
    lines = t.lines.select("l_orderkey", "l_returnflag")
    wanted = {
        "shipments": n, "tracking": 3 * n, "payments": F.count_distinct("l_orderkey"),
        "cases": F.count_if(F.col("l_returnflag") == "R"),
    }
    tables = {"shipments": t.stored_shipments, "tracking": t.tracking, "payments": t.payments, "cases": t.cases}
    sides = [contracts.expected(lines, wanted), *[contracts.observed(df, {name: n}) for name, df in tables.items()]]
    fixed = {"region": 5, "nation": 25}
    sides += [contracts.observed(t.raw(name), {name: n}) for name in fixed] + [contracts.must_be(t.raw("region"), fixed)]
    return contracts.contract("row_counts", sides)


@query
def run_log_retried(t: Tables) -> DataFrame:
    """The run log after a run that failed and was written again, and a second run."""
    inventory = profile.table_inventory({name: t.raw(name) for name in SCHEMAS}, "bronze")
    row = materialize(writers.run_row(inventory).drop("run_id", "run_ts"), f"{t.label}/run_row")
    path = t.scratch("run_log")
    for run, status in (("RUN-1", "FAILED"), ("RUN-1", "SUCCESS"), ("RUN-2", "SUCCESS")):
        run_log_file.append_keyed(row.withColumns({"run_id": F.lit(run), "status": F.lit(status)}), path)
    return run_log_file.read_keyed(t.spark, path, "run_id")


@query
def export_order(t: Tables) -> DataFrame:
    """Whether exports of a mart are in global order: one written by ranges of the day, one with its rows dealt out."""
    mart = commerce_performance(t)
    paths = {name: t.scratch(name) for name in ("ordered", "dealt")}
    ordered.write_ordered(mart, paths["ordered"], ["report_date"])
    mart.repartition(4, F.xxhash64("report_date", "sales_channel")).write.parquet(paths["dealt"])
    found = [ordered.verify_order(t.spark, path, ["report_date"]).select(F.lit(name).alias("export"), "rows", "sorted") for name, path in paths.items()]
    return found[0].unionByName(found[1])


@query
def json_records(t: Tables) -> DataFrame:
    """Cases written as files of JSON arrays, some records broken, and how many came through or why not."""
    fields = ["case_id", "priority", "csat_score"]
    text = (
        F.when(F.col("shipment_damaged_flag") == 1, F.to_json(F.struct("case_id", "priority", F.lit("n/a").alias("csat_score"))))
        .when(F.col("escalated_flag") == 1, F.to_json(F.struct("priority", "csat_score")))
        .when(F.col("reopened_flag") == 1, F.to_json(F.array("case_id")))
        .otherwise(F.to_json(F.struct(*fields)))
    )
    files = t.cases.count() // 5000 + 1
    told = t.cases.select(F.pmod(F.xxhash64("case_id"), F.lit(files)).alias("file"), text.alias("record"))
    arrays = told.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
    path = t.scratch("case_records")
    arrays.write.partitionBy("file").text(path)  # one array per file
    schema = T.StructType.fromDDL("case_id string, priority string, csat_score int")
    fit, rejected = readers.read_records(t.spark, path, schema, required=["case_id"])
    outcomes = fit.select(F.lit("fit").alias("outcome")).unionByName(rejected.select(F.col("reason").alias("outcome")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


@query
def monthly_refresh(t: Tables) -> DataFrame:
    """A layer of order lines by month after one month's lines changed: its rows, and which months were written anew.

    The source's files hold a quarter each, so a change in one month writes three months anew and no others.
    """
    root, source = t.scratch("monthly_lines"), t.scratch("line_files")
    quarter = F.concat_ws("Q", F.year("day"), F.quarter("day"))
    lines = t.lines.select("l_quantity", "l_returnflag", F.to_date("l_shipdate").alias("day")).withColumn("quarter", quarter)
    lines.repartition("quarter").write.partitionBy("quarter").parquet(source)

    def by_month(rows: DataFrame) -> DataFrame:
        return rows.groupBy(layers.month_of("day").alias("month")).agg(
            F.count(F.lit(1)).alias("lines"), exact_sum("l_quantity").alias("quantity"), F.count_if(F.col("l_returnflag") == "R").alias("returned")
        )

    layer = layers.MonthlyLayer(t.spark, f"tidemark_layers.lines_{root.rpartition('-')[2]}", root, source, "day", by_month)
    layer.refresh()
    before = materialize(layer.file_times(), f"{t.label}/times_before").withColumnRenamed("written_at", "was_at")
    doubled = F.when(layers.month_of("day") == "1996-03", F.col("l_quantity") * 2).otherwise(F.col("l_quantity"))
    changed = lines.where(F.col("quarter") == "1996Q1").withColumn("l_quantity", doubled)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("quarter").parquet(source)
    layer.refresh()
    times = layer.file_times().join(before, "month", "left")
    anew = times.select("month", F.coalesce(F.col("written_at") > F.col("was_at"), F.lit(True)).cast("int").alias("rewritten"))
    return layer.read().join(anew, "month")


# --- measures --------------------------------------------------------------------------------------


@query
def measures_executive(t: Tables) -> DataFrame:
    return executive_daily(t).agg(*measures("executive"))


@query
def measures_commerce(t: Tables) -> DataFrame:
    return commerce_performance(t).groupBy("customer_segment").agg(*measures("commerce"))


@query
def measures_logistics(t: Tables) -> DataFrame:
    return logistics_performance(t).groupBy("warehouse_id").agg(*measures("logistics"))


@query
def measures_reliability(t: Tables) -> DataFrame:
    return data_reliability_daily(t).agg(*measures("reliability"))


@query
def measures_support(t: Tables) -> DataFrame:
    return customer_experience(t).groupBy("priority").agg(*measures("support"))


@query
def measures_incidents(t: Tables) -> DataFrame:
    return incident_command_center(t).agg(*measures("incidents"))


# --- contracts, profiles and inventories -----------------------------------------------------------


@query
def contract_checks(t: Tables) -> DataFrame:
    """The contracts of every layer over the built tables."""
    sources = {
        "orders": t.orders,
        "shipments": t.stored_shipments,
        "support_cases": t.cases,
        "app_events": t.app_events,
    }
    shipments, cases = t.stored_shipments, t.cases.withColumn("case_date", F.to_date("created_ts"))
    repeated = (
        incident_shipment_pairs(t).groupBy("shipment_id").agg(F.count(F.lit(1)).alias("incidents"))
    )
    checks = [
        contracts.silver_contract(t.stored_orders, t.stored_enriched, t.support_enriched, t.funnel, sources),
        contracts.executive_contract(executive_daily(t), t.bounds, t.orders, t.stored_shipments, t.cases, t.app_events),
        contracts.logistics_contract(logistics_performance(t), shipments, t.incidents),
        contracts.reliability_contract(data_reliability_daily(t), t.reconciliation, t.data_incidents),
        contracts.customer_contract(customer_experience(t), cases, repeated),
        contracts.commerce_contract(commerce_performance(t), t.stored_orders),
        contracts.command_center_contract(incident_command_center(t), t.registry),
    ]
    return quality.union_controls(checks)


@query
def table_inventory(t: Tables) -> DataFrame:
    inventory = profile.table_inventory({name: t.raw(name) for name in SCHEMAS}, "bronze")
    return inventory.drop("source_path")


@query
def order_profile(t: Tables) -> DataFrame:
    return profile.table_profile(
        t.orders,
        "orders",
        distinct=["customer_id", "order_status", "sales_channel"],
        means=["order_total_eur"],
        sums=["order_total_eur"],
        envelope=["order_ts"],
    )


@query
def shipment_profile(t: Tables) -> DataFrame:
    return profile.table_profile(
        t.stored_shipments,
        "shipments",
        distinct=["carrier_id", "origin_warehouse_id"],
        shares=["cross_border", "sla_met", "delayed_flag", "no_scan_flag", "damaged_flag", "lost_flag"],
        means=["distance_km", "actual_transit_hours", "network_load_factor"],
        envelope=["shipment_created_ts"],
    )


@query
def status_frequencies(t: Tables) -> DataFrame:
    return profile.value_counts(t.cases, ["case_type", "root_cause_category", "priority", "support_team"])


# --- derived columns -------------------------------------------------------------------------------


@query
def order_financials(t: Tables) -> DataFrame:
    orders = t.orders.select("order_id", "order_status")
    paid = t.payments.select("order_id", derive.order_status("payment_status").alias("status_from_payment"))
    rows = derive.order_financials(orders, t.order_items).join(paid, "order_id", "left")
    return rows.withColumn("terminal_event", derive.terminal_event("order_status"))


@query
def line_valuation(t: Tables) -> DataFrame:
    lines = t.lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_discount").alias("discount_pct"),
    )
    valued = derive.line_values(lines.withColumn("price", round_to("price", 2)), "price")
    return valued.groupBy("order_id").agg(
        exact_sum("gross_value_eur").alias("gross_value_eur"),
        exact_sum("discount_value_eur").alias("discount_value_eur"),
        exact_sum("net_value_eur").alias("net_value_eur"),
    )


@query
def shipment_risk(t: Tables) -> DataFrame:
    """Delay risk per shipment, averaged per tier and route scope."""
    hubs = t.hubs.select(F.col("warehouse_id").alias("origin_warehouse_id"), "baseline_reliability")
    rows = t.stored_shipments.join(t.carriers.select("carrier_id", "reliability_score"), "carrier_id", "left").join(
        hubs, "origin_warehouse_id", "left"
    )
    risk = derive.delay_risk(
        F.col("network_load_factor"),
        F.col("reliability_score"),
        F.col("baseline_reliability"),
        F.col("distance_km"),
        F.col("shipment_created_ts"),
    )
    return (
        rows.withColumn("risk", round_to(risk, 6))
        .groupBy("service_tier", "cross_border")
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            round_to(exact_avg("risk", 6), 4).alias("avg_risk"),
            F.min("risk").alias("min_risk"),
            F.max("risk").alias("max_risk"),
            round_to(exact_avg("sla_hours", 2), 2).alias("avg_sla_hours"),
            round_to(exact_avg("distance_km", 1), 1).alias("avg_distance_km"),
        )
    )


@query
def product_margins(t: Tables) -> DataFrame:
    return t.products.withColumn("margin_pct", derive.margin_pct(F.col("list_price_eur"), F.col("unit_cost_eur")))


@query
def load_band_delay(t: Tables) -> DataFrame:
    return derive.delay_by_load_band(t.stored_shipments)


@query
def load_bucket_delay(t: Tables) -> DataFrame:
    return derive.delay_by_load_band(t.stored_shipments, right=False)


@query
def funnel_conversion(t: Tables) -> DataFrame:
    return derive.funnel_conversion(t.app_events)


@query
def event_sequence(t: Tables) -> DataFrame:
    """Events of a session, numbered by time."""
    events = t.app_events.select("event_id", "session_id", "event_ts")
    # A session is one day already, so a busy one is split by the hour.
    return derive.event_sequence(events, "session_id", bucket=F.date_trunc("hour", "event_ts"))


@query
def contact_number(t: Tables) -> DataFrame:
    """Cases of a customer, numbered by time."""
    cases = t.cases.select("case_id", "customer_id", "created_ts")
    order = [F.col("created_ts"), F.col("case_id")]
    return rank_in_buckets(cases, ["customer_id"], F.to_date("created_ts"), order, "contact_number")


@query
def route_counts(t: Tables) -> DataFrame:
    return derive.route_counts(t.stored_shipments)

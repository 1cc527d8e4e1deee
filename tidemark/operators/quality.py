"""Data-quality controls: one row per control, many controls per scan."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.banding import lookup
from tidemark.functions.calendar import wall_micros
from tidemark.functions.numeric import count_where, round_to, safe_ratio
from tidemark.operators.census import Census, Source, Use
from tidemark.operators.joins import key_census, missing_keys, missing_names, one_row_per_key, orphan_rows

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("control_id", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("observed", T.StringType()),
        T.StructField("observed_num", T.DoubleType()),
        T.StructField("threshold", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)
# Weight of a control in the health score, domains that make up logistics trust.
SEVERITY_WEIGHT = {"Low": 1, "Medium": 2, "High": 3, "Critical": 5}
LOGISTICS_DOMAINS = ["shipments", "tracking_events", "logistics"]


@dataclass(frozen=True)
class TableRules:
    """What a table must hold: key columns, required columns, and columns that must not be NULL."""

    key: list[str]
    required: list[str]
    critical: list[str]


@dataclass(frozen=True)
class Control:
    control_id: str
    domain: str
    check_type: str
    severity: str
    details: str
    threshold: str = "0"

    def column(self, issues: Column, observed: Column | None = None) -> Column:
        """The control row as a struct, failing when there is any issue."""
        values = {
            "control_id": F.lit(self.control_id),
            "domain": F.lit(self.domain),
            "check_type": F.lit(self.check_type),
            "status": F.when(issues == 0, "PASS").otherwise("FAIL"),
            "severity": F.lit(self.severity),
            "observed": issues.cast("bigint").cast("string") if observed is None else observed,
            "observed_num": issues.cast("double"),
            "threshold": F.lit(self.threshold),
            "details": F.lit(self.details),
        }
        return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in CONTROL_SCHEMA])

    def row(self, one_row: DataFrame, issues: Column | str) -> DataFrame:
        issues = F.col(issues) if isinstance(issues, str) else issues
        return one_row.select(F.inline(F.array(self.column(F.coalesce(issues, F.lit(0))))))


_TERMINAL = Control(
    "SHIPMENT_TERMINAL_EVENT_RECON",
    "logistics",
    "Cross-System Reconciliation",
    "Critical",
    "Delivered/Lost shipment state must match terminal tracking event.",
)
_CHRONOLOGY = {"support_cases": "SUPPORT_CHRONOLOGY"}


def _late(steps: list[str]) -> Column:
    """Whether a later step is dated before the one it follows; a NULL date passes."""
    return reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(after) < F.col(before), F.lit(False)) for before, after in zip(steps, steps[1:])],
    )


def union_controls(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_controls(df: DataFrame, name: str, rules: TableRules) -> DataFrame:
    """Schema, key uniqueness and critical-NULL controls of one table, from one scan.

    Rows are grouped by the key with their NULL counts as aggregates; a second, tiny aggregate then
    gives both the surplus rows (every row of a key beyond the first) and the NULL total.
    """
    absent = missing_names(set(rules.required), set(df.columns))
    schema_note = "Required schema present" if not absent else "Missing columns: " + ", ".join(
        c for c in rules.required if c in absent
    )
    upper = name.upper()
    controls = [
        Control(f"{upper}_SCHEMA", name, "Schema", "High", schema_note).column(F.lit(len(absent)))
    ]
    critical = [F.col(c).isNull().cast("int") for c in rules.critical if c in df.columns]
    nulls = reduce(lambda a, b: a + b, critical, F.lit(0))
    key = rules.key if all(c in df.columns for c in rules.key) else []
    measured = df.select(*key, nulls.alias("_nulls"))
    if key:
        measured = measured.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"))
        details = f"Duplicate {', '.join(key)} values"
        controls.append(Control(f"{upper}_PK", name, "Uniqueness", "High", details).column(F.col("surplus")))
    else:
        measured = measured.withColumn("_n", F.lit(1))
    controls.append(
        Control(f"{upper}_CRITICAL_NULLS", name, "Completeness", "High", "Null values in critical fields").column(
            F.col("nulls")
        )
    )
    totals = measured.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("nulls"),
    )
    return totals.select(F.inline(F.array(*controls)))


def reference_control(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, child_name: str, parent_name: str
) -> DataFrame:
    """Child rows whose key no parent row has; filter the child first where NULL means "not linked"."""
    control = Control(
        f"{child_name.upper()}_{parent_name.upper()}_FK",
        child_name,
        "Referential Integrity",
        "High",
        f"{column} must exist in {parent_name}.{parent_column}",
    )
    orphans = missing_keys(child, column, parent, parent_column).agg(F.sum("child_rows").alias("n"))
    return control.row(orphans, "n")


def reference_controls(
    parent: DataFrame, parent_column: str, parent_name: str, children: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """The reference controls of several children of one parent, from one grouping by the key."""
    census = key_census({"_parent": (parent, parent_column), **children})
    totals = census.agg(*[orphan_rows(name, "_parent").alias(name) for name in children])
    controls = [
        Control(
            f"{name.upper()}_{parent_name.upper()}_FK",
            name,
            "Referential Integrity",
            "High",
            f"{column} must exist in {parent_name}.{parent_column}",
        ).column(F.col(name))
        for name, (_, column) in children.items()
    ]
    return totals.select(F.inline(F.array(*controls)))


def amount_mismatches(
    left: DataFrame, left_amount: str, right: DataFrame, right_amount: str, key: str, tolerance: float = 0.01
) -> DataFrame:
    """Keys on both sides whose amounts differ by more than the tolerance. Both sides must be unique."""
    pair = one_row_per_key(left.select(key, left_amount), [key], "left side").join(
        one_row_per_key(right.select(key, right_amount), [key], "right side"), key
    )
    return pair.where(F.abs(F.col(left_amount) - F.col(right_amount)) > tolerance)


def amount_control(
    orders: DataFrame, payments: DataFrame, total: str = "order_total_eur", paid: str = "payment_amount_eur"
) -> DataFrame:
    control = Control(
        "ORDER_PAYMENT_AMOUNT_RECON",
        "commerce",
        "Cross-System Reconciliation",
        "Critical",
        "Order total must reconcile to payment amount.",
    )
    wrong = amount_mismatches(orders, total, payments, paid, "order_id")
    return control.row(wrong.agg(F.count(F.lit(1)).alias("n")), "n")


def last_terminal_event(tracking: DataFrame, terminal: tuple[str, ...] = ("DELIVERED", "LOST")) -> DataFrame:
    """Latest terminal event type of every shipment, by event time and then sequence.

    Time, sequence and type are packed into one decimal: its maximum is a plain hash aggregate, where
    ``max_by`` over a struct would sort all events.
    """
    latest = tracking.groupBy("shipment_id").agg(F.max(packed_terminal(terminal)).alias("_last")).where(F.col("_last").isNotNull())
    chosen = F.element_at(F.array(*[F.lit(t) for t in terminal]), (F.col("_last") % 10).cast("int"))
    return latest.select("shipment_id", chosen.alias("terminal_event"))


def packed_terminal(terminal: tuple[str, ...] = ("DELIVERED", "LOST")) -> Column:
    """Time, sequence and type of a terminal event in one decimal: the greatest is the last one. NULL for other events."""
    code = F.array_position(F.array(*[F.lit(t) for t in terminal]), F.col("event_type"))
    moment = wall_micros("event_ts").cast("decimal(20,0)")
    packed = moment * F.lit(10**15).cast("decimal(16,0)") + F.col("event_sequence") * 10 + code
    return F.when(F.col("event_type").isin(*terminal), packed.cast("decimal(38,0)"))


@dataclass(frozen=True)
class Reference:
    """A child table's column that must be a key of a parent table; rows outside ``when`` are not linked."""

    child: str
    parent: str
    column: str
    when: Column | None = None


def census_controls(
    tables: dict[str, tuple[DataFrame, TableRules]], references: list[Reference], steps: dict[str, list[str]] | None = None
) -> DataFrame:
    """Schema, uniqueness, critical-NULL, reference, terminal-state and chronology controls of many tables.

    One tagged census answers all of them, with each table read once. Tables have single-column keys. With both
    ``shipments`` and ``tracking_events`` there is the terminal control; ``steps`` names the ordered dates of a table.
    """
    sources, controls = [], []
    terminal = {"shipments", "tracking_events"} <= set(tables)
    for name, (df, rules) in tables.items():
        (key,) = rules.key
        uses = [Use(name, name, key)] if key in df.columns else []
        uses += [Use(r.parent, name, r.column, r.when, packed_terminal() if terminal and (r.parent, name) == ("shipments", "tracking_events") else None) for r in references if r.child == name]
        if terminal and name == "shipments":
            uses += [Use(name, "to_deliver", key, F.col("lost_flag") == 0), Use(name, "to_lose", key, F.col("lost_flag") == 1)]
        critical = [F.col(c).isNull().cast("bigint") for c in rules.critical if c in df.columns]
        broken = {f"{name} nulls": reduce(lambda a, b: a + b, critical, F.lit(0).cast("bigint"))}
        if order := (steps or {}).get(name):
            broken[f"{name} order"] = _late(order)
        sources.append(Source(df, uses, broken))
    census = Census(sources)
    for name, (df, rules) in tables.items():
        upper, high = name.upper(), "High"
        absent = missing_names(set(rules.required), set(df.columns))
        note = "Missing columns: " + ", ".join(c for c in rules.required if c in absent) if absent else "Required schema present"
        controls.append((Control(f"{upper}_SCHEMA", name, "Schema", high, note), F.lit(len(absent)).cast("bigint")))
        if rules.key[0] in df.columns:
            controls.append((Control(f"{upper}_PK", name, "Uniqueness", high, f"Duplicate {rules.key[0]} values"), census.surplus(name, name)))
        controls.append((Control(f"{upper}_CRITICAL_NULLS", name, "Completeness", high, "Null values in critical fields"), census.broken(f"{name} nulls")))
        if order := (steps or {}).get(name):
            controls.append((Control(_CHRONOLOGY.get(name, f"{upper}_CHRONOLOGY"), name, "Validity", high, " <= ".join(order)), census.broken(f"{name} order")))
    for r in references:
        key = tables[r.parent][1].key[0]
        details = f"{r.column} must exist in {r.parent}.{key}"
        control = Control(f"{r.child.upper()}_{r.parent.upper()}_FK", r.child, "Referential Integrity", "High", details)
        controls.append((control, census.orphans(r.parent, r.child, r.parent)))
    if terminal:
        last = F.when(~census.unknown(), F.col("top") % 10)
        wrong = census.rows_where("shipments", "to_deliver", ~last.eqNullSafe(F.lit(1))) + census.rows_where("shipments", "to_lose", ~last.eqNullSafe(F.lit(2)))
        controls.append((_TERMINAL, wrong))
    wanted = {control.control_id: (control, issues) for control, issues in controls}
    return census.rows({name: issues for name, (_, issues) in wanted.items()}, lambda name, value: wanted[name][0].column(value))


def terminal_control(shipments: DataFrame, tracking: DataFrame) -> DataFrame:
    """Lost shipments must end in LOST, all others in DELIVERED; no terminal event is an issue too."""
    wanted = F.when(F.col("lost_flag") == 0, "DELIVERED").when(F.col("lost_flag") == 1, "LOST")
    states = shipments.select("shipment_id", wanted.alias("wanted")).where(F.col("wanted").isNotNull())
    ends = states.join(last_terminal_event(tracking), "shipment_id", "left")
    wrong = ~F.col("terminal_event").eqNullSafe(F.col("wanted"))
    return _TERMINAL.row(ends.agg(count_where(wrong).alias("n")), "n")


def chronology_control(
    df: DataFrame, steps: list[str], control_id: str = "SUPPORT_CHRONOLOGY", domain: str = "support_cases"
) -> DataFrame:
    """Rows where a later step is dated before the step it follows; a NULL date passes."""
    control = Control(control_id, domain, "Validity", "High", " <= ".join(steps))
    return control.row(df.agg(count_where(_late(steps)).alias("n")), "n")


def health_score(controls: DataFrame) -> DataFrame:
    """Share of passed control weight in percent; 100 where there is no control."""
    weight = lookup("severity", SEVERITY_WEIGHT)
    passed = F.sum(F.when(F.col("status") == "PASS", weight).otherwise(0))
    score = round_to(safe_ratio(passed, F.sum(weight)) * 100, 2)
    return controls.agg(F.coalesce(score, F.lit(100.0)).alias("data_health_score"))


def control_summary(controls: DataFrame, incidents: DataFrame) -> DataFrame:
    """Health score, control counts and data-incident count in one row."""
    weight = lookup("severity", SEVERITY_WEIGHT)
    candidate = incidents.select(F.lit(None).cast("string").alias("status"), F.lit(0).alias("weight"))
    rows = controls.select("status", weight.alias("weight")).unionByName(candidate)
    passed = F.sum(F.when(F.col("status") == "PASS", F.col("weight")).otherwise(0))
    score = round_to(safe_ratio(passed, F.sum("weight")) * 100, 2)
    return rows.agg(
        F.coalesce(score, F.lit(100.0)).alias("data_health_score"),
        F.count("status").alias("controls_executed"),
        count_where(F.col("status") == "PASS").alias("controls_passed"),
        count_where(F.col("status") == "FAIL").alias("controls_failed"),
        count_where(F.col("status").isNull()).alias("data_incident_candidates"),
    )


def domain_trust(controls: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """Checks, failures and verdict for a set of domains; trusted where no control covers them."""
    inside = F.col("domain").isin(*(domains or LOGISTICS_DOMAINS))
    failures = count_where(inside & (F.col("status") == "FAIL"))
    return controls.agg(
        count_where(inside).alias("checks"),
        failures.alias("failures"),
        (failures == 0).cast("int").alias("trusted"),
    )


def trust_summary(controls: DataFrame, apart: str = "app_events") -> DataFrame:
    failed = F.col("status") == "FAIL"
    return controls.agg(
        F.count(F.lit(1)).alias("controls_executed"),
        count_where(failed).alias("controls_failed"),
        count_where(failed & (F.col("domain") != apart)).alias("non_app_failures"),
    )


@dataclass(frozen=True)
class ColumnRules:
    """Column tests of one model: NULL-free columns, unique columns, allowed values."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)


def column_tests(df: DataFrame, model: str, rules: ColumnRules) -> DataFrame:
    """One row per test with its failing rows: NULL rows, keys that occur twice or more, and rows
    with a value outside the list. NULL passes the unique and accepted-values tests."""
    aggregates = [(c, "not_null", count_where(F.col(c).isNull())) for c in rules.not_null]
    aggregates += [
        (c, "accepted_values", count_where(F.col(c).isNotNull() & ~F.col(c).isin(*allowed)))
        for c, allowed in rules.accepted.items()
    ]
    frames = []
    if aggregates:
        names = [f"t{i}" for i in range(len(aggregates))]
        totals = df.agg(*[agg.alias(n) for n, (_, _, agg) in zip(names, aggregates)])
        rows = [
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), F.col(n).alias("failing_rows"))
            for n, (c, t, _) in zip(names, aggregates)
        ]
        frames.append(totals.select(F.inline(F.array(*rows))))
    for column in rules.unique:
        counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        frames.append(
            counts.agg(count_where(F.col("n") > 1).alias("failing_rows")).select(
                F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failing_rows"
            )
        )
    status = F.when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL")
    return union_controls(frames).select(
        F.lit(model).alias("model"), "column_name", "test", "failing_rows", status.alias("status")
    )


def no_controls(spark: SparkSession) -> DataFrame:
    """An empty control table, as read where no control has run yet."""
    return spark.createDataFrame([], CONTROL_SCHEMA)

"""The star-schema tables in the roles of the domain: who orders, ships, handles and asks for support.

Every frame is lazy and built from the tables in one folder, so queries prune what they do not use.

Orders keep their total; payments are the sum of their lines. Shipments are order lines, sent from
the supplier's nation (hub) to the customer's nation (hub) by the supplier as carrier. Support cases
belong to returned lines. App events are the event stream. Expected purchases are the orders, observed
ones the orders that have lines. All joins to parents are left joins: a row whose parent is not there
stays, with NULL attributes, and the controls count it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.banding import first_match, lookup
from tidemark.functions.calendar import shift_hours
from tidemark.functions.numeric import clip, exact_sum, flag, round_to
from tidemark.operators import anomaly, briefs, grounding, quality, reconciliation, registry, rootcause
from tidemark.operators.derive import case_times, case_triage, route_distance, sla_evaluation, sla_hours
from tidemark.plans import silver
from tidemark.session import LARGE, input_bytes, materialize_parts, new_folder, remove_stored

# Declared schemas of the tables, so that opening one reads no file footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
# Required and NULL-free columns of the role tables. Lines carry no unit price, so that control fails.
ORDER_FIELDS = ["order_id", "customer_id", "order_ts", "order_total_eur", "order_status"]
ITEM_FIELDS = ["order_item_id", "order_id", "product_id", "quantity", "unit_price_eur"]
PAYMENT_FIELDS = ["payment_id", "order_id", "payment_ts", "payment_status", "payment_amount_eur"]
SHIPMENT_FIELDS = [
    "shipment_id", "order_id", "carrier_id", "origin_warehouse_id", "destination_warehouse_id",
    "shipment_created_ts", "expected_delivery_ts", "shipment_status",
]
TRACKING_FIELDS = ["event_id", "shipment_id", "event_type", "event_ts"]
CASE_FIELDS = [
    "case_id", "customer_id", "order_id", "shipment_id", "created_ts", "first_response_ts", "resolved_ts",
]
EVENT_FIELDS = ["event_id", "session_id", "event_type", "event_ts", "customer_id"]
TIERS = {"1-URGENT": "Express", "2-HIGH": "Premium", "3-MEDIUM": "Standard"}
EVENT_TYPES = {
    "view": "product_view",
    "click": "add_to_cart",
    "signup": "checkout_started",
    "purchase": "purchase",
    "error": "payment_failed",
}
# Parts in which a large table of lines meets its orders, and its shipments their cases.
PARTS = 4
# Lines arrive evenly over years and hubs here, so deltas and days are small; see the README.
RULES = anomaly.WindowRules(min_delay_pp=18.0, min_load_pp=5.0, min_score=25.0)
DAYS = reconciliation.DayRules(min_expected=6)


def hub_id(key: str) -> Column:
    return F.concat(F.lit("HUB-"), F.col(key).cast("string"))


def shipment_key() -> Column:
    """The id of the shipment of an order line."""
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")
    )


class Tables:
    """Role frames over the tables of one folder.

    Frames named ``stored_*`` and those that say so are written once under ``spark.checkpoint.dir``
    and shared by everything that reads this object. Building such a frame runs Spark jobs; ``release``
    deletes what was written. ``trusted`` puts a given verdict on the logistics data in the place of the
    controls' own, to see what the records would say.
    """

    def __init__(self, spark: SparkSession, folder: str, label: str = "tables", trusted: bool | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.label = label
        self.trusted = trusted
        self._opened: dict[str, DataFrame] = {}

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """Store a frame; its plan must not pair rows without a key."""
        return self._stored_parts([df], name)

    def _stored_parts(self, parts: list[DataFrame], name: str) -> DataFrame:
        """Store frames of one schema as one table; no plan of theirs may pair rows without a key."""
        for df in parts:
            plan = df._jdf.queryExecution().executedPlan().toString()
            if "CartesianProduct" in plan or "NestedLoop" in plan:
                raise ValueError(f"{name}: a join without a key")
        return materialize_parts(parts, f"{self.label}/{name}")

    def _shares(self) -> int:
        """In how many parts the work on all lines or shipments is done."""
        return PARTS if input_bytes(self.lines) > LARGE else 1

    def _line_parts(self) -> list[tuple[DataFrame, DataFrame]]:
        """Lines with the orders they can belong to, apart by the order's key where the lines are many."""
        orders = self.raw("orders")
        if self._shares() == 1:
            return [(self.lines, orders)]

        def part(df: DataFrame, key: str, number: int) -> DataFrame:
            return df.where(F.pmod(F.xxhash64(key), F.lit(PARTS)) == number)

        return [(part(self.lines, "l_orderkey", i), part(orders, "o_orderkey", i)) for i in range(PARTS)]

    def scratch(self, name: str) -> str:
        """A new folder for files of this object, which ``release`` deletes as well."""
        return new_folder(self.spark, f"{self.label}/{name}")

    def judged(self, trusted: bool) -> Tables:
        """The same tables under the given verdict on the logistics data; frames that it does not touch are shared."""
        other = Tables(self.spark, self.folder, f"{self.label}/{'trusted' if trusted else 'untrusted'}", trusted)
        shared = [
            "stored_shipments", "cases", "tracking", "stored_orders", "reconciliation", "key_controls", "controls",
            "candidates", "support_cells",
        ]
        other.__dict__.update({name: getattr(self, name) for name in shared})
        return other

    def release(self) -> None:
        """Delete the stored layers; frames that read them can no longer be used."""
        remove_stored(self.spark, self.label)

    def raw(self, name: str) -> DataFrame:
        if name not in self._opened:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._opened[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines, the largest table."""
        return self.raw("lineitem")

    # --- dimensions ---

    @cached_property
    def hubs(self) -> DataFrame:
        key = F.col("n_nationkey")
        regions = self.raw("region")
        return (
            self.raw("nation")
            .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                hub_id("n_nationkey").alias("warehouse_id"),
                F.col("r_name").alias("country"),
                F.col("n_name").alias("city"),
                (key * 4.0 - 48.0).alias("latitude"),
                (F.col("n_regionkey") * 40.0 - 80.0 + key).alias("longitude"),
                F.when(key % 5 == 0, "Gateway").otherwise("Regional").alias("warehouse_type"),
                (key * 10 + 200).cast("int").alias("daily_capacity"),
                round_to(key * 0.02 + 0.4, 2).alias("automation_level"),
                round_to(key * 0.004 + 0.9, 3).alias("baseline_reliability"),
            )
        )

    @cached_property
    def carriers(self) -> DataFrame:
        standing = clip(F.col("s_acctbal"), 0.0, 9999.0) / 9999.0
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("carrier_id"),
            F.col("s_name").alias("carrier_name"),
            round_to(standing * 0.14 + 0.85, 4).alias("reliability_score"),
            round_to(standing * 0.10 + 0.90, 4).alias("scan_quality_score"),
            round_to((1 - standing) * 0.02, 4).alias("damage_rate_baseline"),
            round_to((1 - standing) * 0.01, 4).alias("loss_rate_baseline"),
        )

    @cached_property
    def customer_heads(self) -> DataFrame:
        """Customers by themselves, without what their nation adds."""
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            "c_nationkey",
            F.col("c_mktsegment").alias("customer_segment"),
            F.date_add(F.lit("1994-06-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
            F.when(F.col("c_acctbal") < 0, "Overdrawn").otherwise("Active").alias("account_status"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return (
            self.customer_heads.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                "customer_id",
                F.col("n_name").alias("country"),
                "customer_segment",
                F.col("r_name").alias("acquisition_channel"),
                "signup_date",
                "account_status",
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        cost = round_to(F.col("p_retailprice") * (F.lit(0.42) + F.col("p_size") * F.lit(0.007)), 2)
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("category"),
            F.col("p_retailprice").alias("list_price_eur"),
            cost.alias("unit_cost_eur"),
        )

    # --- commerce ---

    @cached_property
    def order_heads(self) -> DataFrame:
        """Orders by themselves, without what the customer adds."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            priority.alias("sales_channel"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_totalprice").alias("order_total_eur"),
            F.when(status == "F", "Completed")
            .when(status == "P", "Pending")
            .when(priority == "5-LOW", "Cancelled")
            .otherwise("Returned")
            .alias("order_status"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        people = self.customers.select("customer_id", "customer_segment", F.col("country").alias("destination_country"))
        return self.order_heads.join(people, "customer_id", "left")

    @cached_property
    def order_items(self) -> DataFrame:
        discount = round_to(F.col("l_extendedprice") * F.col("l_discount"), 2)
        return self.lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_discount").alias("discount_pct"),
            F.col("l_extendedprice").alias("gross_value_eur"),
            discount.alias("discount_value_eur"),
            round_to(F.col("l_extendedprice") - discount, 2).alias("net_value_eur"),
        )

    @cached_property
    def order_facts(self) -> DataFrame:
        """Payment and line facts of every order, from one grouping of the lines."""
        gross = F.col("l_extendedprice")
        discount = round_to(gross * F.col("l_discount"), 2)
        net = round_to(gross - discount, 2)
        per_order = self.lines.groupBy("l_orderkey").agg(
            F.min("l_shipdate").alias("payment_ts"),
            F.max(flag(F.col("l_linestatus") == "O")).alias("open_line"),
            F.max(lookup("l_returnflag", {"R": 3, "N": 2, "A": 1})).alias("return_rank"),
            exact_sum(net).alias("payment_amount_eur"),
            F.max("l_tax").alias("fraud_score"),
            F.count(F.lit(1)).alias("item_row_count"),
            F.sum(F.col("l_quantity").cast("int")).cast("bigint").alias("item_units"),
            exact_sum(gross).alias("item_gmv_eur"),
            exact_sum(discount).alias("item_discount_eur"),
            exact_sum(net).alias("item_net_value_eur"),
        )
        return per_order.select(
            F.concat(F.lit("PAY-"), F.col("l_orderkey").cast("string")).alias("payment_id"),
            F.col("l_orderkey").alias("order_id"),
            "payment_ts",
            F.when(F.col("open_line") == 1, "Card").otherwise("Invoice").alias("payment_method"),
            lookup("return_rank", {3: "Refunded", 2: "Paid", 1: "Failed"}).alias("payment_status"),
            "payment_amount_eur",
            "fraud_score",
            "item_row_count",
            "item_units",
            "item_gmv_eur",
            "item_discount_eur",
            "item_net_value_eur",
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.order_facts.select("order_id", *silver.PAYMENT_COLUMNS)

    # --- logistics ---

    @cached_property
    def shipments(self) -> DataFrame:
        return self._shipment_columns(self._shipment_rows(self.lines, self.raw("orders")))

    def _shipment_rows(self, lines: DataFrame, orders: DataFrame) -> DataFrame:
        """Lines with what the joins add to them: all that the columns of a shipment follow from."""
        people = self.raw("customer").select("c_custkey", "c_nationkey")
        # Orders meet their customers first, so that lines are dealt out once for both.
        orders = orders.select("o_orderkey", "o_custkey", "o_orderpriority").join(
            people, F.col("o_custkey") == F.col("c_custkey"), "left"
        )
        suppliers = self.raw("supplier").select("s_suppkey", "s_name", "s_nationkey")
        sites = ["warehouse_id", "city", "country", "latitude", "longitude"]
        ends = {
            side: self.hubs.select(*[F.col(c).alias(f"{side}_{c}") for c in sites])
            for side in ("origin", "destination")
        }
        wide = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(ends["origin"], hub_id("s_nationkey") == F.col("origin_warehouse_id"), "left")
            .join(ends["destination"], hub_id("c_nationkey") == F.col("destination_warehouse_id"), "left")
        )
        km = route_distance(
            F.col("origin_latitude"),
            F.col("origin_longitude"),
            F.col("destination_latitude"),
            F.col("destination_longitude"),
        )
        return wide.select(
            *[c for c in self.lines.columns if c != "l_extendedprice"],
            F.col("s_name").alias("carrier_name"),
            lookup("o_orderpriority", TIERS, "Economy").alias("service_tier"),
            "origin_warehouse_id",
            "origin_city",
            "origin_country",
            "destination_warehouse_id",
            "destination_city",
            "destination_country",
            km.alias("distance_km"),
        )

    @staticmethod
    def _shipment_columns(rows: DataFrame) -> DataFrame:
        """The shipments of ``_shipment_rows``; every column follows from its own row."""
        lost = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)
        transit = round_to(F.col("l_discount") * 400.0 + F.col("l_tax") * 500.0 + 20.0, 2)
        base = rows.select(
            shipment_key().alias("shipment_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("carrier_id"),
            "carrier_name",
            "service_tier",
            "origin_warehouse_id",
            "origin_city",
            "origin_country",
            "destination_warehouse_id",
            "destination_city",
            "destination_country",
            F.col("l_shipdate").alias("shipment_created_ts"),
            "distance_km",
            flag(F.col("origin_country") != F.col("destination_country")).alias("cross_border"),
            round_to(F.col("l_quantity") / 40.0, 4).alias("network_load_factor"),
            transit.alias("actual_transit_hours"),
            flag(F.col("l_returnflag") == "R").alias("delayed_flag"),
            flag(F.col("l_discount") == 0).alias("no_scan_flag"),
            flag(F.col("l_tax") == 0.08).alias("damaged_flag"),
            flag(lost).alias("lost_flag"),
            "l_linestatus",
        )
        timed = base.withColumn("sla_hours", sla_hours("service_tier", "distance_km"))
        state = first_match(
            [
                (F.col("lost_flag") == 1, "Lost"),
                (F.col("delayed_flag") == 1, "Delayed"),
                (F.col("l_linestatus") == "O", "In Transit"),
            ],
            "Delivered",
        )
        late = F.greatest(F.col("actual_transit_hours") - F.col("sla_hours"), F.lit(0.0))
        arrival = shift_hours("shipment_created_ts", F.col("actual_transit_hours"))
        return timed.withColumns(
            {
                "expected_delivery_ts": shift_hours("shipment_created_ts", F.col("sla_hours")),
                "delivery_ts": F.when(F.col("lost_flag") == 0, arrival),
                "delay_hours": round_to(late, 2),
                "sla_met": flag(F.col("actual_transit_hours") <= F.col("sla_hours")),
                "shipment_status": state,
            }
        ).drop("l_linestatus")

    @cached_property
    def stored_shipments(self) -> DataFrame:
        """Dated shipments over a stored table.

        Controls, detection, root causes and marts scan shipments many times and few columns each;
        without the table every scan would repeat the joins that put a shipment together. What follows from a
        row by itself (ids as text, times, flags) is not stored: it would take most of the disk.
        """
        parts = [self._shipment_rows(*part) for part in self._line_parts()]
        shipments = self._shipment_columns(self._stored_parts(parts, "shipments"))
        return shipments.withColumn("shipment_date", F.to_date("shipment_created_ts"))

    @cached_property
    def tracking(self) -> DataFrame:
        """Three events per shipment; the last one is LOST for lost shipments, else DELIVERED.

        Not stored: they follow from single lines, and three rows with their ids take far more disk than the line.
        """
        status = self.lines.select(
            shipment_key().alias("shipment_id"),
            F.col("l_shipdate").alias("created"),
            (F.col("l_discount") * 400.0 + F.col("l_tax") * 500.0 + 20.0).alias("hours"),
            ((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)).alias("lost"),
        )
        end = F.when(F.col("lost"), "LOST").otherwise("DELIVERED")
        step = F.col("step")
        kind = F.when(step == 1, "SHIPMENT_CREATED").when(step == 2, "IN_TRANSIT").otherwise(end)
        share = F.when(step == 1, 0.0).when(step == 2, 0.5).otherwise(1.0)
        # The steps are dealt out first and the columns made of them after, so that a scan makes only those it reads.
        return status.select("*", F.explode(F.array(*[F.lit(n) for n in (1, 2, 3)])).alias("step")).select(
            "shipment_id",
            F.concat("shipment_id", F.lit("-"), step.cast("string")).alias("event_id"),
            step.cast("bigint").alias("event_sequence"),
            kind.alias("event_type"),
            shift_hours("created", round_to(F.col("hours") * share, 2)).alias("event_ts"),
        )

    # --- support ---

    @cached_property
    def cases(self) -> DataFrame:
        """Support cases over a stored table, which has what the joins add to the lines; the rest follows from its rows."""
        parts = [self._case_rows(*part) for part in self._line_parts()]
        return self._case_columns(self._stored_parts(parts, "cases"))

    @cached_property
    def derived_cases(self) -> DataFrame:
        """One case per returned line, triaged and evaluated."""
        return self._case_columns(self._case_rows(self.lines, self.raw("orders")))

    def _case_rows(self, lines: DataFrame, orders: DataFrame) -> DataFrame:
        """Returned lines with what the joins add to them: all that the columns of a case follow from."""
        people = self.raw("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        suppliers = self.raw("supplier").select("s_suppkey", "s_nationkey")
        nations = self.raw("nation").select("n_nationkey", "n_name")
        orders = orders.select("o_orderkey", "o_custkey").join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
        return (
            lines.where(F.col("l_returnflag") == "R")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                *[c for c in self.lines.columns if c not in ("l_extendedprice", "l_returnflag")],
                "o_custkey",
                "c_mktsegment",
                "n_name",
                "s_nationkey",
            )
        )

    @staticmethod
    def _case_columns(lines: DataFrame) -> DataFrame:
        """The cases of ``_case_rows``; every column follows from its own row."""
        shipment = shipment_key()
        base = lines.select(
            F.concat(F.lit("CASE-"), shipment).alias("case_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_orderkey").alias("order_id"),
            shipment.alias("shipment_id"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("n_name").alias("destination_country"),
            F.col("l_suppkey").alias("carrier_id"),
            hub_id("s_nationkey").alias("origin_warehouse_id"),
            F.when(F.col("l_linestatus") == "O", "Chat").otherwise("Email").alias("channel"),
            shift_hours("l_shipdate", F.col("l_linenumber") * 24.0).alias("created_ts"),
            round_to(F.col("l_quantity") * 12.0, 2).alias("first_response_minutes"),
            round_to(F.col("l_tax") * 900.0 + 4.0, 2).alias("resolution_hours"),
            flag(F.col("l_discount") >= 0.09).alias("escalated_flag"),
            flag(F.col("l_discount") == 0.05).alias("reopened_flag"),
            (F.col("l_partkey") % 5 + 1).cast("int").alias("csat_score"),
            round_to(F.col("l_quantity") / 40.0, 4).alias("network_load_factor"),
            F.lit(1).alias("delayed_flag"),
            flag(F.col("l_discount") == 0).alias("no_scan_flag"),
            flag(F.col("l_tax") == 0.08).alias("damaged_flag"),
            F.lit(0).alias("lost_flag"),
        )
        triaged = case_times(sla_evaluation(case_triage(base)))
        flags = ["delayed_flag", "no_scan_flag", "damaged_flag", "lost_flag"]
        return triaged.withColumnsRenamed({c: f"shipment_{c}" for c in flags})

    # --- telemetry ---

    @cached_property
    def app_events(self) -> DataFrame:
        purchase = F.col("event_type") == "purchase"
        return self.raw("events").select(
            "event_id",
            F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            lookup("event_type", EVENT_TYPES).alias("event_type"),
            F.col("ts").alias("event_ts"),
            F.col("user_id").alias("customer_id"),
            F.when(purchase, F.col("event_id")).alias("order_id"),
            F.when(purchase, F.col("value")).alias("event_value_eur"),
        )

    @cached_property
    def reconciliation(self) -> DataFrame:
        """Orders against the orders that have lines, per order day, stored once.

        Both feeds come from one join on the order, which is also where the lines get their order day.
        """
        orders = self.orders.select("order_id", F.to_date("order_ts").alias("date"), "order_total_eur")
        paid = self.payments.select("order_id", F.col("payment_amount_eur").alias("paid"), F.lit(1).alias("seen"))
        rows = orders.join(paid, "order_id", "left")
        expected = rows.select("date", F.col("order_id").alias("id"), F.col("order_total_eur").alias("amount"))
        observed = rows.where(F.col("seen") == 1).select("date", F.col("order_id").alias("id"), F.col("paid").alias("amount"))
        return self._stored(reconciliation.daily_reconciliation(expected, observed, DAYS), "reconciliation")

    # --- enriched models ---

    @cached_property
    def orders_enriched(self) -> DataFrame:
        own = ["customer_segment", "acquisition_channel", "signup_date", "account_status"]
        places = [F.col("country").alias(c) for c in ("destination_country", "customer_country")]
        wide = self.order_heads.join(self.customers.select("customer_id", *own, *places), "customer_id", "left")
        return silver.orders_enriched(wide, None, self.order_facts)

    @cached_property
    def stored_orders(self) -> DataFrame:
        """Enriched orders as a stored table: marts then read only the columns they need."""
        return self._stored(self.orders_enriched, "orders_enriched")

    @cached_property
    def shipments_enriched(self) -> DataFrame:
        return silver.shipments_enriched(self.stored_shipments, self.stored_orders, self.hubs, self.carriers)

    @cached_property
    def stored_enriched(self) -> DataFrame:
        return self._stored(self.shipments_enriched, "shipments_enriched")

    @cached_property
    def support_enriched(self) -> DataFrame:
        return silver.support_enriched(self.cases, self.stored_enriched)

    @cached_property
    def funnel(self) -> DataFrame:
        return silver.app_funnel_daily(self.app_events)

    # --- controls ---

    @cached_property
    def key_controls(self) -> DataFrame:
        """All controls that one tagged census of the role tables answers, stored once."""
        linked = F.col("order_id").isNotNull()

        def rules(key: str, fields: list[str]) -> quality.TableRules:
            return quality.TableRules([key], fields, fields)

        tables = {
            "orders": (self.order_heads, rules("order_id", ORDER_FIELDS)),
            "order_items": (self.order_items, rules("order_item_id", ITEM_FIELDS)),
            "payments": (self.payments, rules("payment_id", PAYMENT_FIELDS)),
            "shipments": (self.stored_shipments, rules("shipment_id", SHIPMENT_FIELDS)),
            "tracking_events": (self.tracking, rules("event_id", TRACKING_FIELDS)),
            "support_cases": (self.cases, rules("case_id", CASE_FIELDS)),
            "app_events": (self.app_events, rules("event_id", EVENT_FIELDS)),
        }
        references = [
            quality.Reference("payments", "orders", "order_id"),
            quality.Reference("shipments", "orders", "order_id"),
            quality.Reference("app_events", "orders", "order_id", linked),
            quality.Reference("tracking_events", "shipments", "shipment_id"),
            quality.Reference("support_cases", "shipments", "shipment_id"),
        ]
        steps = {"support_cases": ["created_ts", "first_response_ts", "resolved_ts"]}
        return self._stored(quality.census_controls(tables, references, steps), "key_controls")

    @cached_property
    def logistics_controls(self) -> DataFrame:
        """Controls of the logistics domains: the trust verdict reads only these."""
        return self.key_controls.where(F.col("domain").isin(*quality.LOGISTICS_DOMAINS))

    @cached_property
    def controls(self) -> DataFrame:
        """All controls over the role tables, stored once: health, summary and trust read them."""
        ordered = self.stored_shipments.join(self.order_heads.select("order_id", "order_ts"), "order_id", "left")
        steps = ["order_ts", "shipment_created_ts", "delivery_ts"]
        frames = [
            self.key_controls,
            quality.amount_control(self.order_heads, self.payments),
            quality.chronology_control(ordered, steps, "SHIPMENT_CHRONOLOGY", "orders"),
            reconciliation.reconciliation_control(self.reconciliation),
        ]
        return self._stored(quality.union_controls(frames), "controls")

    @cached_property
    def logistics_trust(self) -> DataFrame:
        verdict = quality.domain_trust(self.logistics_controls)
        if self.trusted is None:
            return verdict
        failures = F.lit(0 if self.trusted else 1).cast("bigint")
        return verdict.withColumns({"failures": failures, "trusted": F.lit(int(self.trusted))})

    # --- detection ---

    @cached_property
    def windows(self) -> DataFrame:
        return anomaly.scored_windows(self.stored_shipments, RULES)

    @cached_property
    def candidates(self) -> DataFrame:
        """Numbered candidates after overlap removal, stored once for all later joins."""
        kept = anomaly.drop_overlaps(anomaly.window_candidates(self.windows, RULES))
        return self._stored(anomaly.candidate_ids(kept), "candidates")

    @cached_property
    def support_cells(self) -> DataFrame:
        """Case sums per hub and day, stored once; made in shares of the shipments where these are many."""
        shares = anomaly.support_shares(self.stored_shipments, self.cases, self._shares())
        stored = self._stored_parts(shares, "support_cells")
        return stored if len(shares) == 1 else anomaly.joined_cells(stored)

    @cached_property
    def incidents(self) -> DataFrame:
        """Business incidents with their support impact, stored once."""
        records = anomaly.incident_records(
            self.candidates, self.hubs, self.stored_shipments, self.cases, self.logistics_trust, self.support_cells
        )
        return self._stored(records, "incidents")

    @cached_property
    def analysis_days(self) -> DataFrame:
        """Incident days and their baselines, stored: their true size decides how they are joined."""
        return self._stored(rootcause.analysis_days(self.incidents), "analysis_days")

    @cached_property
    def carrier_facts(self) -> DataFrame:
        """Additive facts per incident, period and carrier, stored once for three consumers."""
        shares = rootcause.carrier_shares(self.stored_shipments, self.analysis_days, self._shares())
        stored = self._stored_parts(shares, "carriers")
        return stored if len(shares) == 1 else rootcause.joined_periods(stored)

    @cached_property
    def period_metrics(self) -> DataFrame:
        return rootcause.period_metrics(self.carrier_facts)

    @cached_property
    def cause_verdict(self) -> DataFrame:
        contribution = rootcause.carrier_contribution(self.carrier_facts)
        scores = rootcause.cause_scores(
            self.period_metrics,
            rootcause.carrier_spread(contribution),
            rootcause.network_seasonality(self.stored_shipments, self.analysis_days),
            self.logistics_trust,
        )
        return rootcause.cause_verdict(scores)

    @cached_property
    def support_periods(self) -> DataFrame:
        return rootcause.support_periods(self.stored_shipments, self.cases, self.analysis_days, self.support_cells)

    @cached_property
    def cause_reports(self) -> DataFrame:
        return rootcause.cause_reports(self.incidents, self.cause_verdict, self.period_metrics, self.support_periods)

    @cached_property
    def data_incidents(self) -> DataFrame:
        return reconciliation.reconciliation_incident(self.reconciliation)

    @cached_property
    def registry(self) -> DataFrame:
        """The unified registry, stored once for briefs, views and text checks."""
        data = registry.data_records(self.data_incidents, quality.trust_summary(self.controls))
        business = registry.business_records(self.incidents, self.cause_reports)
        return self._stored(registry.incident_registry(data, business), "registry")

    @cached_property
    def briefs(self) -> DataFrame:
        return briefs.decision_briefs(self.registry)

    # --- calendar ---

    @cached_property
    def bounds(self) -> DataFrame:
        """First and last day of orders, shipments, cases and events, one row."""
        days = [
            self.raw("orders").select(F.to_date("o_orderdate").alias("d")),
            self.lines.select(F.to_date("l_shipdate").alias("d")),
            self.cases.select(F.to_date("created_ts").alias("d")),
            self.raw("events").select(F.to_date("ts").alias("d")),
        ]
        # One row per source first, so that only four rows meet.
        ends = [df.agg(F.min("d").alias("a"), F.max("d").alias("b")) for df in days]
        every = ends[0].unionByName(ends[1]).unionByName(ends[2]).unionByName(ends[3])
        return every.agg(F.min("a").alias("start_date"), F.max("b").alias("end_date"))

    @cached_property
    def named_texts(self) -> DataFrame:
        """Conversation turns that name one or two incidents by their ids, and turns that name none; some ids are unknown."""
        def named(column: Column) -> Column:
            return F.format_string("INC-%03d", F.pmod(column, F.lit(130)) + 1)

        conv, turn = F.col("conv_id"), F.col("turn")
        second = F.when(turn % 2 == 1, F.concat(F.lit("and "), named(conv + turn * 7)))
        told = F.concat_ws(" ", "text", F.lit("We looked at"), named(conv * 3 + turn * 5), second, F.lit("while data trust passed."))
        report = F.when(turn % 5 == 4, F.col("text")).otherwise(told)
        return self.raw("conversations").select("conv_id", "turn", report.alias("report"))

    @cached_property
    def named_checks(self) -> DataFrame:
        """Those turns next to every incident they name."""
        evidence = self.registry.select(
            "incident_id", "classification", F.col("detected_start_date").alias("start_date"), F.col("detected_end_date").alias("end_date"),
            "confidence_score", "primary_cause", "data_trust_status",
        )
        return grounding.validate_named(self.named_texts, evidence)

    @cached_property
    def reports(self) -> DataFrame:
        """Conversation turns as report texts about the leading incident of a class.

        User and system turns speak of the data incident, assistant turns of the business incident
        with the highest confidence. Every fourth turn states the facts, others misstate the length.
        """
        lead = (
            self.registry.groupBy("classification")
            .agg(
                F.max_by(
                    F.struct(
                        "incident_id",
                        F.col("detected_start_date").alias("start_date"),
                        F.col("detected_end_date").alias("end_date"),
                        "confidence_score",
                        "primary_cause",
                        "data_trust_status",
                    ),
                    F.struct("confidence_score", "incident_id"),
                ).alias("lead")
            )
            .select("classification", "lead.*")
        )
        kind = F.when(F.col("role") == "assistant", "BUSINESS_INCIDENT").otherwise("DATA_INCIDENT")
        turns = self.raw("conversations").withColumn("classification", kind).join(
            self._stored(lead, "leads"), "classification", "left"
        )
        facts = F.concat_ws(
            " ",
            "text",
            F.concat("incident_id", F.lit(":")),
            F.lower(F.translate("classification", "_", " ")),
            F.lit("from"),
            F.date_format("start_date", "yyyy-MM-dd"),
            F.lit("to"),
            F.date_format("end_date", "yyyy-MM-dd"),
            F.lit("with root cause"),
            F.col("primary_cause"),
            F.lit("and confidence"),
            F.rint("confidence_score").cast("bigint").cast("string"),
            F.lit("; data trust"),
            F.lower("data_trust_status"),
        )
        step = F.col("turn") % 4
        report = (
            F.when(step == 0, facts)
            .when(step == 1, F.concat_ws(" ", "text", F.lit("A 7 day window is guaranteed.")))
            .when(step == 2, F.concat_ws(" ", "text", F.lit("A fourteen‑day period and a 014-day window.")))
            .otherwise(F.col("text"))
        )
        return turns.select(
            "conv_id",
            "turn",
            "incident_id",
            "classification",
            "start_date",
            "end_date",
            "confidence_score",
            "primary_cause",
            "data_trust_status",
            report.alias("report"),
        )

"""The tagged census against counting by hand, and the plans built on it."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.census import Census, Source, Use


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    parents = [(rng.randrange(40),) for _ in range(50)] + [(None,)] * 2
    children = [(str(i), 7 if rng.random() < 0.3 else rng.choice([None, *range(60)]), rng.randrange(-3, 9)) for i in range(400)]
    children += [children[0], children[0], (None, 1, None)]
    return parents, children


def build(spark, parents, children):
    up = spark.createDataFrame(parents, "k int")
    down = spark.createDataFrame(children, "id string, k bigint, v int")
    return Census([
        Source(up, [Use("thing", "up", "k")]),
        Source(
            down,
            [Use("thing", "down", "k"), Use("thing", "big", "k", F.col("v") > 5, F.col("v")), Use("line", "line", "id")],
            {"negative": F.col("v") < 0, "blank": F.col("k").isNull().cast("int") + F.col("v").isNull().cast("int")},
        ),
    ])


def test_counts_equal_counting_by_hand(spark, sides):
    parents, children = sides
    census = build(spark, parents, children)
    up, down = Counter(p[0] for p in parents), Counter(c[1] for c in children)
    big = Counter(c[1] for c in children if c[2] is not None and c[2] > 5)
    ids = Counter(c[0] for c in children)
    wanted = {
        "surplus": census.surplus("thing", "up"),
        "lines": census.surplus("line", "line"),
        "orphans": census.orphans("thing", "down", "up"),
        "many": census.keys_where("thing", census.count("thing", "down") > 3),
        "both": census.rows_where("thing", "big", census.count("thing", "up") > 0),
        "negative": census.broken("negative"),
        "blank": census.broken("blank"),
    }
    (got,) = census.totals(wanted).collect()
    assert got.asDict() == {
        "surplus": sum(n - 1 for n in up.values()),
        "lines": sum(n - 1 for n in ids.values()),
        "orphans": sum(n for k, n in down.items() if k is None or not up[k]),
        "many": sum(n > 3 for n in down.values()),
        "both": sum(n for k, n in big.items() if up[k]),
        "negative": sum(c[2] is not None and c[2] < 0 for c in children),
        "blank": sum((c[1] is None) + (c[2] is None) for c in children),
    }


def test_empty_tables_give_zeros(spark):
    census = build(spark, [], [])
    wanted = {"a": census.surplus("thing", "up"), "b": census.orphans("thing", "down", "up"), "c": census.broken("blank")}
    assert census.totals(wanted).first().asDict() == {"a": 0, "b": 0, "c": 0}


def test_each_table_is_read_once_in_two_exchanges(spark, sides):
    census = build(spark, *sides)
    plan = census.totals({"a": census.orphans("thing", "down", "up"), "b": census.broken("blank")})._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange ", plan)) == 2
    assert len(re.findall(r"Scan ", plan)) == 2


def test_unique_keys_are_not_summed_before_their_shuffle(spark, sides):
    census = build(spark, *sides)
    census.surplus("line", "line"), census.surplus("thing", "up")

    def first_sum_is_after_the_shuffle(kind):
        plan = census._pass(kind, 0, 2)._jdf.queryExecution().executedPlan().toString()
        return plan.rindex("HashAggregate") < plan.rindex("Exchange ")

    assert first_sum_is_after_the_shuffle("line")
    assert not first_sum_is_after_the_shuffle("thing")


def test_passes_count_repeated_and_missing_keys_like_one_grouping(spark, sides):
    parents, children = sides
    children = [*children, *[("hot", 7, 9)] * 300, *[(None, None, 1)] * 5, ("", 3, 2), ("", 3, 2)]

    def found(children, shares):
        census = build(spark, parents, children)
        census._shares = shares
        wanted = {"lines": census.surplus("line", "line"), "many": census.keys_where("line", census.count("line", "line") > 1),
                  "up": census.surplus("thing", "up"), "orphans": census.orphans("thing", "down", "up")}
        return census.totals(wanted).first().asDict()

    assert found(children, 5) == found(children, 1)
    assert found(children, 5)["lines"] == len(children) - len({c[0] for c in children})
    assert found([], 5) == found([], 1)


def test_controls_equal_those_taken_one_by_one(spark, frame):
    orders = frame([(1, "2024-01-01"), (1, None), (2, "2024-01-02"), (None, None)], "order_id bigint, order_ts date")
    shipments = frame([("a", 1, 0), ("a", 9, 1), ("b", None, 0), (None, 2, 1), ("c", 2, None)], "shipment_id string, order_id bigint, lost_flag int")
    tracking = frame(
        [("e1", "a", "DELIVERED", "2024-01-01 00:00:00", 3), ("e2", "a", "LOST", "2024-01-01 00:00:00", 2), ("e2", "z", "LOST", None, 1),
         ("e3", "b", "SCAN", "2024-01-01 00:00:00", 1)],
        "event_id string, shipment_id string, event_type string, event_ts timestamp_ntz, event_sequence bigint",
    )
    rules = {
        "orders": quality.TableRules(["order_id"], ["order_id", "total"], ["order_id", "order_ts", "total"]),
        "shipments": quality.TableRules(["shipment_id"], ["shipment_id"], ["shipment_id", "order_id"]),
        "tracking_events": quality.TableRules(["event_id"], ["event_id"], ["event_ts"]),
    }
    frames = {"orders": orders, "shipments": shipments, "tracking_events": tracking}
    references = [quality.Reference("shipments", "orders", "order_id"), quality.Reference("tracking_events", "shipments", "shipment_id")]
    got = quality.census_controls({n: (df, rules[n]) for n, df in frames.items()}, references)
    single = [quality.table_controls(df, n, rules[n]) for n, df in frames.items()]
    single += [quality.reference_control(shipments, "order_id", orders, "order_id", "shipments", "orders")]
    single += [quality.reference_control(tracking, "shipment_id", shipments, "shipment_id", "tracking_events", "shipments")]
    single += [quality.terminal_control(shipments, tracking)]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.union_controls(single).collect()))


def test_source_assertions_have_at_most_twelve_exchanges(spark):
    from tidemark.plans.queries import CATALOG, tables_for

    tables = tables_for(spark, "/root/testdata/sf0.001")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = CATALOG["source_assertions"](tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(re.findall(r"Exchange ", plan)) <= 12

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.joins import CardinalityError, checked_join, interval_days, missing_keys, shared_keys
from tidemark.operators.ranking import number_all, rank_in_buckets
from tidemark.operators.touches import hub_touches, incident_shipments


def test_missing_keys_counts_null_as_missing(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (None,)], "p int")
    rows = {r.key: r.child_rows for r in missing_keys(child, "k", parent, "p").collect()}
    assert rows == {1: 2, None: 2}


def test_checked_join_passes_unique_sides(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    rows = checked_join(left, right, ["k"], "left").orderBy("l").collect()
    assert [(r.l, r.r) for r in rows] == [("a", "x"), ("b", "x"), ("c", None)]


@pytest.mark.parametrize("cardinality, bad", [("many_to_one", "right"), ("one_to_one", "left"), ("one_to_many", "left")])
def test_checked_join_fails_on_duplicates(spark, cardinality, bad):
    many = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    one = spark.createDataFrame([(1, "x")], "k int, w string")
    left, right = (one, many.withColumnRenamed("v", "w2")) if bad == "right" else (many, one)
    with pytest.raises(Exception, match="duplicate key"):
        checked_join(left, right, ["k"], "inner", cardinality).collect()


def test_checked_join_keeps_null_keys_of_a_left_join(spark):
    left = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    assert checked_join(left, right, ["k"], "left", "one_to_one").count() == 3


def test_unknown_cardinality(spark):
    with pytest.raises(CardinalityError):
        checked_join(spark.range(1), spark.range(1), ["id"], "inner", "some_to_some")


def test_shared_keys_disjoint(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(3,)], "k int")
    assert shared_keys(a, b, "k").count() == 0
    assert shared_keys(a, a, "k").count() == 2


def test_rank_in_buckets_equals_row_number_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = [(1 if rng.random() < 0.5 else rng.randint(2, 9), rng.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    order = [F.col("t"), F.col("id")]
    got = rank_in_buckets(df, ["k"], F.floor(F.col("t") / 5), order, "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert sorted(got.collect()) == sorted(want.collect())


def test_number_all_equals_row_number(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(round(rng.random() * 4, 1), i) for i in range(200)], "s double, id int")
    got = number_all(df, -F.col("s"), [F.col("id")], "rn")
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("s").desc(), "id")))
    assert sorted(got.collect()) == sorted(want.collect())


SHIPMENT = "shipment_id string, origin_warehouse_id string, destination_warehouse_id string, shipment_date date"


def test_touches_count_same_hub_twice_or_once(frame):
    df = frame([("s1", "A", "B", "2024-01-01"), ("s2", "A", "A", "2024-01-01")], SHIPMENT)
    assert hub_touches(df, ["shipment_id"]).count() == 4
    assert hub_touches(df, ["shipment_id"], once=True).count() == 3


def test_incident_shipments_equal_the_range_join(frame, spark):
    rng = random.Random(11)
    hubs = "ABCD"
    rows = [(f"s{i}", rng.choice(hubs), rng.choice(hubs), f"2024-01-{rng.randint(1, 28):02d}") for i in range(300)]
    ships = frame(rows, SHIPMENT)
    incidents = frame(
        [("i1", "A", "2024-01-03", "2024-01-09"), ("i2", "A", "2024-01-09", "2024-01-12"), ("i3", "C", "2024-01-28", "2024-02-03")],
        "id string, warehouse_id string, start_date date, end_date date",
    )
    days = interval_days(incidents, "start_date", "end_date", "report_date", ["id", "warehouse_id"])
    got = incident_shipments(ships, days, ["id"])
    touches = (F.col("origin_warehouse_id") == F.col("warehouse_id")) | (
        F.col("destination_warehouse_id") == F.col("warehouse_id")
    )
    inside = F.col("shipment_date").between(F.col("start_date"), F.col("end_date"))
    want = ships.join(incidents, touches & inside).select("shipment_id", "id").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()

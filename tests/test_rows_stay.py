"""No operator may lose rows whose keys, days or parents are NULL or unknown."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import anomaly, ranking
from tidemark.operators.joins import checked_join
from tidemark.plans.bindings import SCHEMAS, Tables

TS = "2024-01-0{}T00:00:00"


def test_ranks_of_rows_with_null_keys_and_buckets(frame):
    df = frame(
        [("a", "2024-01-02", 1), ("a", None, 2), (None, "2024-01-01", 3), (None, None, 4), ("a", "2024-01-01", 5), (None, None, 6)],
        "k string, d date, id int",
    )
    got = {r.id: r.n for r in ranking.rank_in_buckets(df, ["k"], F.col("d"), [F.col("id")], "n").collect()}
    assert got == {2: 1, 5: 2, 1: 3, 4: 1, 6: 2, 3: 3}
    assert {r.n for r in ranking.number_all(df, F.col("d"), [F.col("id")], "n").collect()} == set(range(1, 7))


@pytest.mark.parametrize("how, rows", [("inner", 1), ("left", 2), ("right", 2), ("full", 3), ("outer", 3)])
@pytest.mark.parametrize("cardinality", ["one_to_one", "many_to_one", "one_to_many"])
def test_cardinality_joins_keep_null_keys_like_plain_joins(spark, how, rows, cardinality):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "c"), (None, "d")], "k int, y string")
    assert checked_join(left, right, ["k"], how, cardinality).count() == rows
    assert left.join(right, ["k"], how).count() == rows


def test_undated_touches_count_in_both_baselines(frame):
    rows = [(f"s{i}", "A", "B", None if i % 2 else "2024-01-01", 0, 1, 0.5, 10.0) for i in range(10)]
    df = frame(
        rows,
        "shipment_id string, origin_warehouse_id string, destination_warehouse_id string, shipment_date date, "
        "delayed_flag int, sla_met int, network_load_factor double, actual_transit_hours double",
    )
    base = {r.warehouse_id: r.baseline_shipments for r in anomaly.hub_baselines(df).collect()}
    windows = anomaly.hub_windows(df, anomaly.WindowRules(min_touches=1)).collect()
    assert base == {"A": 10, "B": 10}
    assert {r.warehouse_id: r.baseline_shipments for r in windows} == base


@pytest.fixture
def star(spark, tmp_path):
    """A tiny star schema with a line whose order, supplier and part are unknown."""
    rows = {
        "region": [(0, "R")],
        "nation": [(0, "N", 0), (1, "M", 0)],
        "customer": [(1, "c", 0, 1.0, "S")],
        "supplier": [(1, "s", 1, 1.0)],
        "part": [(1, "p", "b", "t", 1, 1.0)],
        "orders": [(1, 1, "F", 10.0, "2024-01-01 00:00:00", "1-URGENT"), (2, 99, "F", 10.0, "2024-01-02 00:00:00", "2-HIGH")],
        "lineitem": [
            (1, 1, 1, 1, 4.0, 10.0, 0.0, 0.0, "R", "F", "2024-01-03 00:00:00"),
            (2, 1, 1, 1, 4.0, 10.0, 0.0, 0.0, "R", "F", "2024-01-03 00:00:00"),
            (77, 9, 8, 40, 4.0, 10.0, 0.0, 0.0, "R", "O", "2024-01-03 00:00:00"),
        ],
        "events": [(1, "2024-01-01 00:00:00", 1, "purchase", 3.0, "{}")],
        "conversations": [(1, 0, "user", "t")],
    }
    for name, own in rows.items():
        fields = [part.strip().split(" ") for part in SCHEMAS[name].split(",")]
        text = ", ".join(f"{n} {'string' if t == 'timestamp_ntz' else t}" for n, t in fields)
        df = spark.createDataFrame(own, text).selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields])
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return Tables(spark, str(tmp_path))


def test_lines_without_parents_stay_and_are_counted(star):
    assert star.stored_shipments.count() == 3
    assert star.cases.count() == 3
    orphan = star.stored_shipments.where("order_id = 77").first()
    assert (orphan.origin_warehouse_id, orphan.destination_warehouse_id, orphan.carrier_id) == (None, None, 8)
    controls = {r.control_id: int(r.observed_num) for r in star.controls.collect()}
    assert controls["SHIPMENTS_ORDERS_FK"] == 1
    assert controls["PAYMENTS_ORDERS_FK"] == 1
    # No hub of the unknown supplier and none of the unknown customers: 1 origin and 2 destinations.
    assert controls["SHIPMENTS_CRITICAL_NULLS"] == 3


def test_calendar_reaches_the_last_case(star):
    # The case of line 40 opens forty days after its shipment.
    assert str(star.bounds.first().end_date) == "2024-02-12"


def test_released_tables_are_gone(star):
    files = star.stored_shipments.inputFiles()
    star.release()
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_NOT_FOUND|does not exist"):
        star.spark.read.parquet(files[0]).count()

import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import banding, calendar, geo, numeric, text
from tidemark.functions.measures import measures


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("x, places, want", [(0.285, 2, 0.28), (2.675, 2, 2.68), (-2.675, 2, -2.68), (1.25, 1, 1.3)])
def test_round_to(spark, x, places, want):
    assert value(spark, numeric.round_to(F.lit(x), places)) == want


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(-10000, 10000, places=2), min_size=1, max_size=30))
def test_exact_sum_is_exact_and_order_free(spark, amounts):
    want = float(sum(amounts))
    for rows in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(float(a),) for a in rows], "a double")
        assert df.agg(numeric.exact_sum("a")).first()[0] == want


def test_clip_keeps_null(spark):
    assert value(spark, numeric.clip(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert value(spark, numeric.clip(F.lit(7.0), 0.0, 1.0)) == 1.0
    assert value(spark, numeric.clip(F.lit(-7.0), 0.0, 1.0)) == 0.0


def test_ratios_with_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0)], "a bigint, b bigint")
    assert df.select(numeric.pct(F.col("a"), F.col("b"))).first()[0] is None
    empty = spark.createDataFrame([], "m double, n bigint")
    assert empty.agg(numeric.weighted_mean("m", "n")).first()[0] is None


def test_weighted_mean_is_not_the_mean_of_rates(spark):
    df = spark.createDataFrame([(100.0, 1), (0.0, 3)], "m double, n bigint")
    assert df.agg(numeric.weighted_mean("m", "n")).first()[0] == 25.0


def test_load_bands_differ_at_the_edges(spark):
    edges = [0.0, 0.60, 0.75, 0.90, 1.00, 1.01]
    df = spark.createDataFrame([(e,) for e in edges], "x double")
    rows = df.select(banding.load_band("x").alias("l"), banding.load_band("x", right=True).alias("r")).collect()
    assert [r.l for r in rows] == ["<60%", "60-75%", "75-90%", "90-100%", "90-100%", ">100%"]
    assert [r.r for r in rows] == [None, "<60%", "60-75%", "75-90%", "90-100%", ">100%"]


def test_issue_precedence(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 1), (0, 1, 1, 1), (0, 0, 1, 1), (0, 0, 0, 1), (0, 0, 0, 0)],
        "lost_flag int, damaged_flag int, no_scan_flag int, delayed_flag int",
    )
    labels = [r[0] for r in df.select(banding.issue_category()).collect()]
    assert labels == ["Lost", "Damaged", "No Scan", "Delayed", "Normal"]


def test_fill_gap_days(spark, frame):
    df = frame([("a", "2024-01-01", 5), ("a", "2024-01-04", 2), ("b", "2024-02-01", 1)], "k string, d date, n bigint")
    rows = calendar.fill_gap_days(df, ["k"], "d", ["n"]).orderBy("k", "d").collect()
    assert [(r.k, r.d.day, r.n) for r in rows] == [("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("a", 4, 2), ("b", 1, 1)]


def test_date_attributes_match_python(spark):
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=i) for i in range(0, 1500, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date").withColumns(calendar.date_attributes("d"))
    for r in df.collect():
        assert r.week_number == r.d.isocalendar().week
        assert r.weekend_flag == int(r.d.weekday() >= 5)
        assert (r.day_name, r.month_name) == (r.d.strftime("%A"), r.d.strftime("%B"))


def test_empty_day_series(spark):
    series = calendar.day_series(F.lit("2024-01-02").cast("date"), F.lit("2024-01-01").cast("date"))
    assert value(spark, series) == []


def test_wall_micros_orders_like_the_timestamp(spark, frame):
    df = frame([("2024-03-31 02:30:00.000001",), ("2024-03-31 02:30:00.5",), ("1969-12-31 23:59:59",)], "t timestamp_ntz")
    rows = df.orderBy("t").select(calendar.wall_micros("t")).collect()
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert rows[0][0] == -1_000_000


def test_haversine_known_distance(spark):
    km = value(spark, geo.haversine_km(F.lit(52.52), F.lit(13.405), F.lit(48.8566), F.lit(2.3522)))
    assert abs(km - 877.5) < 1


@pytest.mark.parametrize(
    "report, want",
    [
        ("a 7-day window", ["7"]),
        ("a 7 day period and 14days  window", ["7", "14"]),
        ("six-day window, then a 007 day window", ["7", "6"]),
        ("seven day shift", []),
        ("a 123456789012345678901234567890 day period", ["123456789012345678901234567890"]),
        ("0 day window", ["0"]),
    ],
)
def test_stated_durations(spark, report, want):
    assert value(spark, text.stated_durations(F.lit(report))) == want


def test_split_list(spark):
    assert value(spark, text.split_list(F.lit(" a | | b|"))) == ["a", "b"]
    assert value(spark, text.split_list(F.lit(None).cast("string"))) == []


def test_number_text(spark):
    assert value(spark, text.number(F.lit(None).cast("double"))) == "n/a"
    assert value(spark, text.number(F.lit(1.005), signed=True)) == "+1.00"


def test_hash_share_is_stable_and_even(spark):
    shares = [r[0] for r in spark.range(4000).select(numeric.hash_share("id", "x")).collect()]
    assert shares == [r[0] for r in spark.range(4000).repartition(3).orderBy("id").select(numeric.hash_share("id", "x")).collect()]
    assert 0 <= min(shares) and max(shares) < 1
    assert abs(sum(s < 0.42 for s in shares) / 4000 - 0.42) < 0.03


def test_measures_have_unique_names(spark):
    for mart in ("executive", "commerce", "logistics", "reliability", "support", "incidents"):
        assert len(measures(mart)) >= 4


def test_random_bands_cover_every_value(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.random() * 2,) for _ in range(200)], "x double")
    assert df.where(banding.load_band("x").isNull()).count() == 0

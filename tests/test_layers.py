"""Monthly layers: a refresh rebuilds the changed months and no others, and survives failed runs."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources.layers import MonthlyLayer, month_of


def rows(spark, day, values):
    return spark.createDataFrame([(day, v) for v in values], "day string, v bigint").withColumn("day", F.col("day").cast("date"))


def build(df):
    return df.groupBy(month_of("day").alias("month"), "day").agg(F.sum("v").alias("total"))


@pytest.fixture
def layer(spark, tmp_path):
    folder = tmp_path / "source"
    for name, day, values in [("a", "2024-01-05", [1, 2]), ("b", "2024-02-01", [5]), ("c", None, [7])]:
        rows(spark, day, values).coalesce(1).write.parquet(str(folder / f"part={name}"))
    found = MonthlyLayer(spark, f"layers_{tmp_path.name.replace('-', '_')}.totals", str(tmp_path / "layer"), str(folder), "day", build)
    yield found
    spark.sql(f"DROP DATABASE IF EXISTS {found.table.split('.')[0]} CASCADE")


def content(layer):
    return sorted((str(r.day), r.total, r.month) for r in layer.read().collect())


def times(layer):
    return {r.month: r.written_at for r in layer.file_times().collect()}


def full(layer, spark):
    return sorted((str(r.day), r.total, r.month) for r in build(spark.read.parquet(layer.source)).collect())


def test_first_run_builds_all_and_the_next_nothing(layer, spark):
    assert layer.refresh() == ["2024-01", "2024-02", "none"]
    assert content(layer) == full(layer, spark) == [("2024-01-05", 3, "2024-01"), ("2024-02-01", 5, "2024-02"), ("None", 7, "none")]
    before = times(layer)
    assert layer.refresh() == []
    assert times(layer) == before


def test_changed_new_and_vanished_files(layer, spark):
    layer.refresh()
    before = times(layer)
    # A file moves from one month to another: both are rebuilt, the old one is empty afterwards.
    rows(spark, "2024-03-09", [5, 6]).coalesce(1).write.mode("overwrite").parquet(f"{layer.source}/part=b")
    rows(spark, "2024-01-20", [9]).coalesce(1).write.parquet(f"{layer.source}/part=d")
    assert layer.refresh() == ["2024-01", "2024-02", "2024-03"]
    assert content(layer) == full(layer, spark)
    after = times(layer)
    assert after["none"] == before["none"] and after["2024-01"] > before["2024-01"] and "2024-02" not in after
    rows(spark, "2024-03-09", []).coalesce(1).write.mode("overwrite").parquet(f"{layer.source}/part=c")
    assert layer.refresh() == ["none"]
    assert content(layer) == full(layer, spark)


def test_a_failed_run_is_made_good_by_the_next(layer, spark):
    layer.refresh()
    rows(spark, "2024-02-01", [100]).coalesce(1).write.mode("overwrite").parquet(f"{layer.source}/part=b")

    def broken(df):
        return build(df).withColumn("total", F.raise_error(F.lit("lost executor")).cast("bigint"))

    bad = MonthlyLayer(layer.spark, layer.table, layer.root, layer.source, layer.day, broken)
    with pytest.raises(Exception, match="lost executor"):
        bad.refresh()
    assert content(layer)[1] == ("2024-02-01", 5, "2024-02")  # what was there still is
    assert layer.refresh() == ["2024-02"]
    assert content(layer) == full(layer, spark)


def test_a_manifest_without_its_mark_does_not_count(layer, spark, tmp_path):
    layer.refresh()
    (tmp_path / "layer/manifest/000000001/_SUCCESS").unlink()
    assert layer.refresh() == ["2024-01", "2024-02", "none"]
    assert layer.refresh() == []


def test_a_changed_input_rebuilds_every_month(layer, spark, tmp_path):
    names = str(tmp_path / "names")
    spark.range(3).coalesce(1).write.parquet(names)
    own = MonthlyLayer(layer.spark, layer.table, layer.root, layer.source, layer.day, build, [names])
    own.refresh()
    assert own.refresh() == []
    spark.range(4).coalesce(1).write.mode("overwrite").parquet(names)
    assert own.refresh() == ["2024-01", "2024-02", "none"]

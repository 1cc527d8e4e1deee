import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import registry
from tidemark.operators.profile import table_inventory
from tidemark.sources import readers, schemas, writers


def test_read_layer_and_inventory(spark, tmp_path):
    for name in schemas.LAYERS["silver"]:
        writers.write_parquet(spark.range(3), str(tmp_path / f"{name}.parquet"))
    frames = readers.read_layer(spark, str(tmp_path), "silver")
    assert sorted(frames) == sorted(schemas.LAYERS["silver"])
    assert spark.table("silver_daily_purchase_reconciliation").count() == 3
    rows = readers.layer_inventory(spark, str(tmp_path), "silver").collect()
    assert [(r.schema_name, r.row_count, r.column_count) for r in rows] == [("silver", 3, 1)] * 2
    assert all(r.source_path.endswith(".parquet") for r in rows)


def test_missing_dataset_and_folder(spark, tmp_path):
    with pytest.raises(readers.MissingDataset, match="warehouse_anomaly_windows"):
        readers.read_layer(spark, str(tmp_path), "silver")
    assert readers.dataset_names(spark, str(tmp_path / "nowhere")) == {}


def test_timestamps_are_normalized(spark):
    df = spark.createDataFrame([("2025-01-02 03:04:05",)], "order_ts string")
    out = readers.normalize_timestamps(df, ["order_ts", "absent"])
    assert out.schema["order_ts"].dataType.simpleString() == "timestamp_ntz"
    assert out.first().order_ts == dt.datetime(2025, 1, 2, 3, 4, 5)


def test_csv_round_trip_optional_and_required(spark, tmp_path):
    text = 'say "hi", or\nnot'
    df = spark.createDataFrame([("i1", "c", "w", dt.date(2025, 1, 1), dt.date(2025, 1, 2), 9.5, text)], (
        "candidate_incident_id string, classification string, warehouse_id string, start_date date, end_date date, "
        "anomaly_score double, evidence string"))  # fmt: skip
    path = str(tmp_path / "incidents")
    writers.write_csv(df, path)
    back = readers.read_csv(spark, path, schemas.BUSINESS_INCIDENTS, schemas.INCIDENT_COLUMNS)
    row = back.first()
    assert (row.start_date, row.anomaly_score, row.evidence, row.city) == (dt.date(2025, 1, 1), 9.5, text, None)
    assert back.columns == schemas.columns_of(schemas.BUSINESS_INCIDENTS)
    assert readers.read_csv(spark, str(tmp_path / "none"), schemas.BUSINESS_INCIDENTS, optional=True).count() == 0
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "none"), schemas.BUSINESS_INCIDENTS)
    writers.write_csv(df.drop("end_date"), path)
    with pytest.raises(readers.MissingColumns, match="end_date"):
        readers.read_csv(spark, path, schemas.BUSINESS_INCIDENTS, schemas.INCIDENT_COLUMNS)


def test_json_keeps_nulls_and_reads_arrays(spark, tmp_path):
    schema = registry.registry_schema()
    row = tuple(dt.date(2025, 1, 1) if f.dataType.simpleString() == "date" else None for f in schema)
    path = str(tmp_path / "registry")
    writers.write_json(spark.createDataFrame([row], schema), path)
    line = spark.read.text(path).first()[0]
    assert '"anomaly_score":null' in line and '"detected_start_date":"2025-01-01"' in line
    assert tuple(readers.read_json(spark, path, schema).first()) == row
    (tmp_path / "array.json").write_text('[{"a": 1, "n": {"b": ["x"]}},\n {"a": 2, "n": null}]')
    back = readers.read_json(spark, str(tmp_path / "array.json"), "a int, n struct<b:array<string>>", array=True)
    assert [(r.a, r.n.b if r.n else None) for r in back.orderBy("a").collect()] == [(1, ["x"]), (2, None)]


def test_tables_views_runs_and_inventory(spark):
    writers.create_layers(spark)
    assert writers.build_models({"m": spark.range(4)}, "gold") == {"m": "gold.m"}
    writers.build_models({"m": spark.range(2)}, "gold")
    assert spark.table("gold.m").count() == 2
    writers.build_models({"v": spark.range(5)}, "stg", as_views=True)
    assert spark.table("stg_v").count() == 5
    inventory = table_inventory({"a": spark.range(3), "b": spark.range(4)}, "bronze").unionByName(
        table_inventory({"c": spark.range(5)}, "silver")
    )
    writers.save_inventory(inventory)
    assert spark.table("meta.table_inventory").where(F.col("loaded_at").isNotNull()).count() == 3
    writers.append_run(inventory)
    writers.append_run(inventory, pipeline="second")
    rows = spark.table("meta.pipeline_runs").collect()
    assert {r.pipeline_name for r in rows} == {"build_warehouse", "second"}
    assert {(r.bronze_tables, r.silver_tables, r.total_rows) for r in rows} == {(2, 1, 12)}


def test_export_counts_while_writing(spark, tmp_path):
    counts = writers.export_marts({"x": spark.range(7), "y": spark.range(3)}, str(tmp_path), {"x": [F.desc("id")]})
    assert {r.mart: r.rows for r in counts.collect()} == {"x": 7, "y": 3}
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).count() == 7


def test_markdown_blocks_keep_their_order(spark, tmp_path):
    df = spark.createDataFrame([("b", "two"), ("a", "one")], "id string, markdown string")
    writers.write_text(df, "markdown", str(tmp_path / "md"), ["id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "md").glob("part-*")))
    assert text == "one\n\ntwo\n\n"


def test_pass_through_keeps_unchanged_frames(spark):
    a, b, c = spark.range(1), spark.range(2), spark.range(3)
    out = writers.pass_through({"a": a, "b": b}, {"b": c})
    assert out["a"] is a and out["b"] is c


def test_materialize_keeps_rows_and_cuts_the_plan(spark):
    df = spark.range(100).withColumn("m", F.create_map(F.lit("k"), F.col("id")))
    stored = session.materialize(df, "t")
    assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_stored_frames_can_be_removed(spark):
    stored = session.materialize(spark.range(5), "label/t")
    path = stored.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    session.remove_stored(spark, "label")
    assert not os.path.exists(path)


def test_snapshot_notices_changed_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "b.parquet"))
    before = session.snapshot(spark, str(tmp_path), ["a", "b"])
    assert session.snapshot(spark, str(tmp_path), ["a", "b"]) == before
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "b.parquet"))
    assert session.snapshot(spark, str(tmp_path), ["a", "b"]) != before


def test_unreadable_csv_is_an_error_even_where_it_is_optional(spark, tmp_path):
    (tmp_path / "x").mkdir()
    with pytest.raises(Exception, match="nosuchscheme"):
        readers.read_csv(spark, "nosuchscheme+://x", schemas.BUSINESS_INCIDENTS, optional=True)
    with pytest.raises(AnalysisException):
        readers.read_csv(spark, str(tmp_path / "x"), schemas.BUSINESS_INCIDENTS, optional=True)

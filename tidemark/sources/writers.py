"""Writing tables, exports, briefs and the run log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYERS = ["bronze", "silver", "gold", "meta"]
RUNS = (
    "run_id string, run_ts timestamp, pipeline_name string, status string, "
    "bronze_tables bigint, silver_tables bigint, total_rows bigint"
)


def create_layers(spark: SparkSession) -> None:
    """One catalog namespace per layer."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def save_table(df: DataFrame, layer: str, name: str, partition_by: str | None = None) -> str:
    """Replace a catalog table; marts with many days can be partitioned, by month say."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(f"{layer}.{name}")
    return f"{layer}.{name}"


def build_models(models: dict[str, DataFrame], layer: str, as_views: bool = False) -> dict[str, str]:
    """Staging models become views, all others tables."""
    if not as_views:
        return {name: save_table(df, layer, name) for name, df in models.items()}
    for name, df in models.items():
        df.createOrReplaceTempView(f"{layer}_{name}")
    return {name: f"{layer}_{name}" for name in models}


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, sort_by: list | None = None) -> None:
    """CSV with header, one file per task; sorted over all files when asked."""
    ordered = df.orderBy(*sort_by) if sort_by else df
    ordered.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; NULL fields are kept and dates read ``yyyy-MM-dd``."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", False).option("dateFormat", "yyyy-MM-dd")
    writer.json(path)


def write_text(df: DataFrame, column: str, path: str, sort_by: list) -> None:
    """One text block per row, in order."""
    df.orderBy(*sort_by).select(column).write.mode("overwrite").option("lineSep", "\n\n").text(path)


def export_marts(marts: dict[str, DataFrame], folder: str, sort_by: dict[str, list] | None = None) -> DataFrame:
    """Export every mart as CSV; row counts are taken while writing, not by a second read.

    The count sits above the sort: below it, the pass that samples the sort ranges would count too.
    """
    rows = []
    for name, df in marts.items():
        seen = Observation(f"export_{name}")
        order = (sort_by or {}).get(name)
        counted = (df.orderBy(*order) if order else df).observe(seen, F.count(F.lit(1)).alias("rows"))
        write_csv(counted, f"{folder.rstrip('/')}/{name}")
        rows.append((name, int(seen.get["rows"])))
    spark = next(iter(marts.values())).sparkSession
    return spark.createDataFrame(rows, "mart string, rows bigint")


def pass_through(frames: dict[str, DataFrame], changed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Next layer's tables: the changed ones, and the others as they are, without a copy."""
    return {**frames, **changed}


def save_inventory(inventory: DataFrame, name: str = "meta.table_inventory") -> None:
    """Replace the inventory table with this load's rows, stamped with the load time."""
    inventory.withColumn("loaded_at", F.current_timestamp()).write.mode("overwrite").saveAsTable(name)


def run_row(inventory: DataFrame, pipeline: str = "build_warehouse", status: str = "SUCCESS") -> DataFrame:
    """One run-log row with table counts per layer and the total of rows."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmss'Z'")
    return inventory.agg(
        F.concat(F.lit("RUN-"), stamp).alias("run_id"),
        F.current_timestamp().alias("run_ts"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(status).alias("status"),
        F.count_if(F.col("schema_name") == "bronze").alias("bronze_tables"),
        F.count_if(F.col("schema_name") == "silver").alias("silver_tables"),
        F.sum("row_count").alias("total_rows"),
    )


def append_run(inventory: DataFrame, name: str = "meta.pipeline_runs", **labels: str) -> None:
    run_row(inventory, **labels).write.mode("append").saveAsTable(name)

"""Exports in one global order, and the proof that they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, keys: list[str]) -> None:
    """Parquet files that are sorted and follow one another: ranges of the keys by sampled borders, each sorted by its task."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def file_borders(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Per file: its number, rows, first and last key, and rows whose key is below that of the row before. NULLs come first."""
    rows = spark.read.parquet(path).select(
        F.struct(*keys).alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    checked = rows.withColumn("falls", F.coalesce(F.col("key") < before, F.lit(False)).cast("int"))
    return checked.groupBy("file").agg(
        F.first(F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")).alias("number"),
        F.count(F.lit(1)).alias("rows"),
        F.min_by("key", "at").alias("first"),
        F.max_by("key", "at").alias("last"),
        F.sum("falls").alias("falls"),
    )


def verify_order(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """``files``, ``rows``, ``sorted`` (1 or 0): order within every file, and across the border to the next non-empty one."""
    borders = file_borders(spark, path, keys)
    # One row per file.
    before = F.lag("last").over(Window.orderBy("number", "file"))
    crossed = borders.withColumn("crossed", F.coalesce(F.col("first") < before, F.lit(False)).cast("int"))
    wrong = F.coalesce(F.sum(F.col("falls") + F.col("crossed")), F.lit(0))
    return crossed.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), (wrong == 0).cast("int").alias("sorted")
    )

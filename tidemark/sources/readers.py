"""Reading named datasets of a layer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import missing_names
from tidemark.operators.profile import table_inventory
from tidemark.sources.schemas import LAYERS, TABLES, columns_of


class MissingDataset(FileNotFoundError):
    """An expected dataset of a layer is not there."""


class MissingColumns(ValueError):
    """A source lacks columns that its readers need."""


def dataset_names(spark: SparkSession, folder: str) -> dict[str, str]:
    """Parquet datasets directly under a folder, by name without suffix, sorted.

    The listing goes through Hadoop's file system, so any store that Spark reads works.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return {n.removesuffix(".parquet"): f"{folder.rstrip('/')}/{n}" for n in sorted(names) if n.endswith(".parquet")}


def require_datasets(found: Iterable[str], wanted: Iterable[str], layer: str) -> None:
    missing = missing_names(set(wanted), set(found))
    if missing:
        raise MissingDataset(f"{layer}: missing datasets: {', '.join(missing)}")


def require_columns(df: DataFrame, columns: Iterable[str], source: str) -> DataFrame:
    missing = missing_names(set(columns), set(df.columns))
    if missing:
        raise MissingColumns(f"{source} is missing columns: {', '.join(missing)}")
    return df


def normalize_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast the listed columns that exist to zone-free timestamps."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns if c in df.columns})


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_table(spark: SparkSession, layer: str, name: str, path: str) -> DataFrame:
    """One dataset of a layer, timestamps normalized, registered as the view ``layer_name``."""
    times = columns_of(TABLES[name], "timestamp_ntz") if name in TABLES else []
    df = normalize_timestamps(read_parquet(spark, path), times)
    df.createOrReplaceTempView(f"{layer}_{name}")
    return df


def read_layer(spark: SparkSession, folder: str, layer: str) -> dict[str, DataFrame]:
    """Every dataset of a layer; an expected one that is missing is an error."""
    paths = dataset_names(spark, folder)
    require_datasets(paths, LAYERS.get(layer, ()), layer)
    return {name: read_table(spark, layer, name, path) for name, path in paths.items()}


def layer_inventory(spark: SparkSession, folder: str, layer: str) -> DataFrame:
    """Row and column counts of every dataset of a layer."""
    return table_inventory(read_layer(spark, folder, layer), layer, dataset_names(spark, folder))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, required: Iterable[str] = (), optional: bool = False
) -> DataFrame:
    """CSV with a header, columns matched by name. A missing optional file reads as an empty table.

    Only a path that is not there counts as missing; a file that cannot be read is an error.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        header = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if not optional or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    require_columns(header, required, path)
    by_name = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in header.columns])
    df = spark.read.schema(by_name).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    known = [F.col(f.name) if f.name in header.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*known)


def read_json(spark: SparkSession, path: str, schema: T.StructType, array: bool = False) -> DataFrame:
    """JSON lines, or with ``array=True`` one JSON array of records per file."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, required: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Files that hold one JSON array of records each: the records that fit, and the rejected ones.

    Records that fit have the schema's columns, ``file`` and ``position`` (from 0). Rejected ones have ``file``, ``position``,
    ``reason`` and the record's ``text``: not an object, a field of another type, or a required field that is missing or null.
    A file that is no array is rejected whole, at position -1. A file is read by one task.
    """
    files = spark.read.text(path, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    # As a field of an object, an array with anything behind it does not parse; alone, what is behind it would be passed over.
    options = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    wrapped = F.from_json(F.concat(F.lit('{"items":'), "value", F.lit("}")), "items array<string>, _corrupt string", options)
    held = files.select(name.alias("file"), F.col("value").alias("whole"), wrapped.alias("w")).select("file", "whole", "w.*")
    bare = F.regexp_replace("whole", r"^\s+|\s+$", "")
    whole = F.col("items").isNull() | F.col("_corrupt").isNotNull() | ~bare.startswith("[") | ~bare.endswith("]")
    split = held.where(~whole).select("file", F.posexplode("items").alias("position", "text"))
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = split.withColumn("record", F.from_json("text", marked, options))
    absent = F.filter(
        F.array(*[F.when(F.col(f"record.`{c}`").isNull(), F.lit(c)) for c in required], F.lit(None).cast("string")), lambda c: c.isNotNull()
    )
    reason = (
        F.when(F.col("text").isNull() | ~F.ltrim("text").startswith("{"), "not an object")
        .when(F.col("record").isNull() | F.col("record._corrupt").isNotNull(), "a field does not fit")
        .when(F.size(absent) > 0, F.concat(F.lit("missing "), F.array_join(absent, ", ")))
    )
    judged = parsed.withColumn("reason", reason)
    fit = judged.where(F.col("reason").isNull()).select(*[F.col(f"record.`{f.name}`").alias(f.name) for f in schema], "file", "position")
    rejected = judged.where(F.col("reason").isNotNull()).select("file", "position", "reason", "text")
    broken = held.where(whole).select("file", F.lit(-1).alias("position"), F.lit("not an array").alias("reason"), F.col("whole").alias("text"))
    return fit, rejected.unionByName(broken)

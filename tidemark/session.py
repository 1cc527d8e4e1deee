"""Session settings and lineage cuts shared by the plans."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive settings the plans count on. Partition counts, memory and broadcast limits stay with the cluster.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Spark's setting under which a job's shuffle files go when the job ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Inputs of more bytes than this are worked on part by part, so that only a part of what they shuffle is on disk at a time.
LARGE = 100_000_000


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive rules that split hot join keys and shrink small shuffles."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one below the warehouse, which is shared as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stored").rstrip("/")


def _layer(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to."""
    return f"{_layer(spark, name)}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once in the shared folder and read it back.

    The stored copy cuts the lineage, survives lost executors, and gives the optimizer true file
    sizes, so a small result is broadcast by its measured size and a large one is not. ``name`` may
    have a label in front (``label/name``); ``remove_stored`` deletes all copies of a label.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within this, what a job shuffles is deleted when the job ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize_parts(parts: list[DataFrame], name: str) -> DataFrame:
    """Like ``materialize``, for a table that comes as frames of one schema.

    They are written one after the other, and what one shuffles is deleted before the next begins. The copy is
    compressed with zstd, as such tables are large and few columns of them are read at a time.
    """
    spark = parts[0].sparkSession
    path = new_folder(spark, name)
    with shuffles_deleted(spark):
        for part in parts:
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


def input_bytes(*frames: DataFrame) -> int:
    """Bytes that some frames read from stored tables, as the optimizer knows them; rows given by the driver count as none."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for leaf in map(leaves.apply, range(leaves.size())):
            if leaf.nodeName().startswith(("Relation", "LogicalRelation", "DataSourceV2", "HiveTable", "InMemoryRelation")):
                total += int(str(leaf.stats().sizeInBytes()))
    return total


def remove_stored(spark: SparkSession, label: str) -> None:
    """Delete what was stored under a label, through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_layer(spark, label))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def snapshot(spark: SparkSession, folder: str, names: list[str]) -> str:
    """A short id of the files of some tables: their paths, sizes and times of change."""
    paths = [f"{folder}/{name}.parquet" for name in names]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    listed = files.select("path", "length", "modificationTime").collect()  # the driver lists them anyway
    return hashlib.sha256(str(sorted(map(tuple, listed), key=str)).encode()).hexdigest()[:12]

"""An append-only log in which a repeated write does no harm.

Every write appends its rows with the moment and a token of the attempt. Reading keeps the last attempt of each key and says
how many there were. So a job may write, fail and be run again, or two attempts may both come through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAMPS = ["written_at", "attempt"]


def append_keyed(rows: DataFrame, path: str) -> None:
    """Append the rows; nothing that is there is read or rewritten."""
    stamped = rows.withColumns({"written_at": F.current_timestamp(), "attempt": F.lit(uuid.uuid4().hex)})
    stamped.write.mode("append").parquet(path)


def read_keyed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row per key, NULL being a key of its own: the last attempt's, with the number of ``attempts``."""
    log = spark.read.parquet(path)
    columns = [c for c in log.columns if c not in _STAMPS]
    last = F.max_by(F.struct(*columns), F.struct(*_STAMPS)).alias("_row")
    kept = log.groupBy(F.col(key).alias("_key")).agg(last, F.count_distinct("attempt").alias("attempts"))
    return kept.select("_row.*", "attempts")

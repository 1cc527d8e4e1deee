"""Row numbers that stay parallel when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_in_buckets(
    df: DataFrame, keys: list[str], bucket: Column, order: list[Column], out: str
) -> DataFrame:
    """``row_number`` per key, computed as rank within (key, bucket) plus the size of earlier buckets.

    ``bucket`` must rise with ``order`` (a day for a timestamp order, say). Each task then sorts one
    bucket of one key instead of a whole key, and the running total over a key sees one row per
    bucket. Rows with a NULL key are one key and rows with a NULL bucket its first bucket; none are lost.
    """
    ranked = df.withColumn("_bucket", bucket)
    sizes = ranked.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    named = {key: f"_of_{i}" for i, key in enumerate([*keys, "_bucket"])}
    offsets = sizes.select(
        *[F.col(key).alias(name) for key, name in named.items()],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in named.items()]
    joined = ranked.withColumn("_rank", F.row_number().over(within)).join(offsets, same)
    return joined.select(*df.columns, (F.col("_before") + F.col("_rank")).alias(out))


def number_all(df: DataFrame, bucket: Column, order: list[Column], out: str) -> DataFrame:
    """Row number over the whole frame, by the same two steps.

    The running total sees one row per distinct bucket value, so choose a bucket with a known small
    range: a score rounded to two decimals, a calendar day.
    """
    keyed = rank_in_buckets(df.withColumn("_all", F.lit(1)), ["_all"], bucket, order, out)
    return keyed.drop("_all")


def numbered_id(prefix: str, ordinal: Column | str) -> Column:
    return F.format_string(f"{prefix}%03d", ordinal)

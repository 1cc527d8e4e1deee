"""Exact distinct sets as a mart column that adds up over any filter.

Ids fall into buckets of 32,768. A cell's ids of a bucket are kept as positions where they are few and as a bitmap beyond
``SPARSE`` ids, so a cell with one id costs a few bytes and one with millions a bit each. Sets are united, never summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Up to so many ids of a bucket are listed; a bitmap has 4096 bytes.
SPARSE = 1024


def distinct_sets(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per cell of ``keys`` and bucket of ids: ``bucket``, and ``positions`` or ``bits``. NULL ids are in no set.

    ``column`` is a whole number. Repeated ids are taken out before sets are built, so a hot cell is pre-aggregated.
    """
    ids = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("bigint").alias("_id")).distinct()
    placed = ids.select(*keys, F.bitmap_bucket_number("_id").alias("bucket"), F.bitmap_bit_position("_id").alias("_at"))
    sets = placed.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.bitmap_construct_agg("_at").alias("bits"),
        F.collect_list(F.col("_at").cast("int")).alias("positions"),
    )
    few = F.col("_n") <= SPARSE
    return sets.select(*keys, "bucket", F.when(few, F.array_sort("positions")).alias("positions"), F.when(~few, F.col("bits")).alias("bits"))


def distinct_counts(sets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact number of different ids of all sets of each group of ``keys`` (columns of the mart or made of them)."""
    listed = sets.where(F.col("positions").isNotNull()).select(*keys, "bucket", F.explode("positions").alias("_at"))
    from_lists = listed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.col("_at").cast("bigint")).alias("bits"))
    dense = sets.where(F.col("bits").isNotNull()).select(*keys, "bucket", "bits")
    united = from_lists.unionByName(dense).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))

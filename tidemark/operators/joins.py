"""Joins with declared cardinality, key-set checks and the hub/day interval join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_series


class CardinalityError(ValueError):
    """A join side declared unique is not, or the declaration is unknown."""


def one_row_per_key(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The rows with a non-NULL key, failing at run time when a key occurs twice. NULL keys join nothing.

    The check rides on a grouping by the join key, so the join that follows reuses its shuffle. With
    one row per key, any value of a column is the value of that row.
    """
    rest = [c for c in df.columns if c not in keys]
    keyed = df.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys))).groupBy(*keys)
    counted = keyed.agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    message = F.concat(F.lit(f"{label}: duplicate key "), F.to_json(F.struct(*keys)))
    # A filter, so that the check runs whatever columns are read later.
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return counted.where(single).select(*df.columns)


def checked_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", cardinality: str = "many_to_one"
) -> DataFrame:
    """Equi-join that fails when a side declared "one" holds a key twice.

    Rows whose key is NULL match nothing and are kept unmatched on every side that the join type keeps.
    """
    if cardinality not in {"one_to_one", "many_to_one", "one_to_many"}:
        raise CardinalityError(f"unknown cardinality {cardinality!r}")

    def unique(side: DataFrame, label: str, kept: bool) -> DataFrame:
        rows = one_row_per_key(side, on, label)
        nulls = side.where(F.expr(" or ".join(f"`{k}` is null" for k in on)))
        return rows.unionByName(nulls) if kept else rows

    kind = how.replace("_", "").removesuffix("outer")
    if cardinality.endswith("to_one"):
        right = unique(right, "right side", kind in {"right", "full"} or how == "outer")
    if cardinality.startswith("one_to"):
        left = unique(left, "left side", kind != "inner")
    return left.join(right, on, how)


def missing_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys that no parent row has, with their row counts. A NULL key counts as missing.

    The child is counted per key first, so a key that holds a third of all rows is one row by the
    time of the join.
    """
    counted = child.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(F.col(parent_column).alias("key")).where(F.col("key").isNotNull())
    return counted.join(known, "key", "left_anti")


def key_census(sides: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per key value, how many rows each side has: one narrow grouping of all sides, which answers uniqueness, orphans
    and multiplicities at once. Map-side sums make a hot key one row per task. NULL is a key of its own."""
    parts = [
        df.select(F.col(column).cast("string").alias("key"), *[F.lit(int(n == name)).alias(n) for n in sides])
        for name, (df, column) in sides.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("key").agg(*[F.sum(n).alias(n) for n in sides])


def orphan_rows(child: str, parent: str) -> Column:
    """Over a census: rows of ``child`` whose key is NULL or unknown to ``parent``."""
    lost = F.col("key").isNull() | (F.col(parent) == 0)
    return F.coalesce(F.sum(F.when(lost, F.col(child))), F.lit(0))


def surplus_of(side: str) -> Column:
    """Over a census: rows of ``side`` beyond the first of each key."""
    return F.coalesce(F.sum(F.greatest(F.col(side) - 1, F.lit(0))), F.lit(0))


def shared_keys(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Keys that occur on both sides; empty when the two sets are disjoint."""
    return left.select(column).distinct().join(right.select(column), column, "left_semi")


def missing_names(expected: set[str], actual: set[str]) -> list[str]:
    return sorted(set(expected) - set(actual))


def interval_days(
    intervals: DataFrame, start: str, end: str, day: str, columns: list[str | Column]
) -> DataFrame:
    """One row per interval and day it covers, both ends included."""
    return intervals.select(*columns, F.explode(day_series(F.col(start), F.col(end))).alias(day))

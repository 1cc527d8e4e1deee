"""Dataset profiles and table inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_avg, flag_pct, round_to


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each column, all columns in one pass; NULL is left out."""
    item = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    pairs = df.select(F.inline(F.array(*item))).where(F.col("value").isNotNull())
    return pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-NULL values of each column, from the same single pass."""
    return value_counts(df, columns).groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))


def table_profile(
    df: DataFrame,
    table: str,
    distinct: list[str] = (),
    shares: list[str] = (),
    means: list[str] = (),
    sums: list[str] = (),
    envelope: list[str] = (),
) -> DataFrame:
    """Long-form profile (table, metric, value): rows, distinct counts, flag shares, means, sums, dates.

    Dates are written as ``yyyy-MM-dd``, numbers with two decimals.
    """
    aggregates = {"rows": F.count(F.lit(1)).cast("string")}
    for c in shares:
        aggregates[f"{c}.share_pct"] = F.format_string("%.2f", flag_pct(c))
    for c in means:
        aggregates[f"{c}.mean"] = F.format_string("%.2f", round_to(exact_avg(c, 4), 2))
    for c in sums:
        aggregates[f"{c}.sum"] = F.sum(F.rint(F.col(c) * 100).cast("bigint")).cast("string")
    for c in envelope:
        aggregates[f"{c}.min"] = F.date_format(F.min(c), "yyyy-MM-dd")
        aggregates[f"{c}.max"] = F.date_format(F.max(c), "yyyy-MM-dd")
    names = {metric: f"m{i}" for i, metric in enumerate(aggregates)}
    row = df.agg(*[agg.alias(names[metric]) for metric, agg in aggregates.items()])
    items = [F.struct(F.lit(m).alias("metric"), F.col(n).alias("value")) for m, n in names.items()]
    profile = row.select(F.inline(F.array(*items)))
    if distinct:
        counts = distinct_counts(df, list(distinct))
        metric = F.concat("column_name", F.lit(".distinct")).alias("metric")
        profile = profile.unionByName(counts.select(metric, F.col("distinct_values").cast("string").alias("value")))
    return profile.select(F.lit(table).alias("table_name"), "metric", "value")


def table_inventory(tables: dict[str, DataFrame], schema: str, paths: dict[str, str] | None = None) -> DataFrame:
    """Schema, table, path, row count and column count of each table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("schema_name"),
            F.lit(name).alias("table_name"),
            F.lit((paths or {}).get(name)).cast("string").alias("source_path"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in sorted(tables.items())
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)

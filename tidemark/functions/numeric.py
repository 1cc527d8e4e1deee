"""Rounding, ratios and aggregates whose result does not depend on row order.

Money, load factors, hours and kilometres carry a fixed number of decimals, so they are summed as
scaled integers. A retried task or another partitioning then gives the same sum to the last bit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = 2
HOURS = 2
LOAD = 4
DISTANCE = 1


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value: Column | str, places: int) -> Column:
    """Round half away from zero on the scaled double (0.285 -> 0.28, 2.675 -> 2.68)."""
    scale = F.lit(float(10**places))
    return F.round(_col(value) * scale) / scale


def clip(value: Column | str, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (``greatest`` and ``least`` alone would skip it)."""
    value = _col(value)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is NULL)."""
    return F.when(condition, 1).otherwise(0)


def any_flag(*columns: Column | str) -> Column:
    """1 where at least one of the 0/1 columns is set."""
    return flag(reduce(lambda left, right: left + right, map(_col, columns)) > 0)


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``scale * numerator / denominator``; NULL for a zero denominator."""
    return F.lit(scale) * numerator / F.nullif(denominator, F.lit(0))


def pct(numerator: Column, denominator: Column, places: int = 2) -> Column:
    return round_to(safe_ratio(numerator, denominator, 100.0), places)


def units(value: Column | str, places: int) -> Column:
    """The value as a whole number of its smallest decimal unit."""
    return F.rint(_col(value) * F.lit(float(10**places))).cast("bigint")


def exact_sum(value: Column | str, places: int = MONEY) -> Column:
    return F.sum(units(value, places)) / F.lit(float(10**places))


def exact_avg(value: Column | str, places: int = MONEY) -> Column:
    return exact_sum(value, places) / F.nullif(F.count(_col(value)), F.lit(0))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value: Column | str, places: int = MONEY) -> Column:
    return exact_sum(F.when(condition, _col(value)).otherwise(F.lit(0.0)), places)


def flag_pct(flag_column: Column | str, places: int = 2) -> Column:
    """Share of rows with the 0/1 flag set, in percent."""
    return round_to(F.avg(_col(flag_column)) * 100, places)


def weighted_mean(value: Column | str, weight: Column | str, places: int = 2) -> Column:
    """Mean of pre-aggregated rates weighted by their row counts; never a plain sum of percentages."""
    value, weight = _col(value), _col(weight)
    return exact_sum(value * weight, places) / F.nullif(F.sum(weight), F.lit(0))


def hash_share(key: Column | str, salt: str) -> Column:
    """A repeatable share in [0, 1) drawn from a row key, the same on every partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(salt), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") / F.lit(65536.0)

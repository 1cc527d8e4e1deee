"""Joining points with intervals by aligned blocks.

An interval of days is cut into the fewest blocks of 2**k days that begin at a multiple of 2**k: at most two of each size. A
point lies in one block of each size. So "day within the interval" becomes equality of (block size, block number), and the
rows that an interval sends grow with the logarithm of its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of up to 2**21 days, which is 5,700 years.
LEVELS = 22


def cover(start: Column, end: Column) -> Column:
    """Blocks (``level``, ``block``) that make up the days from ``start`` to ``end``, both ends included.

    Empty for a NULL end or an end before the start.
    """
    low, high = F.unix_date(start).cast("bigint"), F.unix_date(end).cast("bigint") + 1

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        left, right = -F.floor(-low / size), F.floor(high / size)
        odd_left, odd_right = F.pmod(left, F.lit(2)) == 1, F.pmod(right, F.lit(2)) == 1
        inner = left + odd_left.cast("bigint")
        first = F.when((left < right) & odd_left, F.struct(level.alias("level"), left.cast("bigint").alias("block")))
        last = F.when((inner < right) & odd_right, F.struct(level.alias("level"), (right - 1).cast("bigint").alias("block")))
        return F.array(first, last)

    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    blocks = F.array_compact(F.flatten(F.transform(levels, at)))
    return F.when(low < high, blocks)


def points_in_intervals(
    points: DataFrame, day: str, intervals: DataFrame, start: str, end: str, on: list[str], levels: list[int] | None = None
) -> DataFrame:
    """Inner join of points and intervals with equal ``on`` and the day within the interval; each pair comes once.

    ``levels`` limits the block sizes that points are sent to; by default they are those that the intervals use, found by a
    job over the intervals (at most ``LEVELS`` values). NULL days and NULL keys match nothing.
    """
    cut = intervals.select("*", F.inline(cover(F.col(start), F.col(end))))
    if levels is None:
        levels = sorted(r.level for r in cut.select("level").distinct().collect())
    if not levels:
        levels = [0]
    number = F.unix_date(F.col(day)).cast("bigint")
    own = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(number, k).alias("block")) for k in levels])
    sent = points.where(F.col(day).isNotNull()).select("*", F.inline(own))
    return sent.join(cut, [*on, "level", "block"]).drop("level", "block")

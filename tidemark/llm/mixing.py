"""Mixing sources to target weights by entropy balancing.

Each source has a target of words. Document rates r in [0, cap] stay as close as possible, in (bounded) entropy, to one
copy each while every source's words, sum of r * size, meet its target. The dual has one multiplier per source and the
solution is an exponential tilt by a document's words c (in units of its source's mean): r / (cap - r) = odds of one copy
* exp(multiplier * c). Newton steps on the dual, kept inside a bracket, run as one aggregation per step over the
distribution of sizes. The rates become whole copies by carrying the rounding error from each document to the next
shorter one, in blocks of one source, so that every block's words meet its share to within a short document.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, store, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: Rows of a block in which rounding errors are carried.
BLOCK_ROWS = 4096
#: Newton ends when no source is further from its target than this part of it, or after so many steps.
TOLERANCE, STEPS = 1e-9, 80
#: Multipliers beyond this are rates of 0 or cap.
_BOUND = 1e6


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")


def ranked(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order of ``column``, null last, without bringing them into one task."""
    order = F.col(column).asc_nulls_last()
    numbered = store(
        rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("id", F.monotonically_increasing_id()),
        "ranked",
    ).withColumns({"part": F.shiftright("id", 33), "row": F.col("id").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = numbered.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    joined = numbered.join(offsets, "part")
    return joined.withColumn("rank", F.col("offset") + F.col("row")).drop("id", "part", "row", "offset")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Sources with their ``target``: ``share`` of all sizes by weight, at most ``cap`` times a source's size.

    Raising the common level until the capped sources' excess has gone to the others ends at the only level that works.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = store(ranked(sources, "source").withColumn("weight", cycle[(F.col("rank") % len(weights)).cast("int")]), "sources")
    most = F.col("source_size") * F.lit(float(cap))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        capped = F.col("weight") * level > most
        got = rows.agg(
            F.sum(F.when(capped, F.col("source_size")).otherwise(0)).alias("held"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
        ).first()
        raised = (share * total - cap * got.held) / got.open if got.open else float("inf")
        if raised <= level:
            break
        level = raised
    if level == float("inf"):
        return rows.withColumn("target", most)
    return rows.withColumn("target", F.least(F.col("weight") * level, most))


def _rate(c: Column, cap: int) -> Column:
    # At a multiplier of 0 the rate is one copy.
    return F.lit(float(cap)) / (1 + (cap - 1) * F.exp(-F.least(F.lit(700.0), F.greatest(F.lit(-700.0), F.col("tilt") * c))))


def balance(sizes: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """``goals`` with ``unit`` (mean size) and the multiplier ``tilt`` of each source.

    ``sizes`` has ``source``, ``size`` and the number ``n`` of documents of that size. Sums are decimals, so a step does
    not depend on the order of rows and reruns agree.
    """
    positive = sizes.filter("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n"))
    histogram = store(positive, "sizes")
    units = histogram.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("unit"))
    state = goals.join(units, goals["source"].eqNullSafe(units["source"]), "left").drop(units["source"])
    full = F.col("target") >= cap * F.col("source_size") * (1 - TOLERANCE)
    state = state.withColumns(
        {
            "tilt": F.when(F.col("target") <= 0, -_BOUND).when(full, _BOUND).otherwise(0.0),
            "low": F.lit(-_BOUND),
            "high": F.lit(_BOUND),
            "open": (F.col("target") > 0) & ~full,
        }
    )
    state = store(state, "tilt")
    exact = lambda x: F.sum(x.cast("decimal(38,9)")).cast("double")
    for _ in range(STEPS):
        if not state.filter("open").limit(1).count():
            break
        # Any number of sources: the join is left to Spark, the histogram has one row per source and size.
        moving = state.filter("open").select(F.col("source").alias("of"), "unit", "tilt")
        cells = histogram.join(moving, histogram["source"].eqNullSafe(moving["of"]))
        c = F.col("size") / F.col("unit")
        rate = _rate(c, cap)
        sums = cells.groupBy("of").agg(
            exact(F.col("n") * rate * F.col("size")).alias("words"),
            exact(F.col("n") * rate * (1 - rate / cap) * c * F.col("size")).alias("slope"),
        )
        miss = F.col("target") - F.col("words")
        low, high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low")), F.when(miss < 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + miss / F.greatest(F.col("slope"), F.lit(1e-9))
        inside = (newton > low) & (newton < high)
        # A step that leaves the bracket goes to its middle, or outwards while one side is not known.
        middle = F.when(low <= -_BOUND, F.least(2 * high, high - 1)).when(high >= _BOUND, F.greatest(2 * low, low + 1)).otherwise((low + high) / 2)
        done = F.abs(miss) <= TOLERANCE * F.col("target")
        moved = F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle)
        step = state.join(sums, state["source"].eqNullSafe(sums["of"]), "left")
        still = F.col("open") & F.col("of").eqNullSafe(F.col("source")) & F.col("words").isNotNull() & ~done & (moved != F.col("tilt"))
        state = store(
            step.select(
                *[x for x in state.columns if x not in ("tilt", "low", "high", "open")],
                F.when(F.col("words").isNull(), F.col("tilt")).otherwise(moved).alias("tilt"),
                F.when(F.col("words").isNull(), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("words").isNull(), F.col("high")).otherwise(high).alias("high"),
                F.coalesce(still, F.lit(False)).alias("open"),
            ),
            "tilt",
        )
    return state.drop("low", "high", "open")


def carry_rounding(block: pd.DataFrame, cap: int = CAP) -> pd.DataFrame:
    """Copies of each document of a block: longest first, each takes the error that is left by those before."""
    block = block.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last")
    carried, copies = 0.0, []
    for size, times, rate in zip(block["size"], block["times"], block["rate"], strict=True):
        mass = size * times
        n = min(cap, max(0, round(rate + carried / mass))) if mass else int(rate >= 0.5)
        carried += (rate - n) * mass
        copies.append(n)
    block["copies"] = pd.array(copies, dtype="int64")
    return block


def copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP,
) -> DataFrame:
    """One row per distinct (id, source, size) of ``docs`` with ``times`` (rows like it), ``target`` and ``copies``.

    Null sources are one source, the last; null and empty texts have size 0 and are kept once at rates of a half or
    more. Rows with equal id, source and size get the same number of copies. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size")
    )
    items = store(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("times")), "items")
    totals = items.groupBy("source").agg(
        F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("n_items")
    )
    sizes = items.groupBy("source", "size").agg(F.sum("times").alias("n"))
    state = balance(sizes, targets(totals, weights, share, cap), cap).withColumnRenamed("source", "of")
    joined = items.join(state, items["source"].eqNullSafe(state["of"]))
    # A source without words has no unit; its documents count as average ones at the source's share.
    level = _rate(F.coalesce(F.col("size") / F.col("unit"), F.lit(0.0)), cap)
    blocks = F.ceil(F.col("n_items") / BLOCK_ROWS)
    placed = joined.select(
        "doc_id", "source", "size", "times", "source_size", "target",
        level.alias("rate"), F.pmod(F.xxhash64("doc_id", "size"), blocks).alias("block"),
    )
    kinds = "doc_id bigint, source string, size bigint, times bigint, source_size bigint, target double, rate double, block bigint"
    return placed.groupBy("source", "block").applyInPandas(lambda b: carry_rounding(b, cap), kinds + ", copies bigint")


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, in the columns of ``docs``."""
    taken = copies(docs, text, key, source).filter("copies > 0").select(
        F.col("doc_id").alias("k"), F.col("source").alias("s"), F.col("size").alias("n"), "copies"
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).cast("bigint").alias("a"),
        F.col(source).cast("string").alias("b"), word_count(text).alias("c"),
    )
    same = F.col("a").eqNullSafe(F.col("k")) & F.col("b").eqNullSafe(F.col("s")) & (F.col("c") == F.col("n"))
    return rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")

"""Quality rules whose cutoffs are certified on labelled documents.

All rules of a stratum are certified together. Step i of one fixed sequence gives every rule the i-th cutoff of its grid; a
document is rejected at a step if any rule rejects it. From the loosest step on, the share of good documents that a step
rejects is bounded by the exact binomial (Clopper-Pearson) bound from the labelled good documents, until one exceeds ``risk``;
a fixed sequence needs no correction of its own, and the error level is divided by the number of strata. So with probability
1 - ``level`` no stratum loses more than ``risk`` of its good documents, whichever certified step is used. Used is the one that
separates the labels best, and none that rejects no more junk than good documents. With four strata, 144 good documents
without a rejection certify a step. ``certified`` tells whether a stratum has a step in force. Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, store, text_of

RISK = 0.03
LEVEL = 0.05
#: What a rejected share of good documents weighs against the same share of others when a certified cutoff is chosen.
PRICE = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Each rule rejects documents whose measure is above its cutoff.
MEASURES = {
    "symbols": "n_symbols / n_words",
    "repeats": "n_repeat_words / n_words",
    "dup_lines": "n_dup_lines / n_lines",
    "long_words": "word_chars / n_words",
    "short_words": "n_words / word_chars",
    "capitals": "n_capitals / word_chars",
    "shouts": "n_shouts / n_words",
}
#: Fixed grids: (lowest cutoff, factor, number of cutoffs).
GRIDS = {
    "symbols": (0.01, 1.2, 32),
    "repeats": (0.01, 1.16, 32),
    "dup_lines": (0.01, 1.16, 32),
    "long_words": (3.0, 1.08, 32),
    "short_words": (0.08, 1.08, 32),
    "capitals": (0.01, 1.16, 32),
    "shouts": (0.01, 1.16, 32),
}


def cutoffs(rule: str) -> list[float]:
    low, factor, n = GRIDS[rule]
    return [round(low * factor**i, 9) for i in range(n)]


def measures(docs: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """Counts of each whole text, one row per row: words, characters, symbols, repeated lines and words.

    ``n_repeat_words`` sorts the 64-bit hashes of a text's 3-word windows with their positions, in the row itself, so
    its cost is n log n in the words of a text and nothing is exchanged. Null and empty texts have counts of 0.
    """
    base = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        text_of(text).alias("text"),
    )
    words = base.select(
        "doc_id", "stratum",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(WORD))).alias("lines"),
    )
    joined = words.select(
        "*",
        F.array_join("words", "").alias("joined"),
        F.expr(
            "if(size(words) < 3, array(), transform(sequence(0, greatest(size(words) - 3, 0)), "
            "i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))))"
        ).alias("windows"),
    )
    left = lambda chars: (F.length("joined") - F.length(F.regexp_replace("joined", chars, ""))).cast("bigint")
    counted = joined.select(
        "doc_id", "stratum",
        F.size("words").cast("bigint").alias("n_words"),
        F.length("joined").cast("bigint").alias("word_chars"),
        left("[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        left("[A-Z]").alias("n_capitals"),
        left("[!?]").alias("n_shouts"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("pairs"),
    )
    repeated = counted.withColumn(
        "at",
        F.expr(
            "array_sort(transform(filter(pairs, (p, j) -> (j > 0 and p.h = get(pairs, j - 1).h) "
            "or coalesce(p.h = get(pairs, j + 1).h, false)), p -> p.i))"
        ),
    )
    covered = F.expr(
        "coalesce(aggregate(at, named_struct('last', -9, 'total', 0L), "
        "(a, p) -> named_struct('last', p, 'total', a.total + least(3, p - a.last)), a -> a.total), 0L)"
    )
    return repeated.withColumn("n_repeat_words", covered).drop("pairs", "at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def allowed_failures(n: str, risk: float, level: Column) -> Column:
    """Most failures among ``n`` trials at which the exact upper bound of the failure rate is at most ``risk``.

    That is the largest k with P(Binomial(n, risk) <= k) <= level, or -1. The terms are summed from their logarithms.
    """
    start = F.struct(
        (F.col(n) * F.log(F.lit(1 - risk))).alias("term"), F.lit(0.0).alias("sum"), F.lit(-1).alias("most")
    )

    def step(a: Column, j: Column) -> Column:
        total = a["sum"] + F.exp(a["term"])
        term = a["term"] + F.log(F.greatest((F.col(n) - j) / (j + 1), F.lit(1e-300))) + F.log(F.lit(risk / (1 - risk)))
        most = F.when(total <= level, j).otherwise(a["most"])
        return F.struct(term.alias("term"), total.alias("sum"), most.alias("most"))

    return F.aggregate(F.sequence(F.lit(0), F.floor(F.col(n) * risk).cast("int")), start, step, lambda a: a["most"])


STEPS = 32


def above(rule: str) -> Column:
    """How many cutoffs of the rule's grid the document's measure is above."""
    measure = F.expr(MEASURES[rule])
    return F.size(F.filter(F.array(*map(F.lit, cutoffs(rule))), lambda c: F.coalesce(measure > c, F.lit(False))))


def certified(measured: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``stratum``, ``step``, ``n`` good labelled documents, ``rejected`` of them: the steps in force.

    A document is good if all its labels have quality 1. Documents that fail the base rules take no part.
    """
    marks = (
        labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("label_id"))
        .agg((F.min("quality") == 1).cast("int").alias("good"))
    )
    held = measured.filter(~base_failed()).join(marks, F.col("doc_id") == F.col("label_id"))
    cells = held.groupBy("stratum", F.greatest(*map(above, MEASURES)).alias("above")).agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    tests = (
        cells.groupBy("stratum")  # at most one row per step
        .agg(F.sum("good").alias("n"), F.sum("bad").alias("junk"), F.collect_list(F.struct("above", "good", "bad")).alias("cells"))
        .select("stratum", "n", "junk", "cells", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("step"))
        .withColumn("rejected", F.expr("aggregate(filter(cells, c -> c.above > step), 0L, (a, c) -> a + c.good)"))
        .withColumn("caught", F.expr("aggregate(filter(cells, c -> c.above > step), 0L, (a, c) -> a + c.bad)"))
    )
    strata = tests.agg(F.count_distinct("stratum").alias("strata"))
    most = (
        tests.select("stratum", "n").distinct().join(F.broadcast(strata))  # one row
        .select("stratum", allowed_failures("n", risk, F.lit(level) / F.col("strata")).alias("most"))
    )
    # Rejections grow towards the strict end, so all steps within the bound are those before the first failure.
    passed = tests.join(most, "stratum").filter("rejected <= most and junk > 0")
    gain = F.col("caught") / F.col("junk") - PRICE * F.col("rejected") / F.nullif("n", F.lit(0))
    best = passed.withColumn("gain", gain).groupBy("stratum").agg(
        F.max_by(F.struct("step", "n", "rejected", "gain"), F.struct("gain", "step")).alias("best")
    )
    return best.select("stratum", "best.*").filter("gain > 0").drop("gain")


def judged(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
    risk: float = RISK, level: float = LEVEL,
) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, ``certified``, ``rejected_by`` (rule names) and ``kept``.

    Null strata are one stratum. Without labels no step is certified and the base rules decide alone. An empty table
    gives no rows; repeated rows are judged alike; other columns are not read.
    """
    measured = store(measures(docs, text, key, stratum), "measures")
    rules = certified(measured, labels, risk, level).select("stratum", "step")
    hits = F.array_compact(F.array(*[F.when(~base_failed() & (above(r) > F.col("step")), F.lit(r)) for r in MEASURES]))
    return (
        measured.join(rules, "stratum", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("certified", F.col("step").isNotNull())
        .withColumn("rejected_by", F.array_join(hits, ","))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == ""))
        .drop("step")
    )


def judged_sql() -> str:
    """The judgement in DuckDB SQL, with the same rules and grids: positions of repeated windows, tails from lgamma."""
    steps = ", ".join(f"len(list_filter({[*map(float, cutoffs(rule))]!r}::double[], lambda c: {m} > c))" for rule, m in MEASURES.items())
    return rf"""
with w as (
  select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), v as (
  select *, array_to_string(words, '') as j,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from w
), windows as (
  select doc_id, i, count(*) over (partition by doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) as times
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)
), covered as (
  select doc_id, count(distinct q) as n from (select doc_id, unnest([i, i + 1, i + 2]) as q from windows where times > 1) group by doc_id
), counted as (
  select doc_id, stratum, len(words) as n_words, length(j) as word_chars,
    length(j) - length(regexp_replace(j, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, len(lines) as n_lines,
    length(j) - length(regexp_replace(j, '[A-Z]', '', 'g')) as n_capitals,
    length(j) - length(regexp_replace(j, '[!?]', '', 'g')) as n_shouts, coalesce(n, 0) as n_repeat_words
  from v left join covered using (doc_id)
), based as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from counted
), measured as (
  select doc_id, stratum, greatest({steps}) as above from based where not base_failed
),
marks as (
  select doc_id, min(quality) = 1 as good from labels where doc_id is not null and quality is not null group by doc_id
), tests as (
  select stratum, step, count(*) filter (good) as n, count(*) filter (not good) as junk,
    count(*) filter (good and above > step) as rejected, count(*) filter (not good and above > step) as caught
  from measured join marks using (doc_id), range(0, {STEPS}) as r(step) group by stratum, step
), certain as (
  select *, caught / junk - {PRICE} * rejected / n as gain from tests
  where junk > 0 and n > 0 and list_sum(list_transform(range(0, rejected + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1)
      - lgamma(n - k + 1) + k * ln({RISK!r}) + (n - k) * ln({1 - RISK!r})))) <= {LEVEL} / (select count(distinct stratum) from tests)
), best as (
  select stratum, step from certain where gain > 0
  qualify row_number() over (partition by stratum order by gain desc, step desc) = 1
), hit as (select distinct doc_id from measured join best using (stratum) where above > step)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and doc_id not in (select doc_id from hit) as kept, stratum in (select stratum from best) as certified
from based"""

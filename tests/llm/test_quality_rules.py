import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules
from tidemark.llm.quality_rules import MEASURES, allowed_failures, certified, cutoffs, judged, measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    joined = "".join(words)
    return (
        len(words), len(joined), sum(c in "#*$%&|<>" for c in joined), len(lines) - len(set(lines)), len(covered)
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z x y z x y z w", "é #1\né #1\n \n\n|<>&$%*",
    "a b c\r\na b c\r\n", "A b\x1cc d\x85e f", "w1 w2 w3 q w1 w2 w3 r w2 w3 q", "z " * 30_000, "\n".join(["same line here"] * 40),
]


def test_counts_equal_brute_force(documents):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in measures(documents(rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_query_counts_whole_texts(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op2_certified_rules"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r, want = got[d.doc_id], brute(d.text)
        assert tuple(r[c] for c in COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def tail(k, n, p):
    ways = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
    return sum(math.exp(ways(j) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))


@pytest.mark.parametrize("n, risk, level", [(50, 0.1, 0.05), (1000, 0.01, 1e-4), (400, 0.03, 1e-3), (20, 0.01, 0.05), (3000, 0.02, 0.05)])
def test_allowed_failures_are_the_exact_bound(spark, n, risk, level):
    most = max((k for k in range(int(n * risk) + 1) if tail(k, n, risk) <= level), default=-1)
    df = spark.createDataFrame([(n,)], "n bigint")
    assert df.select(allowed_failures("n", risk, F.lit(level))).first()[0] == most


def test_allowed_failures_of_many_trials_do_not_underflow(spark):
    df = spark.createDataFrame([(2_000_000,)], "n bigint")
    got = df.select(allowed_failures("n", 0.01, F.lit(1e-3))).first()[0]
    assert 19_000 < got < 20_000


def measured(spark, rows):
    kinds = "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_lines bigint, n_capitals bigint, n_shouts bigint, n_repeat_words bigint"
    return spark.createDataFrame([(i, s, 100, 500, sym, 0, 5, 2, 0, 0) for i, s, sym in rows], kinds)


def test_cutoffs_limit_the_rejected_good_documents(spark):
    rows = [(i, "en" if i < 6000 else "fr", i % 30) for i in range(6100)]
    # Junk in both strata, from just above the good documents on.
    rows += [(9000 + i, "en" if i % 2 else "fr", 28 + i % 8) for i in range(400)]
    marks = [(i, 1) for i in range(6100)] + [(9000 + i, 0) for i in range(400)]
    labels = spark.createDataFrame([*marks, (None, 1), (0, 1), (1, None)], "doc_id bigint, quality int")
    got = {r.stratum: r for r in certified(measured(spark, rows), labels).collect()}
    # A hundred documents certify nothing.
    assert set(got) == {"en"}
    own = got["en"]

    def joint(sym):  # the other measures are those of ``measured``, the same for all
        values = {"symbols": sym / 100, "repeats": 0, "dup_lines": 0, "long_words": 5, "short_words": 0.2, "capitals": 0.004, "shouts": 0}
        return max(sum(values[rule] > c for c in cutoffs(rule)) for rule in MEASURES)

    good = [joint(sym) for i, s, sym in rows if s == "en" and i < 9000]
    junk = [joint(sym) for i, s, sym in rows if s == "en" and i >= 9000]
    certain = [i for i in range(quality_rules.STEPS) if tail(sum(g > i for g in good), len(good), quality_rules.RISK) <= 0.05 / 2]
    gain = lambda i: sum(j > i for j in junk) / len(junk) - 5 * sum(g > i for g in good) / len(good)
    assert own.step == max(certain, key=lambda i: (gain(i), i))
    assert (own.n, own.rejected) == (6000, sum(g > own.step for g in good))


def test_four_strata_of_three_hundred_labels_are_certified(spark, documents):
    """Planted junk goes in every stratum, also where few documents are labelled; a stratum with too few is told apart."""
    rows, marks = [], []
    for s, lang in enumerate(["en", "de", "fr", "es", "it"]):
        for i in range(300 if lang != "it" else 60):
            key, bad = 1000 * s + i, i % 10 == 0
            mark = "###" if bad else ""
            rows.append((key, " ".join(f"wort{(key * 7 + k * k) % 997}{mark}" for k in range(60)), lang, "s"))
            marks.append((key, int(not bad)))
        rows += [(1000 * s + 500 + i, " ".join(f"w{(i + k * k) % 499}$$$" for k in range(60)), lang, "s") for i in range(20)]
    got = {r.doc_id: r for r in judged(documents(rows), spark.createDataFrame(marks, "doc_id bigint, quality int")).collect()}
    quality = dict(marks)
    for key, r in got.items():
        if r.stratum == "it":
            assert not r.certified and r.kept
        else:
            assert r.certified and r.kept == bool(quality.get(key, 0))
            assert r.kept or "symbols" in r.rejected_by


def test_no_labels_and_edge_rows(spark, documents):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(zip(TEXTS, ["en", None] * 8, strict=False))] + [(None, "w " * 60, "en", "s")]
    df = documents(rows).withColumn("stratum", F.lit(1)).withColumn("kept", F.lit("x"))
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    got = judged(df, labels).collect()
    assert len(got) == len(rows) and all(r.kept == (not r.base_failed) for r in got)
    assert judged(documents([]), labels).count() == 0


def test_junk_goes_and_good_stays(spark, documents):
    good = [(i, " ".join(f"word{(i * 7 + k * k) % 997}" for k in range(60)), "en", "s") for i in range(2500)]
    junk = [(5000 + i, " ".join(f"w{(i + k * k) % 499}$$$" for k in range(60)), "en", "s") for i in range(100)]
    marks = [(i, 1) for i in range(2500)] + [(5000 + i, 0) for i in range(20)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    got = {r.doc_id: r for r in judged(documents(good + junk), labels).collect()}
    assert all(got[i].kept for i, *_ in good)
    assert all(not got[i].kept and "symbols" in got[i].rejected_by for i, *_ in junk)


def test_no_python_in_the_plan(spark, documents):
    df = documents([(1, "a b c")])
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    plans = [measures(df), certified(measures(df), labels), judged(df, labels)]
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not any(x in text for x in ("EvalPython", "Pandas", "ArrowEval", "MapInArrow"))

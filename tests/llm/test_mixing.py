import re
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import mixing
from tidemark.llm.mixing import CAP, copies, mixed


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def wanted(sizes, weights=(5, 2, 1), share=1.5, cap=CAP):
    """Targets by sharing the excess of capped sources again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target = share * sum(sizes.values()), {}
    while len(target) < len(sizes):
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in names if s not in target)
        over = {s: cap * sizes[s] for s in names if s not in target and level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in names if s not in target}
        target |= over
    return target


def corpus(seed, n, sources):
    rng = np.random.default_rng(seed)
    return [
        (i, " ".join(["w"] * int(rng.lognormal(4, 1))), "en", sources[min(len(sources) - 1, int(rng.exponential(2)))])
        for i in range(n)
    ]


def by_source(rows):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += words(text)
    return sizes


@pytest.mark.parametrize("seed", range(2))
def test_targets_are_met(documents, seed):
    rows = corpus(seed, 1500, ["a", "B", "é", "", None, "z9", "z10"])
    target = wanted(by_source(rows))
    got = copies(documents(rows)).collect()
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= CAP
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        taken[r.source] += r.copies * r.size * r.times
    assert all(abs(taken[s] - t) <= max(3, 0.01 * t) for s, t in target.items())


def test_rates_solve_the_dual(documents):
    """Per source the odds of a rate are an exponential function of the size, and the expected words meet the target."""
    rows = corpus(3, 600, ["a", "b", "c"])
    got = copies(documents(rows)).collect()
    for source in "abc":
        own = [r for r in got if r.source == source and 0 < r.rate < CAP - 1e-9]
        if not own:
            continue
        assert sum(r.rate * r.size * r.times for r in got if r.source == source) == pytest.approx(own[0].target, rel=1e-6)
        slopes = [np.log(r.rate / (CAP - r.rate)) / r.size for r in own if r.size]
        assert max(slopes) - min(slopes) < 1e-6


def test_reruns_agree(documents):
    rows = corpus(5, 800, ["a", "b"])
    one = sorted(map(tuple, copies(documents(rows)).collect()))
    two = sorted(map(tuple, copies(documents(rows[::-1]).repartition(7)).collect()))
    assert [(r[0], r[-1]) for r in one] == [(r[0], r[-1]) for r in two]


def test_hot_source_is_rounded_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    rows = [(i, " ".join(["w"] * (1 + i % 40)), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(1200)]
    target = wanted(by_source(rows))
    taken = defaultdict(int)
    for r in copies(documents(rows)).collect():
        taken[r.source] += r.copies * r.size * r.times
    assert all(abs(taken[s] - t) <= 0.01 * t + 40 for s, t in target.items())


def test_edge_rows(documents, spark):
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, "x y", "en", None), (3, "x y", "en", None), (None, "p q r", "en", "a"),
        (None, "p q r", "en", "a"), (4, "w " * 50_000, "en", "b"), (5, "only spaces"[:0] + " \n", "en", "empty"),
    ]
    df = documents(rows)
    df = df.withColumn("copies", df.doc_id).withColumn("row", df.text)
    got = copies(df).collect()
    assert sum(r.times for r in got) == len(rows)
    assert {r.source for r in got} == {"a", "b", "empty", None}
    out = mixed(df)
    assert out.columns == df.columns
    expected = sum(r.times * r.copies for r in got)
    assert out.count() == expected
    assert copies(documents([])).count() == 0 and mixed(documents([])).count() == 0
    empty = copies(documents([(1, None, "en", "a"), (2, "", "en", "b")])).collect()
    assert [(r.size, r.target) for r in empty] == [(0, 0.0)] * 2


def test_query_tells_every_row(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = QUERIES["op1_entropy_mixing"](spark, FOLDER).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((d.doc_id, words(d.text)) for d in docs)
    sizes = by_source([(d.doc_id, d.text, None, d.source) for d in docs])
    target, source = wanted(sizes), {d.doc_id: d.source for d in docs}
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 0.005 * t + 5 for s, t in target.items())

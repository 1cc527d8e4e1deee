import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import attention_quality as aq


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(2, 9))) for _ in range(n)).capitalize() + "."


def corpus(seed=0, n=900):
    """Good prose, and texts in which one part of many is junk."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.4
        parts = [prose(rng, rng.randrange(60, 130)) for _ in range(rng.randrange(1, 5))]
        if bad:
            parts[rng.randrange(len(parts))] = " ".join(f"{w}$$$" for w in prose(rng, 80).split())
        rows.append((i, "\n".join(parts)))
        labels.append((i, int(not bad)))
    return rows, labels


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_documents_are_told_apart(spark, documents):
    rows, labels = corpus()
    df, marks = documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = aq.fit(df, marks)
    got = {r.doc_id: r for r in aq.scored(df, model).withColumn("held", aq.held_out()).collect()}
    assert all(r.held == held(i) for i, r in got.items())
    own = [(got[i].predicted, q) for i, q in labels if held(i)]
    assert np.mean([p == q for p, q in own]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    # The held-out labels have no say.
    other = spark.createDataFrame([(i, 1 - q if held(i) else q) for i, q in labels], "doc_id bigint, quality int")
    assert {r.doc_id: r.score for r in aq.scored(df, aq.fit(df, other)).collect()} == {i: r.score for i, r in got.items()}


def test_scores_depend_on_texts_alone_and_reruns_agree(spark, documents):
    rows, labels = corpus(1, 300)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    df = documents(rows)
    model = aq.fit(df, marks)
    again = aq.fit(df.repartition(5), marks.repartition(3))
    one = {r.doc_id: r.score for r in aq.scored(df, model).collect()}
    moved = documents([(i + 7, t, "fr", "x") for i, t in rows]).repartition(4)
    two = {r.doc_id - 7: r.score for r in aq.scored(moved, again).collect()}
    assert all(one[i] == pytest.approx(two[i], abs=1e-5) for i in one)


def test_long_texts_are_read_to_the_end(monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 5000).encode()
    whole, _ = aq.encode_block([text])
    assert whole.shape == (-(-len(text.split()) // aq.PASSAGE_WORDS), aq.WIDTH)
    monkeypatch.setattr(aq, "BLOCK_BYTES", 4000)
    seen = dict.fromkeys(range(4), 0)
    for x, owner in aq.blocks([b"", text, b"one two", b"y" * 9000]):
        for place, words in zip(owner.tolist(), np.expm1(x[:, -1]).tolist(), strict=True):
            seen[place] += round(words)
    # A word that is longer than a block is cut.
    assert (seen[0], seen[1], seen[2]) == (0, len(text.split()), 2) and seen[3] > 1


def test_edge_rows(spark, documents):
    rows, labels = corpus(3, 120)
    rows += [(1000, None), (1001, ""), (1002, " \n "), (None, "a b"), (1003, "z"), (5, rows[5][1]), (1004, "w " * 200_000)]
    df = documents(rows).withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    marks = spark.createDataFrame([*labels, (None, 1), (1001, None), (5, 0)], "doc_id bigint, quality int")
    model = aq.fit(df, marks)
    got = aq.scored(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert aq.keep_good(df, marks).columns == df.columns
    none = documents([])
    assert aq.scored(none, model).count() == 0
    assert aq.fit(none, marks) == 0.5
    ones = spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id bigint, quality int")
    assert aq.fit(df, ones) == 1.0
    assert aq.keep_good(df, ones).count() == len(rows)
    assert {r.score for r in aq.scored(df, 0.5).collect()} == {0.5}


def test_gradients_follow_the_loss():
    """One step of training lowers the loss on a tiny set."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 6), aq.WIDTH)).astype(np.float32) + (i % 2) for i in range(60)]
    y = np.array([i % 2 for i in range(60)], np.float32)
    model = aq.train(bags, y)

    def score(x):
        _, h, _, _, e = model.parts(x)
        z = (h * (e / e.sum())[:, None]).sum(0)
        return aq._sigmoid(z @ model.weights["c"] + model.weights["d"][0])

    assert np.mean([(score(b) >= 0.5) == bool(t) for b, t in zip(bags, y, strict=True)]) > 0.95


def test_words_are_told_apart_by_all_their_bytes():
    for a, b in (("abcdefgh" * 5 + "x", "abcdefgh" * 5 + "y"), ("x" + "q" * 50, "y" + "q" * 50)):
        same, _ = aq.encode_block([f"{a} one {a}".encode()])
        other, _ = aq.encode_block([f"{a} one {b}".encode()])
        assert same[0, aq.PAIRS + 9] > 0.6 and other[0, aq.PAIRS + 9] == 0
    long = b"z" * 300_000
    x, _ = aq.encode_block([long + b" " + long, b"  " + long, b""])
    assert np.isfinite(x).all() and x[0, aq.PAIRS + 9] == 1


def test_sample_takes_labelled_documents_that_are_there(spark, documents):
    rows, labels = corpus(n=200)
    gone = [(10_000 + i, i % 2) for i in range(3 * aq.SAMPLE_DOCS)]
    marks = spark.createDataFrame([*labels, *gone], "doc_id bigint, quality int")
    repeated = documents([*rows, *[rows[0]] * 50])
    assert isinstance(aq.fit(repeated, marks), aq.Model)


def test_query_on_whole_table(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = QUERIES["op7_attention_quality"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    own = [(r.score, marks[r.doc_id]) for r in got if r.held_out and marks.get(r.doc_id) is not None]
    good, bad = [s for s, q in own if q], [s for s, q in own if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97

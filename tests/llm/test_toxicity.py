import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity

BAD = ["grumblefish", "snotwaffle", "dunderclod", "mudweasel"]
DATA = "doc_id bigint, toxic int"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def prose(rng, n):
    return ["".join(rng.choices(["ta", "en", "or", "sil", "qua", "mi", "le"], k=rng.randrange(1, 4))) for _ in range(n)]


def corpus(n=900, misspelt=False, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words, bad = prose(rng, rng.randrange(20, 300)), rng.random() < 0.25
        for at in range(5, len(words), 40) if bad else ():
            word = rng.choice(BAD)
            if misspelt and held(i):
                cut = rng.randrange(2, len(word) - 3)
                word = word[:cut] + rng.choice("xz") + word[cut:]
            words[at] = rng.choice([word, word.upper(), f"({word}),"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_documents_are_told_apart_misspelt_too(spark, documents):
    for misspelt in (False, True):
        rows, labels = corpus(misspelt=misspelt)
        df, marks = documents(rows), spark.createDataFrame(labels, DATA)
        got = {r.doc_id: r for r in toxicity.scored(df, toxicity.fit(df, marks)).collect()}
        own = [(i, t) for i, t in labels if held(i)]
        caught = [got[i].predicted for i, t in own if t]
        assert np.mean(caught) > (0.85 if misspelt else 0.97)
        assert np.mean([got[i].predicted for i, t in own if not t]) < 0.02


def test_labels_of_the_held_out_third_are_not_learnt(spark, documents):
    rows, labels = corpus()
    df = documents(rows)
    turned = [(i, 1 - t if held(i) else t) for i, t in labels]
    first, second = (toxicity.fit(df, spark.createDataFrame(x, DATA)) for x in (labels, turned))
    assert (first.pull == second.pull).all() and first.bias == second.bias


def test_encoding_by_hand():
    words = toxicity.encode_block(["Ab, ab!  c-d", "", "...", "xyz"])
    # Words: "ab" (twice, counted once), "c-d", "xyz"; their grams of 3 to 5 signs with an edge on both sides.
    assert words.owner.tolist() == [0, 3]
    assert np.diff(np.append(words.first_gram, len(words.grams))).tolist() == [3, 6, 6]
    assert words.first_word.tolist() == [0, 2]
    assert (words.grams[:3] == toxicity.encode_block(["AB"]).grams).all()
    assert not len(toxicity.encode_block(["", " ., "]).owner)


def test_score_is_that_of_the_highest_passage():
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(0, 5, toxicity.BUCKETS).astype(np.float32), -1.0)
    text = " ".join(prose(random.Random(1), 500))
    words = toxicity.encode_block([text])
    bounds = [*words.first_word, len(words.first_gram)]
    grams = np.split(words.grams, words.first_gram[1:])
    margin = max(
        sum(model.pull[g].mean() for g in grams[a:b]) / max(b - a, toxicity.FEW_WORDS) for a, b in zip(bounds, bounds[1:], strict=False)
    )
    assert abs(model.score([text])[0] - 1 / (1 + np.exp(1.0 - margin))) < 1e-5
    # Alone, with others, and cut into blocks: each text has its own score.
    others = ["", "a b c", text[:700], "q" * 5000]
    assert (model.score([*others, text])[-1:] == model.score([text])).all()


def test_long_texts_are_read_to_the_end():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), -3.0)
    model.pull[toxicity.encode_block(["snotwaffle"]).grams] = 400.0
    long = "la " * (toxicity.BLOCK_CHARS // 2)
    assert model.score([long + "snotwaffle", long, "z" * (3 * toxicity.BLOCK_CHARS)]).round(3).tolist()[1:] == [0.047, 0.047]
    assert model.score([long + "snotwaffle"])[0] > 0.9


def test_edge_rows(spark, documents):
    rows, labels = corpus(300)
    edge = [(None, "a b"), (1000, None), (1001, ""), (1002, " \n."), (5, rows[5][1]), (5, "another text of one id"), (1003, "é漢" * 9000), (1003, None)]
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (5, 1), (5, 0), (99_999, 1)], DATA)
    df = documents([*rows, *edge]).withColumn("toxic", F.lit("clash")).withColumn("score", F.lit("clash"))
    model = toxicity.fit(df, marks)
    got = toxicity.scored(df, model).collect()
    assert len(got) == 308 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    empty = {r.score for r in got if r.doc_id in (1000, 1001, 1002)}
    assert len(empty) == 1
    assert toxicity.scored(documents([]), model).count() == 0
    assert toxicity.fit(documents([]), marks) == 0.0
    assert toxicity.fit(df, marks.limit(0)) == 0.0
    assert {r.score for r in toxicity.scored(df, toxicity.fit(df, marks.filter("toxic = 1"))).collect()} == {1.0}


def test_query_on_whole_table(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = QUERIES["op11_subword_toxicity"](spark, FOLDER).collect()
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) for r in got)
    own = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    assert np.mean([p for p, t in own if t]) > 0.7  # some 30 toxic documents to learn from
    assert np.mean([p for p, t in own if not t]) < 0.02

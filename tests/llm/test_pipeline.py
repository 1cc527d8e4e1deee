"""The pipeline's stages, each against a brute-force version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import FOLDER
from tests.llm.test_exact_dedup import brute as equal_texts
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_mixing import by_source, wanted, words
from tests.llm.test_packing import check
from tidemark.llm.common import store, table


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage over the whole table."""
    docs, out = table(spark, FOLDER, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = store(stage(spark, docs, FOLDER), name)
        out[name] = (docs, result)
        docs = result
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = table(spark, FOLDER, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(result.columns == columns for name, (_, result) in stages.items() if name != "packing")


def test_classifier_keeps_labelled_good_documents(spark, stages):
    before, after = stages["quality_classifier"]
    kept = {r.doc_id for r in after.collect()}
    labels = table(spark, FOLDER, "labels").collect()
    good, bad = [r.doc_id for r in labels if r.quality == 1], [r.doc_id for r in labels if r.quality == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_exact_stage_keeps_the_first_of_equal_texts(stages):
    before, after = stages["exact_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(r[0] for r in equal_texts(rows) if r[3])


def test_near_stage_keeps_one_of_each_component(stages):
    before, after = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in components_fast(rows)})


def components_fast(rows):
    """Brute force over pairs that share a shingle; texts that share none cannot be similar."""
    from tests.llm.test_jaccard_join import shingle_set

    sets = [shingle_set(t) for _, t in rows]
    where = {}
    for i, own in enumerate(sets):
        for s in own:
            where.setdefault(s, []).append(i)
    near = {i: {j for s in own for j in where[s]} - {i} for i, own in enumerate(sets)}
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, others in near.items():
        for j in others:
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                label[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), smallest[root(i)]) for i, (doc_id, _) in enumerate(rows)]


def test_the_fast_brute_force_is_right():
    rows = [(3, "a b c d e f g h i j"), (1, "a b c d e f g h i j k"), (2, "x y"), (9, "X y"), (4, "p q r s t u")]
    assert sorted(components_fast(rows), key=str) == components(rows)


def test_mix_meets_its_targets(stages):
    before, after = stages["source_mix"]
    target = wanted(by_source([(r.doc_id, r.text, None, r.source) for r in before.collect()]))
    taken = Counter()
    for r in after.collect():
        taken[r.source] += words(r.text)
    assert all(abs(taken[s] - t) <= 0.01 * t + 5 for s, t in target.items())
    times = Counter(r.doc_id for r in after.collect())
    assert max(times.values()) == 2 and set(times) <= {r.doc_id for r in before.collect()}


def test_packing_holds_every_id(stages):
    before, after = stages["packing"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert check(rows, after.collect()) < 0.05


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    want = stages["packing"][1]
    assert sum(r.length for r in got.select("length").collect()) == sum(r.length for r in want.select("length").collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_what_a_stage_stored_goes_when_the_next_begins(spark, documents):
    from tidemark.llm.common import stage_of, store

    df = documents([(1, "a"), (2, "b")])
    with stage_of(spark, "line"):
        first = store(df, "first")
    with stage_of(spark, "another line"):
        other = store(df, "first")
    with stage_of(spark, "line"):
        second = store(df, "second")
    outside = store(df, "outside")
    with stage_of(spark, "line"):
        pass
    assert other.count() == outside.count() == 2
    for gone in (first, second):
        with pytest.raises(Exception, match="(?i)not.?exist|not found"):
            gone.count()


def test_pipeline_with_nulls_repeats_clashes_and_empty_tables(spark, documents, tmp_path):
    import corpus_pipeline

    rows = [(1, None), (1, None), (None, "a b c d e f"), (None, "a b c d e f"), (2, ""), (3, "word " * 3000)]
    rows += [(10 + i, f"some clean text of number {i} with words", "en", None if i % 2 else "s") for i in range(30)]
    marks = spark.createDataFrame([(10 + i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    for name, df in (("full", documents(rows)), ("none", documents([]))):
        folder = str(tmp_path / name)
        clashing = df.withColumn("row", df.doc_id).withColumn("_row", df.text).withColumn("ids", df.doc_id).withColumn("copies", df.text)
        clashing.write.parquet(f"{folder}/documents.parquet")
        marks.write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert bool(got) == (name == "full")
        assert {r.doc_id for r in got} <= {r[0] for r in rows}

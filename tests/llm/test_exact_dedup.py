import hashlib
import random
import re

import pyarrow as pa

from tidemark.llm.exact_dedup import _neighbours, duplicate_groups, keep_first


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for body, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        done = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            out.append((i, first, len(ids), not done and i == first, hashlib.sha256(body.encode()).hexdigest()))
            done = True
    return sorted(out, key=str)


def found(df):
    return sorted(
        map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str
    )


def test_edge_rows(documents):
    rows = [
        (3, "a  b"), (1, "a\tb"), (2, "a b "), (4, None), (5, ""), (None, "a b"), (None, "only null"),
        (7, "x" * 300_000), (6, "x" * 300_000), (8, "x" * 299_999), (9, "é b"), (10, "é b"), (1, "a b"),
    ]
    assert found(duplicate_groups(documents(rows))) == brute(rows)
    assert found(duplicate_groups(documents([]))) == []


def test_hot_group_is_spread_over_partitions(spark, documents):
    rng = random.Random(4)
    rows = [(i, "same text" if i % 3 else f"text {rng.randrange(300)}") for i in range(3000)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set(adaptive, "false")
    try:
        assert found(duplicate_groups(documents(rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(adaptive, "true")


def test_clashing_columns_and_kept_rows(spark):
    df = spark.createDataFrame(
        [(2, "a", "h", 1), (1, "a ", "i", 2), (3, "a", "j", 3)], "doc_id bigint, text string, head string, run_size int"
    )
    assert keep_first(df).columns == df.columns
    assert [r.doc_id for r in keep_first(df).collect()] == [2, 1] or sorted(
        r.doc_id for r in keep_first(df).collect()
    ) == [1, 2]


def test_one_row_of_each_text_stays(documents):
    rows = [
        (1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (None, "c"), (None, "a"), (3, "c"),
        (1, "d"), (1, "e"), (0, "e"), (5, None), (5, ""), (None, None),
    ]
    got = sorted(((r.doc_id, r.text or "") for r in keep_first(documents(rows)).collect()), key=str)
    assert got == sorted([(1, "a"), (None, "b"), (3, "c"), (1, "d"), (0, "e"), (5, "")], key=str)
    many = [(None, "hot")] * 400 + [(7, "hotter")] * 400
    assert sorted(r.text for r in keep_first(documents(many).repartition(5)).collect()) == ["hot", "hotter"]


def test_a_long_run_keeps_ids_but_no_texts():
    peak = 0

    def batches(body, count, rows=100):
        """Batches as a task reads them: all columns of one lie in one buffer."""
        nonlocal peak
        for k in range(count):
            sink = pa.BufferOutputStream()
            digest = hashlib.sha256(body.encode()).hexdigest()
            columns = [pa.array(range(k * rows, (k + 1) * rows), pa.int64()), pa.array([digest] * rows), pa.array([body] * rows)]
            batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_sha256", "body"])
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            del columns, batch
            yield pa.ipc.open_stream(sink.getvalue()).read_next_batch()
            del sink
            peak = max(peak, pa.total_allocated_bytes() - began)

    began = pa.total_allocated_bytes()
    runs = list(_neighbours(batches("x" * 10_000, 40)))
    got = pa.Table.from_batches(runs).to_pylist()
    assert [r["doc_id"] for r in got] == list(range(4000)) and {r["head_id"] for r in got} == {0}
    assert {r["run_size"] for r in got} == {4000} and [r["doc_id"] for r in got if r["run_first"]] == [0]
    assert {r["text_sha256"] for r in got} == {hashlib.sha256(b"x" * 10_000).hexdigest()}
    assert peak < 8 << 20  # a batch has 1 MB, all have 40


def test_runs_over_many_batches(spark, documents):
    rng = random.Random(11)
    rows = [(i, rng.choice(["hot", "hot  text", None, "", f"text {rng.randrange(60)}"])) for i in range(900)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        assert found(duplicate_groups(documents(rows))) == brute(rows)
    finally:
        spark.conf.set(size, before)

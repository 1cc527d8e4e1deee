"""Interval blocks, distinct sets, the keyed log, verified order and the record reader, against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import distinct_sets
from tidemark.operators.intervals import cover, points_in_intervals
from tidemark.sources import ordered, readers, run_log

DAY = datetime.date(1970, 1, 1)


def day(n):
    return None if n is None else (DAY + datetime.timedelta(n)).isoformat()


def test_cover_is_exact_and_short(frame):
    rng = random.Random(4)
    ends = [(a, a + rng.choice([0, 1, 6, 13, 14, 100, 5000])) for a in (rng.randrange(-4000, 20000) for _ in range(200))]
    rows = [(i, day(a), day(b)) for i, (a, b) in enumerate(ends)] + [(900, day(5), day(3)), (901, None, day(3)), (902, day(3), None)]
    got = {r.i: r.c for r in frame(rows, "i int, a date, b date").select("i", cover(F.col("a"), F.col("b")).alias("c")).collect()}
    for i, (a, b) in enumerate(ends):
        days = sorted(d for x in got[i] for d in range(x.block << x.level, (x.block + 1) << x.level))
        assert days == list(range(a, b + 1))
        assert len(got[i]) <= 2 * max(1, (b - a + 1).bit_length())
    assert not got[900] and not got[901] and not got[902]


def test_points_in_intervals_equal_nested_loops(frame):
    rng = random.Random(6)
    points = [(i, rng.choice(["x", "y", None]), day(rng.choice([None, *range(-20, 400)]))) for i in range(400)]
    windows = [(100 + i, rng.choice(["x", "y", "z", None]), day(a := rng.randrange(-30, 380)), day(a + rng.randrange(0, 90))) for i in range(40)]
    got = points_in_intervals(
        frame(points, "p int, k string, d date"), "d", frame(windows, "w int, k string, a date, b date"), "a", "b", ["k"]
    )
    want = sorted((p, w) for p, k, d in points for w, j, a, b in windows if k is not None and k == j and d is not None and a <= d <= b)
    assert sorted((r.p, r.w) for r in got.collect()) == want
    none = frame([], "w int, k string, a date, b date")
    assert points_in_intervals(frame(points, "p int, k string, d date"), "d", none, "a", "b", ["k"]).count() == 0


def test_rows_sent_do_not_grow_with_the_windows(frame):
    sent = [frame([(day(3), day(3 + n))], "a date, b date").select(F.size(cover(F.col("a"), F.col("b")))).first()[0] for n in (10, 1000, 100_000)]
    assert sent[2] <= 35


@pytest.mark.parametrize("sparse", [0, 3, 1024])
def test_distinct_sets_add_up(spark, monkeypatch, sparse):
    monkeypatch.setattr(distinct_sets, "SPARSE", sparse)
    rng = random.Random(sparse)
    rows = [(rng.choice("abc"), rng.choice("xy"), rng.choice([None, rng.randrange(100), rng.randrange(10**12)])) for _ in range(3000)]
    rows += [("a", "x", 5)] * 50 + [(None, "x", 5), ("d", "x", None)]
    mart = distinct_sets.distinct_sets(spark.createDataFrame(rows, "g string, h string, id bigint"), ["g", "h"], "id")
    for keys in (["g"], ["h"], ["g", "h"]):
        got = {tuple(r[k] for k in keys): r.n for r in distinct_sets.distinct_counts(mart, keys, "n").collect()}
        want = {}
        for g, h, i in rows:
            if i is not None:
                want.setdefault(tuple({"g": g, "h": h}[k] for k in keys), set()).add(i)
        assert got == {k: len(v) for k, v in want.items()}
    some = distinct_sets.distinct_counts(mart.where("h = 'x'"), ["g"], "n").collect()
    assert {r.g: r.n for r in some} == {g: len({i for a, h, i in rows if a == g and h == "x" and i is not None}) for g in ("a", "b", "c", None)}


def test_log_keeps_the_last_attempt(spark, tmp_path):
    path = str(tmp_path / "log")
    for key, status in (("a", "FAILED"), ("b", "SUCCESS"), ("a", "SUCCESS"), (None, "SUCCESS"), ("a", None)):
        run_log.append_keyed(spark.createDataFrame([(key, status)], "k string, status string"), path)
    got = {r.k: (r.status, r.attempts) for r in run_log.read_keyed(spark, path, "k").collect()}
    assert got == {"a": (None, 3), "b": ("SUCCESS", 1), None: ("SUCCESS", 1)}


def test_order_is_verified_within_files_and_across(spark, tmp_path):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.col("id") % 97).alias("a"), F.col("id").alias("b"))
    good, inside, across = (str(tmp_path / x) for x in ("good", "inside", "across"))
    ordered.write_ordered(rows, good, ["a", "b"])
    assert ordered.verify_order(spark, good, ["a", "b"]).first().asDict()["sorted"] == 1
    rows.repartitionByRange(4, "a").write.parquet(inside)
    assert ordered.verify_order(spark, inside, ["a", "b"]).first().sorted == 0
    rows.repartition(4, "b").sortWithinPartitions("a", "b").write.parquet(across)
    found = ordered.verify_order(spark, across, ["a", "b"]).first()
    assert (found.files, found.rows, found.sorted) == (4, 5000, 0)
    ordered.write_ordered(rows.limit(0), str(tmp_path / "none"), ["a"])
    assert ordered.verify_order(spark, str(tmp_path / "none"), ["a"]).first().asDict()["sorted"] == 1


def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('[{"k": "x", "n": 1, "tags": ["a", "b"]},\n {"k": "y", "n": "no"}, {"n": 3}, 7, null, {"k": "z"}]')
    (tmp_path / "in/b.json").write_text('{"k": "whole"}')
    (tmp_path / "in/c.json").write_text(" []\n")
    (tmp_path / "in/d.json").write_text('[{"k": "a"}]\n[{"k": "b"}]')
    schema = T.StructType.fromDDL("k string, n int, tags array<string>")
    fit, rejected = readers.read_records(spark, str(tmp_path / "in"), schema, ["k"])
    assert sorted((r.k, r.n, r.tags, r.file, r.position) for r in fit.collect()) == [("x", 1, ["a", "b"], "a.json", 0), ("z", None, None, "a.json", 5)]
    assert sorted((r.file, r.position, r.reason) for r in rejected.collect()) == [
        ("a.json", 1, "a field does not fit"), ("a.json", 2, "missing k"), ("a.json", 3, "not an object"), ("a.json", 4, "not an object"),
        ("b.json", -1, "not an array"), ("d.json", -1, "not an array"),
    ]

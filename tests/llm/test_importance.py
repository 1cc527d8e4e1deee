import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None, "", "  \n", "a", "Ab, aB; AB!", "straße STRASSE ÄÖ äö", "x_y-z 1.5e3 \x7f\x00q", " line \x85next\xa0nbsp 漢字、かな",
    "q" * 70_001 + " tail", "one two three " * 3000, "I'll don't", "é" * 300 + "A",
]


def grams(text, longest):
    words = WORD.findall((text or "").translate(CAPITALS))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    def count(texts):
        out = [0] * buckets
        for text in texts:
            for g in grams(text, longest)[1]:
                out[zlib.crc32(g.encode()) % buckets] += 1
        return out

    s, t = count([r[1] for r in rows]), count(target)
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        n, found = grams(text, longest)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("longest", [1, 2, 5])
def test_crcs_of_runs_are_those_of_their_bytes(longest):
    texts = [(t or "").encode() for t in TEXTS]
    crcs, owner, words = importance.ngram_crcs(texts, longest)
    for i, text in enumerate(TEXTS):
        n, want = grams(text, longest)
        assert words[i] == n
        assert crcs[owner == i].tolist() == [zlib.crc32(g.encode()) for g in want]


def test_shift_equals_zero_bytes():
    for n in (0, 1, 2, 3, 255, 4096, 70_001):
        # The shift of a CRC by n bytes: what joining n zero bytes adds to their own CRC.
        want = zlib.crc32(b"abc" + b"\0" * n) ^ zlib.crc32(b"\0" * n)
        assert importance.shifted(np.array([zlib.crc32(b"abc")], np.uint32), np.array([n]))[0] == want


def test_edge_rows_equal_brute_force(spark, documents):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "w " * 30)] * 2 + [(7, "twice " * 25)] * 3
    rows += [(100 + i, " ".join(rng.choices("alpha beta gamma delta eps".split(), k=rng.randrange(10, 60)))) for i in range(150)]
    target = ["alpha alpha beta", None, "", "x Straße"]
    aims = spark.createDataFrame([(t,) for t in target], "text string").withColumn("doc_id", F.lit("clash"))
    got = importance.resampled(documents(rows).withColumn("rank", F.lit("clash")), aims)
    assert found(got) == brute(rows, target)
    got = importance.resampled(documents(rows), aims, longest=3, buckets=70_000, least_words=5, percent=40, seed=1)
    assert found(got) == brute(rows, target, 3, 70_000, 5, 40, 1)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert importance.resampled(documents([]), none).count() == 0
    rows = [(i, "a b c " * i) for i in range(40)]
    assert found(importance.resampled(documents(rows), none)) == brute(rows, [])


def test_whole_table_equals_brute_force(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    rows = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    want = brute(rows, [r.text for r in read("benchmark").collect()])
    got = QUERIES["op13_prefix_crc_resampling"](spark, FOLDER)
    assert dict(got.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str) == [
        (r[0], *r[2:]) for r in want
    ]

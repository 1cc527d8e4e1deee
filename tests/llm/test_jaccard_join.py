import random
import re

import numpy as np
import pytest

from tidemark.llm import exchange, jaccard_join
from tidemark.llm.components import components
from tidemark.llm.jaccard_join import PrefixTree, keep_one, near_duplicates, shingles


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                label[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if sets[i] and ids else doc_id))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed, n, edits=0.04):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("xyz") + str(rng.randrange(4))
    bases = [[word() for _ in range(rng.randrange(3, 90))] for _ in range(6)]
    rows = []
    for i in range(n):
        if rng.random() < 0.7:
            words = [word() if rng.random() < edits * rng.random() else w for w in rng.choice(bases)]
        else:
            words = [word() for _ in range(rng.randrange(40))]
        text = " ".join(words)
        rows.append((i, text.upper() if rng.random() < 0.1 else text.replace(" ", rng.choice([" ", "\n", "  "]))))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_near_copies(documents, seed):
    rows = corpus(seed, 200)
    assert found(near_duplicates(documents(rows))) == brute(rows)


def test_large_blocks_are_split(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_SETS", 7)
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 3000)
    rows = corpus(9, 250, edits=0.1)
    assert found(near_duplicates(documents(rows))) == brute(rows)


def test_edge_rows(documents):
    long_text = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (2, "One  two"), (7, "one two three"), (None, "one two"), (None, "alone here"),
        (9, long_text), (8, long_text + " end"), (10, "a a a a a a a"), (11, "a a a a a"), (12, "É x y z w"), (13, "é x y z w"),
    ]
    assert found(near_duplicates(documents(rows))) == brute(rows)
    assert near_duplicates(documents([])).count() == 0
    kept = sorted(str(r.doc_id) for r in keep_one(documents(rows)).collect())
    assert kept == sorted(map(str, [3, 4, 5, 2, 7, None, None, 8, 10, 12, 13]))


def test_repeated_rows_are_one_class(documents):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (0, "z b c d e f")]
    assert found(near_duplicates(documents(rows))) == [(0, 2, 0), (1, 2, 1), (1, 2, 1), (2, 2, 1)]


@pytest.mark.parametrize("seed", range(6))
def test_prefix_tree_connects_all_similar_sets(seed):
    rng = np.random.default_rng(seed)
    base = np.sort(rng.choice(400, 60, replace=False))
    sets = {tuple(np.unique(np.where(rng.random(60) < 0.08 * rng.random(), rng.integers(0, 400, 60), base))) for _ in range(80)}
    sets |= {tuple(np.sort(rng.choice(400, rng.integers(1, 12), replace=False))) for _ in range(40)}
    own = [np.array(s, np.uint32) for s in sets]
    sizes = np.array([len(s) + int(rng.integers(0, 4)) for s in own])
    parts = rng.integers(0, 2, len(own))

    def merged(pairs):
        label = np.arange(len(own))
        for a, b in pairs:
            label[label == label[a]] = label[b]
        return [sorted(np.flatnonzero(label == x).tolist()) for x in sorted(set(label.tolist()))]

    every = [
        (i, j) for i in range(len(own)) for j in range(i)
        if (c := len(np.intersect1d(own[i], own[j]))) and 100 * c >= 80 * (sizes[i] + sizes[j] - c)
    ]
    assert sorted(merged(PrefixTree(own, sizes, 400).links())) == sorted(merged(every))
    across = [(i, j) for i, j in every if parts[i] != parts[j]]
    assert sorted(merged(PrefixTree(own, sizes, 400).links(80, parts))) == sorted(merged(across))


def test_long_words_and_blocks(monkeypatch):
    text = (" ".join(f"word{i % 97}" for i in range(3000)) + " " + "y" * 5000 + " end of it all").encode()
    whole = shingles(text)
    monkeypatch.setattr(jaccard_join, "_BLOCK_BYTES", 6000)
    assert np.array_equal(shingles(text), whole)


def test_words_behind_a_word_longer_than_a_block(monkeypatch):
    words = " ".join(f"word{i % 997}" for i in range(3000))
    long_word = "q" * (5 << 19)
    with_word, without = shingles(f"{long_word} {words}".encode()), shingles(words.encode())
    assert len(np.setdiff1d(without, with_word)) == 0 and len(with_word) == len(without) + 1
    moved = shingles(f"{words}\n\n{long_word}".encode())
    assert len(np.setdiff1d(without, moved)) == 0 and len(moved) == len(without) + 1
    texts = [f"{long_word} a\t{long_word}x {words} {long_word}".encode(), f" {long_word}".encode(), long_word.encode() + b"\x0b"]
    cut = [shingles(t) for t in texts]
    monkeypatch.setattr(jaccard_join, "_BLOCK_BYTES", 1 << 20 | 4000)
    assert all(np.array_equal(shingles(t), c) for t, c in zip(texts, cut, strict=True))
    monkeypatch.setattr(jaccard_join, "_BLOCK_BYTES", 3)
    assert np.array_equal(shingles(b" abcdef abc\nabcdefghi  x"), np.unique(jaccard_join._windows(jaccard_join._hash_block(b"abcdef abc abcdefghi x"), 4)))


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1400)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys([7, *range(1000, 1400)], 7)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_row_of_each_component_stays(documents):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [
        (5, a), (5, a), (5, b + " end"), (7, a + " end"), (3, b), (None, a + " more"), (None, a), (None, "c d e f g h"), (None, "c d e f g h"),
        (9, None), (9, None), (None, ""),
    ]
    got = sorted(((r.doc_id, r.text) for r in keep_one(documents(rows).coalesce(1)).collect()), key=str)
    assert got == sorted([(5, a), (3, b), (None, a + " more"), (None, "c d e f g h"), (9, None), (9, None), (None, "")], key=str)

import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import exchange, repeats
from tidemark.llm.repeats import LENGTH, without_repeats


def brute(rows):
    """(id, removed spans, kept bytes) by a table of all 50-byte strings."""
    first = defaultdict(lambda: exchange.NO_ID)
    texts = [(exchange.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - LENGTH + 1):
            first[t[p : p + LENGTH]] = min(first[t[p : p + LENGTH]], i)
    out = []
    for (i, t), (doc_id, _) in zip(texts, rows, strict=True):
        cover = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - LENGTH + 1):
            if first[t[p : p + LENGTH]] < i:
                cover[p : p + LENGTH] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], cover]).astype(np.int8)))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        out.append((doc_id, len(t), spans, bytes(b for b, c in zip(t, cover, strict=False) if not c)))
    return sorted(out, key=str)


def found(df):
    return sorted(
        ((r.doc_id, r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in df.collect()), key=str
    )


def corpus(seed, n, alphabet="ab cé"):
    rng = random.Random(seed)
    passages = ["".join(rng.choices(alphabet, k=rng.randrange(30, 160))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("xyz é\n", k=rng.randrange(80))) for _ in range(rng.randrange(6))]
        text = "".join(parts)
        if rng.random() < 0.3 and text:
            cut = rng.randrange(len(text))
            text = text[:cut] + "#" + text[cut + 1 :]
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_passages(documents, seed):
    rows = corpus(seed, 120)
    assert found(without_repeats(documents(rows))) == brute(rows)


def test_edge_rows(documents):
    rows = [
        (5, None), (4, ""), (3, "q" * 49), (2, "q" * 50), (1, "q" * 400), (None, "q" * 60), (None, "w" * 60), (None, "w" * 60),
        (7, "ab" * 300), (6, "ba" * 40 + "\0" * 80), (8, "\0" * 70), (9, "é" * 60), (10, "x" + "é" * 60), (7, "ab" * 300), (7, "q" * 55),
    ]
    assert found(without_repeats(documents(rows))) == brute(rows)
    assert without_repeats(documents([])).count() == 0


def test_hot_passage_in_small_chunks(documents, monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 5000)
    rng = random.Random(5)
    hot = "this passage stands in very many of the documents, word for word. " * 2
    rows = [(i, "".join(rng.choices("abcdefgh ", k=60)) + (hot if i % 3 else "") + "".join(rng.choices("stuv ", k=60))) for i in range(200)]
    rng.shuffle(rows)
    assert found(without_repeats(documents(rows))) == brute(rows)


def windows(segments):
    parts = zip(segments.texts.tolist(), segments.starts.tolist(), segments.counts.tolist(), segments.anchors.tolist(), strict=True)
    return [(text, start + i, anchor) for text, start, n, anchor in parts for i in range(n)]


def test_texts_hash_alike_alone_together_and_in_blocks(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcd ", k=rng.choice([0, 3, 49, 50, 51, 200, 5000]))).encode() + b"z" * rng.choice([0, 0, 500]) for _ in range(40)]
    whole = repeats.segments_of(texts)
    alone = [(i, p, a) for i, t in enumerate(texts) for _, p, a in windows(repeats.segments_of([t]))]
    assert windows(whole) == alone
    assert [(i, p) for i, p, _ in alone] == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - LENGTH + 1)]
    assert whole.counts.max() <= repeats.WINDOW
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    assert windows(repeats.segments_of(texts)) == alone


def test_index_equals_a_table_of_windows():
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab", k=rng.randrange(50, 77))).encode() for _ in range(60)]
    texts += [texts[0][:60], texts[1][5:], b"\0" * 76, b"\xff" * 76]
    rows = np.zeros((len(texts), repeats._WIDTH), np.uint8)
    for row, t in zip(rows, texts, strict=True):
        row[: len(t)] = np.frombuffer(t, np.uint8)
    lengths, owners = np.array([len(t) for t in texts]), np.array([rng.randrange(1000) for _ in texts])
    got = repeats.RunLengthIndex(rows, lengths, owners).first_owners(rows, lengths)
    first = defaultdict(lambda: 10**9)
    for t, o in zip(texts, owners.tolist(), strict=True):
        for p in range(len(t) - LENGTH + 1):
            first[t[p : p + LENGTH]] = min(first[t[p : p + LENGTH]], o)
    for k, t in enumerate(texts):
        assert got[k][: len(t) - LENGTH + 1].tolist() == [first[t[p : p + LENGTH]] for p in range(len(t) - LENGTH + 1)]

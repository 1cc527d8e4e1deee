import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import CAPACITY, WordTokenizer, cuts, pack

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, pieces):
    """Every id of every row in one piece, sequences without gaps."""
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(whole(text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc_id, same in texts.items():
        if len(same) == 1 or len(set(map(tuple, same))) == 1:
            ids = same[0]
            for p in by_doc[doc_id]:
                part = b"".join(i.to_bytes(4, "little") for i in ids[p.start : p.start + p.length])
                assert (bytes(p.ids), p.length, p.doc_tokens) == (part, len(part) // 4, len(ids))
        spans = Counter(i for p in by_doc[doc_id] for i in range(p.start, p.start + p.length))
        assert spans == Counter(i for ids in same for i in range(len(ids)))
    padding = 0
    for own in by_sequence.values():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end and p.length > 0
            end += p.length
        assert end <= CAPACITY
        padding += CAPACITY - end
    return padding / max(1, sum(p.length for p in pieces))


def test_edge_rows(documents):
    rows = [
        (1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x y z"), (4, "I'll <|endoftext|> don't<|startoftext|>go"),
        (5, "é ́a ﬁ İ ΑΣ b\x1cc\x85d e 10.5%"), (6, "long words " * 30_000), (7, "q" * 100_000),
    ]
    check(rows, pack(documents(rows)).collect())
    assert pack(documents([])).count() == 0


def test_random_texts_equal_the_tokenizer(documents):
    rng = random.Random(10)
    chars = "ab éßñÇ'stl.1!|\n\t  <>漢字́ "
    rows = [(i, "".join(rng.choices(chars, k=rng.randrange(400)))) for i in range(300)]
    check(rows, pack(documents(rows)).collect())


def test_small_memory_gives_the_same(documents, monkeypatch):
    from tidemark.llm import packing

    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "CACHE_BYTES", 3)
    texts = ["a b c d", "C d. e f", "a b", "f g h i j", "a", "É é, x", "a1 a"]
    assert [list(memoryview(x).cast("I")) for x in tokenizer.ids([t.encode() for t in texts])] == [
        whole(t) for t in texts
    ]
    assert [list(memoryview(next(tokenizer.ids([t.encode()]))).cast("I")) for t in texts] == [whole(t) for t in texts]
    tokenizer.forget()
    assert not tokenizer.known and not tokenizer.held


def test_capitals_before_combining_marks(documents):
    rows = list(enumerate(["H\u0331A b", "W\u030aX", "I\u0307S", "K\u0338 \u212a", "A\u0308C HELLO", "\u0130 \u1e9e STRASSE"]))
    check(rows, pack(documents(rows)).collect())


@pytest.mark.parametrize("length", [1, 2, 341, 1023, 1024, 1025, 1300, 2047, 2048, 2049, 5000])
def test_cuts_are_whole_and_full(length):
    pieces = cuts(length)
    assert sum(pieces) == length
    assert all((CAPACITY // p) * p >= CAPACITY * 15 // 16 for p in pieces)


def test_whole_table(spark):
    from tests.llm.conftest import FOLDER

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert check(rows, pack(docs).collect()) < 0.05


def test_query_gives_the_checksum_of_the_ids(spark):
    from tests.llm.conftest import SMALL
    from tidemark.llm.queries import QUERIES

    texts = {r.doc_id: whole(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for p in QUERIES["op10_harmonic_packing"](spark, SMALL).collect():
        part = texts[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))


def test_words_of_a_batch_are_not_held_at_once():
    tokens = WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = [b"ab cd " * 20_000] * 35  # 4 MB of two words
    list(tokens.ids(texts[:1]))
    tracemalloc.start()
    try:
        assert len(set(tokens.ids(texts))) == 1
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()


def test_new_words_of_letters_pass_only_the_model(monkeypatch):
    tokens, rng, seen = WordTokenizer(public_tokenizers.path("word_bpe_49k.json")), random.Random(11), []
    encode = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda text: seen.append(text) or encode(text))
    small = [c for c in map(chr, [*range(97, 123), *range(0xC0, 0x100)]) if c.isalpha()]
    words = ["".join(rng.choices(small, k=rng.randrange(1, 12))) for _ in range(3000)]
    words += [up for w in words if max(up := w.upper()) <= "ÿ"] + [w + rng.choice(",.;!)") for w in words] + small
    text = " ".join(words + ["q" * 5000, "é" * 5000])
    assert list(memoryview(next(tokens.ids([text.encode()]))).cast("I")) == whole(text)
    assert set(seen) <= {*",.;!)", "q" * 5000, "é" * 5000}


def test_memory_is_bounded_within_a_batch(monkeypatch):
    from tidemark.llm import packing

    tokens, rng, held = WordTokenizer(public_tokenizers.path("word_bpe_49k.json")), random.Random(12), []
    monkeypatch.setattr(packing, "CACHE_BYTES", 100_000)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(100)) for _ in range(40)]
    for text, ids in zip(texts, tokens.ids([t.encode() for t in texts]), strict=True):
        assert list(memoryview(ids).cast("I")) == whole(text)
        held.append(tokens.held)
    assert max(held) < 100_000 + 100 * 300

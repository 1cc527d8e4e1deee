"""Harmonic packing of token ids into sequences of a fixed capacity C.

Class k holds pieces whose length lies in (C/(k+1), C/k]; a bin of class k takes exactly k pieces. A piece that would
leave more than a sixteenth of its bin empty is cut to the next reciprocal C/(k+1), and its rest is classified again, so
full bins hold little padding and most documents are cut once or not at all. Every worker fills the bins of its own rows.
What is left in open bins at its end (fewer than k pieces of each class) is laid end to end, cut at C.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, settled, text_of, utf8

CAPACITY = 2048
END_ID = 1
#: A bin may stay empty by one part in so many before its pieces are cut.
SLACK = 16
#: Bytes of words and ids that a worker remembers within a task; beyond that it starts anew. Only speed depends on it.
CACHE_BYTES = 96 << 20
#: What Python needs for an entry besides its characters.
_ENTRY = 176
_BATCH_BYTES = 8 << 20
#: Longer words are not taken from the model, whose tokens are objects of their own.
_LONG = 1 << 10
#: Letters that are one character each in any normal form, and marks that stand together as one token group.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,;:!?|#$%&*()\"-]*)")
_MARKS = b'.,;:!?|#$%&*()"-'
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class _Words(dict):
    """Ids by word; those of a word not yet here are made when it is asked for."""

    def __init__(self, learn: Callable[[bytes], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class WordTokenizer:
    """Ids of whole texts through a memory of words, bounded in bytes.

    The tokenizer splits at white space before anything else can join, so the ids of a text are those of its words in
    a row. ASCII capitals do not matter, except before a combining mark: only small letters join with some of them. A word
    of Latin letters and marks splits again between the two, so most new words need only the ids of their letters. Small
    letters pass the normalizer as they are and the splitting as one token group, so they go to the tokenizer's model at
    once, accented ones as the characters that stand for their bytes. All else goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        letters = "abcdefghijklmnopqrstuvwxyz" + "".join(filter(str.isalpha, map(chr, range(0xC0, 0x100))))
        self.spelled = {ord(c): split(c)[0][0] for c in letters}
        self.packed = [_packed([i]) for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.forget()

    def forget(self) -> None:
        self.known = _Words(self._learn)
        self.held = 0

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _letters(self, text: str) -> bytes:
        """Ids of small letters."""
        if len(text) > _LONG:
            return _packed(self._encode(text))
        spelled = text if text.isascii() else text.translate(self.spelled)
        return b"".join([self.packed[token.id] for token in self.model.tokenize(spelled)])

    def _learn(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII
            ids = self._letters(word.lower().decode())
        elif (letters := word.rstrip(_MARKS)).isalpha():
            ids = self.known[letters] + self.known[word[len(letters) :]]
        elif match := _PLAIN.fullmatch(text := word.decode()):
            small = match[1].lower()
            if small == text:
                ids = self._letters(text)
            else:
                ids = self.known[small.encode()] + (self.known[match[2].encode()] if match[2] else b"")
        else:
            ids = _packed(self._encode(text))
        self.held += _ENTRY + len(word) + len(ids)
        return ids

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with the end id."""
        end = _packed([END_ID])
        for text in texts:
            if self.held > CACHE_BYTES:
                self.forget()
            yield b"".join(map(self.known.__getitem__, _words(text))) + end


def _words(text: bytes) -> list[bytes]:
    return (text if b"\xcc" in text or b"\xcd" in text else text.lower()).split()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cuts(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if k * rest * slack >= capacity * (slack - 1):
            piece = rest
        else:
            piece = capacity // (k + 1)
        pieces.append(piece)
        rest -= piece
    return pieces


def pack_partition(
    documents: Iterator[tuple[int | None, bytes]], worker: int, capacity: int = CAPACITY
) -> Iterator[tuple]:
    """Rows of pieces from (id, packed token ids) of one worker."""
    numbers = iter(range(worker << 33, (worker + 1) << 33))
    open_bins: dict[int, list[tuple]] = {}

    def placed(pieces: list[tuple], number: int) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids) // 4, ids, total, number, offset
            offset += len(ids) // 4

    for doc_id, ids in documents:
        start, total = 0, len(ids) // 4
        for length in cuts(total, capacity):
            k = capacity // length
            held = open_bins.setdefault(k, [])
            held.append((doc_id, start, ids[4 * start : 4 * (start + length)], total))
            start += length
            if len(held) == k:
                yield from placed(open_bins.pop(k), next(numbers))
    room, line = capacity, []
    for k in sorted(open_bins):
        for doc_id, start, ids, total in open_bins[k]:
            while ids:
                part = ids[: 4 * room]
                line.append((doc_id, start, part, total))
                start, ids, room = start + len(part) // 4, ids[len(part) :], room - len(part) // 4
                if not room:
                    yield from placed(line, next(numbers))
                    room, line = capacity, []
    if line:
        yield from placed(line, next(numbers))


def pack(
    docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are little-endian unsigned 32-bit integers; the pieces of a sequence by offset are its content. A document is its text's token ids and the end id; a null or empty text is the end id alone, a null id stays null.
    Each id of each row lies in exactly one piece, a repeated row is packed again, sequences hold at most ``capacity``
    ids without gaps. An empty table gives no rows; other columns are not read.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    names = [part.split(" ")[0] for part in _PIECES.split(", ")]
    schema = pa.schema([(name, pa.binary() if name == "ids" else pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents():
            for batch in batches_of(batches, _BATCH_BYTES):
                ids = batch.column(0).to_pylist()
                yield from zip(ids, _tokenizer(path).ids(utf8(batch.column(1))), strict=True)

        pieces = pack_partition(documents(), TaskContext.get().partitionId(), capacity)
        try:
            while rows := list(islice(pieces, 2000)):
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        finally:
            _tokenizer(path).forget()

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text")).mapInArrow(settled(run), _PIECES)

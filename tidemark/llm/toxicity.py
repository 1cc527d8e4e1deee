"""Toxicity by averaged subword embeddings under a linear softmax.

A word is the bag of its character 3- to 5-grams, with an edge sign before and behind it; each gram has an embedding in a
hashed table. A word's vector is the mean of its grams' vectors, a passage's the mean of its words' vectors, and a linear
softmax of two classes reads it. Embeddings and softmax are trained jointly in numpy on labelled documents. A misspelling
that no document of the sample holds shares most grams with the word it comes from, so it is near it.

Insults are sparse: in the mean of a long text they fade. So texts are read as passages of ``PASSAGE_WORDS`` words, each
scored alone; a document is scored by its highest passage, in training as well (the loss of a document is that of this passage).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.attention_quality import held_out
from tidemark.llm.common import batches_of, settled, store, text_of

PASSAGE_WORDS = 48
#: A passage of fewer different words is averaged as if it had so many, the others saying nothing.
FEW_WORDS = 24
SIZES = (3, 4, 5)
BUCKETS = 1 << 17
WIDTH = 8
#: Bounds of the training sample: labelled documents, and their characters together.
SAMPLE_DOCS = 6000
SAMPLE_CHARS = 24 << 20
#: Characters that are encoded at once.
BLOCK_CHARS = 1 << 19
#: Grams of fewer documents of the sample, or nearer to the share of toxic documents than so many standard errors, are not learnt.
LEAST_DOCS = 3
LEAST_SIGMAS = 4.0
#: Means are scaled by this, so that a learning rate near one moves them; squared gradients are taken to begin at CALM.
SCALE, CALM = 100.0, 0.1
EPOCHS, BATCH, RATE, DECAY, SEED = 20, 64, 1.0, 1e-3, 11
THRESHOLD = 0.7
_ODD = np.uint32(0x9E3779B1)


def _letters(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points and whether each belongs to a word: digits, letters and all beyond ASCII, and a mark
    between two of those."""
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    plain = ((codes >= 97) & (codes <= 122)) | ((codes >= 48) & (codes <= 57)) | (codes >= 128)
    inner = np.zeros(len(codes), bool)
    inner[1:-1] = plain[:-2] & plain[2:] & (codes[1:-1] > 32) & (codes[1:-1] < 127)
    return codes, plain | inner


@dataclass
class Words:
    """Words of some texts in a row: their grams (bucket numbers in a row, edges between words), and where passages begin."""

    grams: np.ndarray
    first_gram: np.ndarray
    first_word: np.ndarray
    owner: np.ndarray


def encode_block(texts: list[str]) -> Words:
    """Passages of equal length, near ``PASSAGE_WORDS`` words, never across texts; ``owner`` is the text of each."""
    joined = "\n" + "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    begins = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
    codes, word = _letters(codes)
    kept = word.copy()
    kept[1:] |= word[:-1]  # one edge behind each word
    kept[0] = True
    stream = np.where(word, codes, 0)[kept]
    place = np.flatnonzero(kept)
    there = stream != 0
    heads = np.flatnonzero(there[1:] & ~there[:-1]) + 1
    if not len(heads):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none)
    of_text = np.searchsorted(begins, place[heads], "right") - 1
    per_text = np.bincount(of_text, minlength=len(texts))
    first = np.cumsum(per_text) - per_text
    parts = np.maximum(1, (per_text + PASSAGE_WORDS // 2) // PASSAGE_WORDS)
    passage = (np.arange(len(heads)) - first[of_text]) * parts[of_text] // per_text[of_text]
    first_word = np.flatnonzero((np.diff(passage, prepend=-1) != 0) | (np.diff(of_text, prepend=-1) != 0))
    # Windows of n signs whose inner signs are letters; the sign at either end may be an edge.
    word_of = np.cumsum(np.isin(np.arange(len(stream)), heads, assume_unique=True)) - 1
    found, owners = [], []
    value = stream[:-1] * _ODD + stream[1:]
    inner = np.ones(len(stream) - 1, bool)
    for n in range(3, max(SIZES) + 1):
        value = value[:-1] * _ODD + stream[n - 1 :]
        inner = inner[:-1] & there[n - 2 : len(stream) - 1]
        if n in SIZES:
            at = np.flatnonzero(inner)
            mixed = value[at] ^ (value[at] >> np.uint32(15))
            mixed = mixed * np.uint32(0x85EBCA6B) + np.uint32(n)
            found.append(((mixed ^ (mixed >> np.uint32(13))) % np.uint32(BUCKETS)).astype(np.int32))
            owners.append(word_of[at + 1])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    grams, owners = np.concatenate(found)[order], owners[order]
    counts = np.bincount(owners, minlength=len(heads))
    # A word that a passage repeats counts once. Words are told apart by all their grams.
    whole = np.add.reduceat((grams.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ** np.uint64(2), np.cumsum(counts) - counts)
    number = np.cumsum(np.isin(np.arange(len(heads)), first_word, assume_unique=True)) - 1
    _, kept_words = np.unique(whole ^ (number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), return_index=True)
    only = np.zeros(len(heads), bool)
    only[kept_words] = True
    counts, number = counts[only], number[only]
    first_kept = np.flatnonzero(np.diff(number, prepend=-1))
    return Words(grams[only[owners]], np.cumsum(counts) - counts, first_kept, of_text[first_word])


def _runs(values: np.ndarray, firsts: np.ndarray, least: int = 1) -> np.ndarray:
    """Means of the runs that begin at ``firsts``; a run shorter than ``least`` is filled up with zeros."""
    return np.add.reduceat(values, firsts) / np.maximum(np.diff(np.append(firsts, len(values))), least)


def margins(words: Words, pull: np.ndarray) -> np.ndarray:
    """Each passage's mean of its words' mean pull."""
    return _runs(_runs(pull[words.grams], words.first_gram), words.first_word, FEW_WORDS)


def blocks(texts: list[str]) -> Iterator[tuple[Words, np.ndarray]]:
    """Words of blocks of bounded size, and the position of each block's texts; a longer text is cut at white space."""
    group: list[str] = []
    places: list[int] = []
    held = 0
    for place, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = min(len(text), at + BLOCK_CHARS)
            if stop < len(text):
                stop = next((i for i in range(stop, at + BLOCK_CHARS // 2, -1) if text[i] in " \t\n\v\f\r"), stop)
            if group and held + stop - at > BLOCK_CHARS:
                yield encode_block(group), np.array(places)
                group, places, held = [], [], 0
            group.append(text[at:stop])
            places.append(place)
            held += stop - at
            at = stop
    if group:
        yield encode_block(group), np.array(places)


@dataclass
class Model:
    """What is left of embeddings and softmax for scoring: how far each gram moves the toxic class over the other."""

    pull: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        for words, places in blocks(texts):
            if len(words.owner):
                np.maximum.at(best, places[words.owner], margins(words, self.pull))
        best[np.isinf(best)] = 0.0
        return np.round(1 / (1 + np.exp(-np.clip(best + self.bias, -40, 40))), 6)


def told_apart(texts: list[str], y: np.ndarray) -> np.ndarray:
    """Which grams are learnt: those of ``LEAST_DOCS`` documents or more whose share of toxic ones differs from the
    share of all by over ``LEAST_SIGMAS`` standard errors. Others could only learn single documents by heart."""
    docs_of, toxic_of = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for words, places in blocks(texts):
        if len(words.owner):
            sizes = np.diff(np.append(words.first_gram, len(words.grams)))
            passage = np.repeat(np.arange(len(words.owner)), np.diff(np.append(words.first_word, len(sizes))))
            doc = np.repeat(places[words.owner[passage]], sizes)
            pairs = np.unique(doc.astype(np.int64) * BUCKETS + words.grams)
            docs_of += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
            toxic_of += np.bincount(pairs % BUCKETS, y[pairs // BUCKETS], minlength=BUCKETS)
    spread = np.sqrt(docs_of * y.mean() * (1 - y.mean()))
    return (docs_of >= LEAST_DOCS) & (np.abs(toxic_of - docs_of * y.mean()) > LEAST_SIGMAS * spread)


def train(texts: list[str], y: np.ndarray) -> Model:
    """Adagrad on the logistic loss of documents, each by its highest passage; deterministic for a given order of texts.

    Texts are encoded twice, so that only the grams that are learnt are held.
    """
    rng = np.random.default_rng(SEED)
    live = told_apart(texts, y)
    grams, weights, passages, docs = [], [], [], []
    number = 0
    for words, places in blocks(texts):
        if len(words.owner):
            sizes = np.diff(np.append(words.first_gram, len(words.grams)))
            length = np.diff(np.append(words.first_word, len(sizes)))
            passage = np.repeat(np.arange(len(length)), length)
            weight = np.repeat(SCALE / (sizes * np.maximum(length, FEW_WORDS)[passage]), sizes)
            kept = live[words.grams]
            grams.append(words.grams[kept])
            weights.append(weight[kept].astype(np.float32))
            passages.append(np.repeat(passage, sizes)[kept] + number)
            docs.append(places[words.owner])
            number += len(length)
    table = rng.normal(0, 0.01, (BUCKETS, WIDTH)).astype(np.float32) * live[:, None]
    seen = np.full((BUCKETS, 1), CALM, np.float32)
    softmax = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 2)).astype(np.float32)
    bias = np.log(np.array([1 - y.mean(), y.mean()])).astype(np.float32)
    if number:
        grams, weights, passages, docs = map(np.concatenate, (grams, weights, passages, docs))
        begins = np.searchsorted(passages, np.arange(number + 1))
        first_of = np.searchsorted(docs, np.arange(len(texts) + 1))
    steps, step = EPOCHS * -(-len(texts) // BATCH), 0
    for _ in range(EPOCHS if number else 0):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            chosen = np.array([j for j in order[i : i + BATCH] if first_of[j] < first_of[j + 1]], np.int64)
            if not len(chosen):
                continue
            pull = table @ (softmax[:, 1] - softmax[:, 0])
            best = []
            for j in chosen:
                low, high = begins[first_of[j]], begins[first_of[j + 1]]
                margin = np.bincount(passages[low:high] - first_of[j], weights[low:high] * pull[grams[low:high]], first_of[j + 1] - first_of[j])
                best.append(first_of[j] + int(np.argmax(margin)))
            at = np.concatenate([np.arange(begins[b], begins[b + 1]) for b in best])
            of_doc = np.repeat(np.arange(len(best)), [begins[b + 1] - begins[b] for b in best])
            values = table[grams[at]] * weights[at, None]
            z = np.stack([np.bincount(of_doc, values[:, k], len(best)) for k in range(WIDTH)], 1)
            logits = z @ softmax + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen].astype(int)] -= 1
            dz = p @ softmax.T
            there, place = np.unique(grams[at], return_inverse=True)
            moved = np.stack([np.bincount(place, weights[at] * dz[of_doc, k], len(there)) for k in range(WIDTH)], 1).astype(np.float32)
            seen[there] += (moved * moved).mean(1, keepdims=True)
            table *= 1 - np.minimum(rate * DECAY / np.sqrt(seen), 0.5)
            table[there] -= rate * moved / np.sqrt(seen[there])
            softmax -= (0.1 * rate * (z.T @ p) / len(chosen)).astype(np.float32)
            bias -= (0.1 * rate * p.mean(0)).astype(np.float32)
    return Model((SCALE * (table @ (softmax[:, 1] - softmax[:, 0]))).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Model | float:
    """A model from a bounded sample of labelled documents outside the held-out third.

    By order of a hash of the id: documents that have a label, up to ``SAMPLE_DOCS``, as long as their characters together
    stay within ``SAMPLE_CHARS``; whole texts are read. A document with several labels has the highest, an id with several
    texts has its first by a hash. With labels of one class or none the model is that class's share (or 0).
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out("doc_id"))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(key).cast("bigint").alias("label_id"), text_of(text).alias("text"))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    # The sample is chosen on ids, sizes and hashes; only the chosen texts travel.
    sizes = rows.select("label_id", F.length("text").alias("size"), F.xxhash64("text").alias("digest")).join(known, "label_id")
    one = sizes.groupBy("label_id", "toxic").agg(F.min(F.struct("digest", "size")).alias("m"))
    first = one.select("label_id", "toxic", "m.digest", "m.size").orderBy(*order).limit(SAMPLE_DOCS)
    held = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)  # over at most SAMPLE_DOCS rows
    chosen = store(first.withColumn("reached", F.sum("size").over(held)).filter(F.col("reached") <= SAMPLE_CHARS).drop("reached", "size"), "toxic_sample")
    found = (
        rows.join(F.broadcast(chosen), "label_id")  # at most SAMPLE_DOCS small rows
        .filter(F.xxhash64("text") == F.col("digest"))
        .groupBy("label_id", "toxic").agg(F.min("text").alias("text"))
    )
    sample = sorted(found.collect(), key=lambda r: r.label_id)
    y = np.array([float(r.toxic > 0) for r in sample])
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.0
    return train([r.text for r in sample], y)


def scored(docs: DataFrame, model: Model | float, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` (1 from ``THRESHOLD`` on) for every row.

    Whole texts are read; null, empty and wordless ones get the score that the softmax gives without evidence. Equal texts
    get equal scores, repeated rows are scored alike. An empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes a bucket, a parameter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches_of(batches, BLOCK_CHARS):
            texts = batch.column(1).to_pylist()
            score = own.score(texts) if isinstance(own, Model) else np.full(len(texts), own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(settled(run), "doc_id bigint, score double, predicted int")

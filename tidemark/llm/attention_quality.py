"""Quality classifier by attention over passages (multiple-instance learning).

A document is a bag of passages of 64 words. Every passage is encoded (byte pairs, character and repetition measures, one
hidden layer), gated attention weighs the passages, and the weighted sum of their codes is scored. Only documents are
labelled; the attention learns which passages decide. The model is small and trained on a bounded sample; its parameters
go to the tasks, which encode and score whole texts in blocks of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import batches_of, settled, store, text_of, utf8

PASSAGE_WORDS = 64
PAIRS = 256
MEASURES = 12
WIDTH = PAIRS + MEASURES
#: Bounds of the training sample: labelled documents, and their characters together; of each, all passages are learnt from.
SAMPLE_DOCS = 6000
SAMPLE_CHARS = 24 << 20
#: Bytes that are encoded at once; a longer text is cut at white space into blocks of this size.
BLOCK_BYTES = 1 << 19
HIDDEN, ATTENTION, EPOCHS, BATCH, SEED = 24, 16, 30, 128, 7

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_A, _B = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
_PAIR = ((_A * 167 + _B * 59 + (_A >> 3) * 13) % PAIRS).astype(np.int32).ravel()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _kind(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(256, np.float32)
    for low, high in ranges:
        out[low : high + 1] = 1
    return out


_KINDS = [
    _kind([(65, 90)]),
    _kind([(97, 122)]),
    _kind([(48, 57)]),
    _kind([(128, 255)]),
    _kind([(33, 33), (63, 63)]),
    _kind([(35, 38), (42, 42), (60, 60), (62, 62), (124, 124)]),
    _kind([(44, 46), (58, 59)]),
    _kind([(10, 10)]),
]


def _repeated(values: np.ndarray) -> np.ndarray:
    """Whether each value occurs elsewhere in ``values``."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = np.zeros(len(values) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.empty(len(values), bool)
    out[order] = same[1:] | same[:-1]
    return out


def encode_block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the text of each; a text without words has one empty passage."""
    data = np.frombuffer(b"\n".join(texts) + b"\n\n", np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    space = _SPACE[data]
    starts = np.flatnonzero(~space[1:-1] & space[:-2]) + 1
    if len(data) and not space[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.zeros((len(texts), WIDTH), np.float32), np.arange(len(texts))
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    of_text = np.searchsorted(begins, starts, "right") - 1
    first = np.searchsorted(of_text, np.arange(len(texts)))
    in_text = np.arange(len(starts)) - first[of_text]
    heads = np.flatnonzero(in_text % PASSAGE_WORDS == 0)
    passages = len(heads)
    words = np.diff(np.append(heads, len(starts)))
    owner = of_text[heads]
    # A passage's bytes reach to the next passage or to the end of its text, never into the next text.
    text_ends = begins + np.array([len(t) for t in texts])
    spans = np.minimum(np.append(starts[heads][1:], len(data)), text_ends[owner]) - starts[heads]
    edges = np.cumsum(spans) - spans
    at = np.repeat(starts[heads] - edges, spans) + np.arange(spans.sum())
    of_byte = np.repeat(np.arange(passages, dtype=np.int32), spans)
    own = data[at]
    cells = of_byte * PAIRS + _PAIR[(own.astype(np.int32) << 8) | data[at + 1]]
    pairs = np.bincount(cells, minlength=passages * PAIRS).reshape(passages, PAIRS)
    x = np.zeros((passages, WIDTH), np.float32)
    x[:, :PAIRS] = np.sqrt(pairs / spans[:, None])
    for i, kind in enumerate(_KINDS):
        x[:, PAIRS + i] = np.add.reduceat(kind[own], edges) / spans
    # Words as hashes of all their bytes; repetition is seen per text of the block.
    weights = np.cumprod(np.full(64, _ODD), dtype=np.uint64)
    lengths = ends - starts
    begun = np.zeros(len(data), np.int64)
    begun[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(begun)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _ODD), dtype=np.uint64)
    worth = np.where(space, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * powers[np.minimum(place, len(powers) - 1)])
    code = np.add.reduceat(worth, starts)
    code += lengths.astype(np.uint64) * weights[20] + of_text.astype(np.uint64) * weights[40]
    code ^= code >> np.uint64(29)
    windows = code.copy()
    windows[2:] += code[1:-1] * weights[1] + code[:-2] * weights[2]
    windows[:2] += np.arange(min(2, len(code)), dtype=np.uint64) + weights[50]
    per = lambda flags: np.add.reduceat(flags.astype(np.float32), heads) / words
    x[:, PAIRS + 8] = per(_repeated(windows))
    x[:, PAIRS + 9] = per(_repeated(code))
    x[:, PAIRS + 10] = per(lengths)
    x[:, PAIRS + 11] = np.log1p(words)
    empty = np.setdiff1d(np.arange(len(texts)), owner)
    if len(empty):
        x = np.concatenate([x, np.zeros((len(empty), WIDTH), np.float32)])
        owner = np.concatenate([owner, empty])
    return x, owner


def blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of passages with the position of their text, in blocks of bounded size."""
    group: list[bytes] = []
    places: list[int] = []
    held = 0
    for place, text in enumerate(texts):
        at = 0
        while True:
            stop = min(len(text), at + BLOCK_BYTES)
            while stop < len(text) and stop > at + 1 and text[stop] not in b" \t\n\x0b\x0c\r" and stop > at + BLOCK_BYTES // 2:
                stop -= 1
            part = text[at:stop]
            if group and held + len(part) > BLOCK_BYTES:
                x, owner = encode_block(group)
                yield x, np.array(places)[owner]
                group, places, held = [], [], 0
            group.append(part)
            places.append(place)
            held += len(part)
            at = stop
            if at >= len(text):
                break
    if group:
        x, owner = encode_block(group)
        yield x, np.array(places)[owner]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        w = self.weights
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["w"] + w["b"])
        t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        return x, h, t, g, np.exp(np.clip((t * g) @ w["a"], -20, 20))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Scores of whole texts: sums of weights and weighted codes are added over the blocks of a text."""
        total = np.zeros(len(texts))
        code = np.zeros((len(texts), HIDDEN))
        for x, owner in blocks(texts):
            _, h, _, _, e = self.parts(x)
            np.add.at(total, owner, e)
            np.add.at(code, owner, h * e[:, None])
        z = code / total[:, None]
        return np.round(_sigmoid(z @ self.weights["c"] + self.weights["d"][0]), 6)


def train(bags: list[np.ndarray], y: np.ndarray) -> Model:
    """Adam on the logistic loss of whole documents; deterministic for a given order of bags."""
    rng = np.random.default_rng(SEED)
    every = np.concatenate(bags).astype(np.float32)
    mean, scale = every.mean(0), np.maximum(every.std(0), 1e-3)
    shape = {"w": (WIDTH, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    w = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    model = Model(mean, scale, w)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            chosen = order[i : i + BATCH]
            sizes = np.array([len(bags[j]) for j in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            edges = np.cumsum(sizes) - sizes
            x, h, t, g, e = model.parts(np.concatenate([bags[j] for j in chosen]).astype(np.float32))
            a = e / np.add.reduceat(e, edges)[owner]
            z = np.add.reduceat(h * a[:, None], edges)
            p = _sigmoid(z @ w["c"] + w["d"][0])
            d = (p - y[chosen]) / len(chosen)
            dz = d[:, None] * w["c"]
            da = (h * dz[owner]).sum(1)
            ds = a * (da - np.add.reduceat(a * da, edges)[owner])
            dt, dg = ds[:, None] * w["a"] * g * (1 - t * t), ds[:, None] * w["a"] * t * g * (1 - g)
            dh = a[:, None] * dz[owner] + dt @ w["v"].T + dg @ w["u"].T
            dn = dh * (1 - h * h)
            grads = {"w": x.T @ dn + 1e-4 * w["w"], "b": dn.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ ds, "c": z.T @ d, "d": d.sum(keepdims=True)}
            step += 1
            rate = 0.01 * min(1.0, step / 20) * (1 - 0.8 * epoch / EPOCHS)
            for k, grad in grads.items():
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels may not be learnt."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Model | float:
    """A model from labelled documents outside the held-out third, by order of a hash of the id.

    Documents that have a label, up to ``SAMPLE_DOCS``, as long as their characters together stay within ``SAMPLE_CHARS``.
    A document with several labels has the lowest, an id with several texts has its first by a hash. With labels of one class or none it is that class's share (or 0.5).
    """
    known = (
        labels.filter("doc_id is not null and quality is not null").filter(~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.min("quality").alias("quality"))
    )
    rows = docs.select(F.col(key).cast("bigint").alias("label_id"), text_of(text).alias("text"))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    # The sample is chosen on ids, sizes and hashes; only the chosen texts are encoded, one of each id.
    sizes = rows.select("label_id", F.length("text").alias("size"), F.xxhash64("text").alias("digest")).join(known, "label_id")
    one = sizes.groupBy("label_id", "quality").agg(F.min(F.struct("digest", "size")).alias("m"))
    first = one.select("label_id", "quality", "m.digest", "m.size").orderBy(*order).limit(SAMPLE_DOCS)
    held = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)  # over at most SAMPLE_DOCS rows
    chosen = first.withColumn("reached", F.sum("size").over(held)).filter(F.col("reached") <= SAMPLE_CHARS).select("label_id", "quality", "digest")
    chosen = store(chosen, "quality_sample")
    sample = (
        rows.join(F.broadcast(chosen), "label_id")  # at most SAMPLE_DOCS small rows
        .filter(F.xxhash64("text") == F.col("digest"))
        .groupBy("label_id", "quality").agg(F.min("text").alias("text"))
    )

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, BLOCK_BYTES):
            texts = utf8(batch.column(2))
            own: list[list[np.ndarray]] = [[] for _ in texts]
            for x, owner in blocks(texts):
                for place in np.unique(owner):
                    own[place].append(x[owner == place].astype(np.float16))
            made = []
            for parts in own:
                made.append(np.concatenate(parts).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), pa.array(made, pa.binary())], names=["label_id", "quality", "bag"])

    found = sample.mapInArrow(bags, "label_id bigint, quality int, bag binary").collect()
    found = sorted(found, key=lambda r: r.label_id)
    y = np.array([float(r.quality > 0) for r in found], np.float32)
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.5
    return train([np.frombuffer(r.bag, np.float16).reshape(-1, WIDTH) for r in found], y)


def scored(docs: DataFrame, model: Model | float, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` for every row; a null or empty text is one empty passage.

    Equal texts get equal scores up to rounding. An empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few ten kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches_of(batches, BLOCK_BYTES):
            texts = utf8(batch.column(1))
            score = own.score(texts) if isinstance(own, Model) else np.full(len(texts), own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose text the model accepts, with all their columns."""
    model = fit(docs, labels, text, key)
    rows = docs.select(F.struct("*").alias("row"), text_of(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches_of(batches, BLOCK_BYTES):
            texts = utf8(batch.column(1))
            good = own.score(texts) >= 0.5 if isinstance(own, Model) else np.full(len(texts), own >= 0.5)
            kept = batch.column(0).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept], names=["row"])

    return rows.mapInArrow(settled(run), StructType([rows.schema["row"]])).select("row.*")

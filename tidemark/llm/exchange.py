"""Corpus-wide counts of fingerprints without a row per fingerprint.

Documents are dealt into chunks of bounded size. Each chunk sends its distinct fingerprints, sorted and packed, to the
buckets of the fingerprint space; a bucket adds the counts of all chunks and answers every chunk with one byte per
fingerprint, in the order asked. A chunk is the same set of rows whenever it is read, so the answer needs no keys. A hot
fingerprint is one entry per chunk, however often it occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
#: Low bytes of a fingerprint that are sent; the bucket is a range of the rest. A collision only raises a count.
SENT = 5
ASKED = "bucket bigint, chunk bigint, payload binary"
ANSWER = "chunk bigint, bucket bigint, payload binary"
NO_ID = np.iinfo(np.int64).max


def pieces(total_bytes: int) -> tuple[int, int]:
    """Numbers of chunks and of buckets for texts of so many bytes."""
    return max(1, -(-total_bytes // CHUNK_BYTES)), max(1, -(-total_bytes // BUCKET_BYTES))


def chunk_of(doc_id: str, n_bytes: Column, chunks: int) -> Column:
    """The chunk of a row, by a hash of id and length; the length keeps rows without an id apart."""
    return F.pmod(F.xxhash64(F.col(doc_id), n_bytes.cast("int")), F.lit(chunks))


def dealt(docs: DataFrame, chunks: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``chunk``, ``doc_id``, ``text`` (null: empty)."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.select(chunk_of("doc_id", F.octet_length("text"), chunks).alias("chunk"), "doc_id", "text")


def in_order(rows: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids (the largest integer for null) and texts of a chunk in an order that does not depend on its arrival."""
    ids = np.array([NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()], np.int64)
    column = rows.column("text")
    large = pa.types.is_large_string(column.type)
    texts = column.cast(pa.large_binary() if large else pa.binary()).to_pylist()
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order]


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(prints: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each print: equal ranges of its high bits, so sorted prints are sorted by bucket."""
    high = 64 - 8 * SENT
    return ((prints >> np.uint64(8 * SENT)) * np.uint64(buckets)) >> np.uint64(high)


def bucket_bounds(prints: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket_of(prints, buckets), np.arange(buckets + 1, dtype=np.uint64))


def questions(chunk: int, prints: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """One row per bucket: the low bytes of the sorted distinct prints, then one byte of count each."""
    bounds = bucket_bounds(prints, buckets)
    low = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8)[:, :SENT]
    few = np.minimum(counts, 255).astype(np.uint8)
    found = [b for b in range(buckets) if bounds[b] < bounds[b + 1]]
    made = [low[bounds[b] : bounds[b + 1]].tobytes() + few[bounds[b] : bounds[b + 1]].tobytes() for b in found]
    return pa.table(
        {
            "bucket": pa.array(found, pa.int64()),
            "chunk": pa.array([chunk] * len(found), pa.int64()),
            "payload": pa.array(made, pa.binary()),
        }
    )


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte: themselves up to 127, then eight steps to each doubling."""
    high = 128 + np.floor(8 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts < 128, counts, np.minimum(high, 255)).astype(np.uint8)


def answers(rows: pa.Table) -> pa.Table:
    """For one bucket: the summed counts of all chunks, back to each chunk in its order."""
    payloads = rows.column("payload").to_pylist()
    sizes = [len(p) // (SENT + 1) for p in payloads]
    values = np.zeros(sum(sizes), np.uint64)
    counts = np.zeros(len(values), np.int64)
    at = 0
    for p, n in zip(payloads, sizes, strict=True):
        raw = np.frombuffer(p, np.uint8)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :SENT] = raw[: n * SENT].reshape(n, SENT)
        values[at : at + n] = wide.view(np.uint64).ravel()
        counts[at : at + n] = raw[n * SENT :]
        at += n
    order = np.argsort(values)
    ordered = values[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if at else np.zeros(0, int)
    sums = np.add.reduceat(counts[order], starts) if at else counts
    codes = np.empty(at, np.uint8)
    codes[order] = np.repeat(coded(sums), np.diff(np.append(starts, at)))
    ends = np.cumsum(sizes)
    return pa.table(
        {
            "chunk": rows.column("chunk"),
            "bucket": rows.column("bucket"),
            "payload": pa.array([codes[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary()),
        }
    )


def read_answers(prints: np.ndarray, buckets: int, told: dict[int, bytes]) -> np.ndarray:
    """The codes of the sorted distinct ``prints`` of a chunk from the payload of each bucket."""
    bounds = bucket_bounds(prints, buckets)
    return np.frombuffer(b"".join(told[b] for b in range(buckets) if bounds[b] < bounds[b + 1]), np.uint8)


def answered(asked: DataFrame) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(lambda _, rows: answers(rows), ANSWER)

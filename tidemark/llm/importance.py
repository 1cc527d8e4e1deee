"""Importance resampling towards a target set by hashed n-grams, with prefix CRCs.

A text is brought to words joined by one space and scanned once: the running CRC-32 is stored behind every word. CRCs are
linear over GF(2), so the CRC of any run of words is the running CRC at its end, plus (xor) the one at its start moved on by
the run's length. Moving on by ``n`` bytes is a 32 x 32 bit matrix for each power of two in ``n``, held as four tables of 256
words. An n-gram's bucket is its CRC modulo the number of buckets. Counts over all texts and over the target texts give each
bucket a gain, the floored mean of a text's gains is its weight, and the weights plus a Gumbel noise fixed by the id are
drawn from the top.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, settled, store, text_of, utf8
from tidemark.operators.ranking import number_all

BUCKETS = 10_000
MAX_WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
_BATCH_BYTES = 4 << 20
_FEATURES = "doc_id bigint, n_words bigint, n_features bigint, buckets binary"

#: ASCII digits and letters (lower-cased) and all bytes of other characters stand; everything else is a separator.
_LETTERS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def _byte_table() -> np.ndarray:
    """The CRC-32 register after one byte, reflected polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_BYTE = _byte_table()


def _moved(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map given by four tables, one for each byte of the word."""
    return tables[0][crc & 0xFF] ^ tables[1][(crc >> 8) & 0xFF] ^ tables[2][(crc >> 16) & 0xFF] ^ tables[3][crc >> 24]


@lru_cache(maxsize=64)
def _shift(power: int) -> np.ndarray:
    """Tables of the shift by 2**power zero bytes: the one of a byte, squared ``power`` times."""
    every = np.arange(256, dtype=np.uint32)
    if power == 0:
        words = np.stack([every << np.uint32(8 * k) for k in range(4)])
        return _BYTE[words & 0xFF] ^ (words >> 8)
    half = _shift(power - 1)
    return np.stack([_moved(half, half[k]) for k in range(4)])


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs moved on by so many bytes each."""
    out, power = crc.astype(np.uint32), 0
    rest = lengths.astype(np.uint64)
    while rest.any():
        odd = (rest & np.uint64(1)).astype(bool)
        out[odd] = _moved(_shift(power), out[odd])
        rest >>= np.uint64(1)
        power += 1
    return out


def normalised(text: bytes) -> list[bytes]:
    """Lower-case words of a UTF-8 text."""
    return text.translate(_LETTERS).split()


def ngram_crcs(texts: list[bytes], longest: int = MAX_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every run of 1 to ``longest`` words, the text of each, and the words of each text."""
    rows = [normalised(t) for t in texts]
    words = np.array([len(r) for r in rows], np.int64)
    flat = [w for r in rows for w in r]
    if not flat:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), words
    # One scan over " word word ...": the CRC behind each word; one more space leads to the start of the next.
    behind = np.fromiter(accumulate(flat, lambda crc, word: zlib.crc32(word, zlib.crc32(b" ", crc)), initial=0), np.uint32, len(flat) + 1)
    register = behind[:-1] ^ np.uint32(0xFFFFFFFF)
    begin = (_BYTE[(register ^ 0x20) & 0xFF] ^ (register >> 8)) ^ np.uint32(0xFFFFFFFF)
    stop = np.cumsum([len(w) + 1 for w in flat])
    start = stop - np.array([len(w) for w in flat])
    owner = np.repeat(np.arange(len(texts)), words)
    crcs, owners = [], []
    for n in range(1, longest + 1):
        last = np.arange(n - 1, len(flat))
        first = last - (n - 1)
        same = owner[first] == owner[last]
        first, last = first[same], last[same]
        crcs.append(behind[1:][last] ^ shifted(begin[first], stop[last] - start[first]))
        owners.append(owner[first])
    return np.concatenate(crcs), np.concatenate(owners), words


def features(docs: DataFrame, text: str, key: str, longest: int, buckets: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and the bucket of every feature (little-endian, 16 or 32 bits)."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, _BATCH_BYTES):
            crcs, owner, words = ngram_crcs(utf8(batch.column(1)), longest)
            place = (crcs % np.uint32(buckets)).astype(kind)[np.argsort(owner, kind="stable")]
            counts = np.bincount(owner, minlength=batch.num_rows)
            data = place.tobytes()
            edges = [0, *(np.cumsum(counts) * place.itemsize).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(counts.astype(np.int64)), pa.array([data[a:b] for a, b in zip(edges, edges[1:], strict=False)], pa.binary())],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(settled(run), _FEATURES)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(found: DataFrame, buckets: int) -> DataFrame:
    """``bucket``, ``n`` over all features; every task sends each bucket once."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(data, kind), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["bucket", "n"])

    sent = found.select("buckets").mapInArrow(run, "bucket int, n bigint")
    return sent.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Each bucket's gain: 1000 times the log of the smoothed rates' ratio, floored. Collects a row a bucket, a parameter."""
    s, t = ({r.bucket: r.n for r in counts.collect()} for counts in (source, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    return np.array([
        math.floor(1000 * math.log(float(t.get(b, 0) + 1) * float(all_s + buckets) / (float(s.get(b, 0) + 1) * float(all_t + buckets))))
        for b in range(buckets)
    ], np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by the id: the first 32 bits of SHA-256 of ``seed:id``."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def weighted(found: DataFrame, gain: np.ndarray, buckets: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``: the floored mean gain of a text's features, 0 without any."""
    shared = found.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket, a parameter
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            parts = [np.frombuffer(data, kind) for data in batch.column(3).to_pylist()]
            mean = [int(own[p].sum()) // len(p) if len(p) else 0 for p in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(mean, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def drawn(scores: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows with ``rank``: 1, 2, 3 ... down the scores (ties by id, nulls last) for the drawn share, else null.

    Scores are whole numbers in a narrow range, so a grouping by score gives the place of every score in the order, and
    only rows at or above the cut are sorted, each score on its own.
    """
    able = scores.filter(F.col("n_words") >= least_words)
    sizes = store(able.groupBy("score").agg(F.count(F.lit(1)).alias("size")), "score_sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    take = total * percent // 100
    if not take:
        return scores.withColumn("rank", F.lit(None).cast("bigint"))
    down = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reached = sizes.withColumn("reached", F.sum("size").over(down)).filter(F.col("reached") >= take)
    cut = reached.agg(F.max("score").alias("cut")).first().cut  # of distinct scores: some ten thousand whatever the corpus holds
    inside = F.coalesce((F.col("n_words") >= least_words) & (F.col("score") >= cut), F.lit(False))
    ranked = number_all(scores.filter(inside), -F.col("score"), [F.col("doc_id").asc_nulls_last()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")).cast("bigint"))
    return ranked.unionByName(scores.filter(~inside).withColumn("rank", F.lit(None).cast("bigint")))


def resampled(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text",
    longest: int = MAX_WORDS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` (null: not drawn).

    Null and empty texts have no features and weigh 0; a null id has the noise of an empty id and comes last among ties;
    repeated rows are each drawn on their own, and their features count again. An empty table gives no rows, empty targets
    give gains against uniform buckets. Other columns are not read.
    """
    found = store(features(docs, text, key, longest, buckets), "features")
    aim = features(target.select(target_text, F.lit(None).alias(key)), target_text, key, longest, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aim, buckets), buckets)
    scores = weighted(found, gain, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return drawn(store(scores, "scores"), least_words, percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank")

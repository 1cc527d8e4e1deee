"""Exact duplicates by content sort.

Sampled splitters range-partition the normalised texts, an external sort makes equal texts neighbours, and one pass over
each sorted partition compares every text with the whole text before it. The range key is a head of the text, the digest
of the whole text, and the document's id: a group of copies of any size is spread over as many partitions as its rows
need, and the splitters that reach the driver have a fixed size. A run of equal texts that is cut by a partition border is
put together from at most two records per partition. Of a run a task keeps the ids, and the texts of one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, numbered, settled, store, text_of

#: Characters of a text that take part in the range key.
HEAD_CHARS = 32
_RUNS = "doc_id {0}, text_sha256 string, head_id {0}, run_size bigint, run_first boolean, edge boolean"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in sort order to rows with the first id and the size of their run of equal texts in this partition."""
    names = ["doc_id", "text_sha256", "head_id", "run_size", "run_first", "edge"]
    held: list[pa.Array] = []  # ids of the run that is still open, by batch
    held_digest = None
    before = None
    first = True

    def rows(ids: pa.Array, digests: pa.Array, starts: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.append(starts, len(ids)))
        firsts = np.zeros(len(ids), bool)
        firsts[starts] = True
        heads = ids.take(pa.array(np.repeat(starts, sizes)))
        return pa.RecordBatch.from_arrays(
            [
                ids,
                digests,
                heads,
                pa.array(np.repeat(sizes, sizes), pa.int64()),
                pa.array(firsts),
                pa.array(np.repeat(edge, sizes)),
            ],
            names=names,
        )

    def hold(ids: pa.Array) -> None:
        # A copy: a slice would keep its whole batch, with all texts, as long as the run is open.
        held.append(ids.take(pa.array(np.arange(len(ids)))))

    def close(edge: bool) -> Iterator[pa.RecordBatch]:
        size, head = sum(len(x) for x in held), held[0].slice(0, 1)
        for i, ids in enumerate(held):
            n = len(ids)
            heads = head.take(pa.array(np.zeros(n, np.int64)))
            firsts = pa.array(np.arange(n) + i == 0)
            sizes, edges = pa.array(np.full(n, size), pa.int64()), pa.array(np.full(n, edge))
            yield pa.RecordBatch.from_arrays([ids, pa.repeat(held_digest, n), heads, sizes, firsts, edges], names=names)
        held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, digests, body = batch.column(0), batch.column(1), batch.column(2)
        same = np.zeros(len(body), bool)
        same[0] = before is not None and body[0].as_py() == before
        if len(body) > 1:
            same[1:] = pc.equal(body.slice(1), body.slice(0, len(body) - 1)).to_numpy(zero_copy_only=False)
        before = body[len(body) - 1].as_py()
        starts = np.flatnonzero(~same)
        if not len(starts):
            hold(ids)
            continue
        if starts[0] > 0:
            hold(ids.slice(0, starts[0]))
        if held:
            yield from close(first)
            first = False
        if len(starts) > 1:
            a, b = int(starts[0]), int(starts[-1])
            edge = np.zeros(len(starts) - 1, bool)
            edge[0], first = first, False
            yield rows(ids.slice(a, b - a), digests.slice(a, b - a), starts[:-1] - a, edge)
        hold(ids.slice(int(starts[-1])))
        held_digest = pa.scalar(digests[int(starts[-1])].as_py(), digests.type)
    if held:
        yield from close(True)


def duplicate_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after each run of white space became one space; null is the empty text, so all null
    and empty texts are one group. Of equal texts the row with the smallest id stays; a null id counts as the largest.
    Of repeated rows with that same id one stays. An empty table gives no rows; other columns are not read.
    """
    return _groups(docs, text, F.col(key).cast("bigint"), "bigint")


def _groups(docs: DataFrame, text: str, rank: Column, kind: str) -> DataFrame:
    """``duplicate_groups`` with ``rank``, of this type, for the id: of equal texts the row with the smallest stays."""
    body = F.regexp_replace(text_of(text), SPACES, " ")
    rows = docs.select(rank.alias("doc_id"), body.alias("body")).select(
        "doc_id", F.sha2("body", 256).alias("text_sha256"), "body", F.left("body", F.lit(HEAD_CHARS)).alias("head")
    )
    order = [F.col("head"), F.col("text_sha256"), F.col("doc_id").asc_nulls_last()]
    runs = store(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("head").mapInArrow(settled(_neighbours), _RUNS.format(kind)),
        "content-sort",
    )
    # At most two edge runs per partition, so this side has a fixed number of small rows.
    edges = (
        runs.filter("edge and run_first")
        .groupBy("text_sha256")
        .agg(F.min("head_id").alias("whole_id"), F.sum("run_size").alias("whole_size"))
    )
    joined = runs.join(F.broadcast(edges), "text_sha256", "left")
    keep = F.when(F.col("edge"), F.col("whole_id")).otherwise(F.col("head_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.when(F.col("edge"), F.col("whole_size")).otherwise(F.col("run_size")).alias("group_size"),
        (F.col("run_first") & F.col("head_id").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all their columns."""
    rows, row = numbered(docs, "exact-rows")
    doc_id = F.col(key).cast("bigint")
    rank = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), F.col(row).alias("row"))
    gone = _groups(rows, text, rank, "struct<no_id: boolean, id: bigint, row: bigint>").filter("not kept")
    # Stored, its size is known before the join is planned: the texts are shuffled only if it is large.
    return rows.join(store(gone.select(F.col("doc_id.row").alias(row)), "gone"), row, "left_anti").select(*docs.columns)

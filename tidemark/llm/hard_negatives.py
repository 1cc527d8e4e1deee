"""Hard negatives through a table of blocks along a Hilbert curve, with zone maps.

Vectors become whole numbers; rows of one label lie along a Hilbert curve and are stored as Parquet rows of up to ``BLOCK``
vectors each (a block), beside the smallest and largest value of every dimension (its zone map). Anchors are taken from the
same order in groups. For a group, interval arithmetic gives the least and the largest score that an anchor can have with any
vector of a block; a block is read if it can hold one of the anchor's nearest rows of its label, or a row of another label in
a window below one of its positives. The first scan finds positives, the second negatives; both are exact.

Groups meet zone maps in cells of bounded size, and the chosen blocks in parts of bounded size; only each part's best rows
per anchor (or window) leave it. With boxes that are wide in all dimensions, as those of unordered vectors are, few blocks
can be left out and the work is that of comparing all anchors with all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled, store

SCALE = 256
#: Vectors of a block, anchors of a group, zone maps and groups of a cell, blocks of a part.
BLOCK, GROUP, ZONES, GROUPS, PART = 256, 512, 4096, 8, 64
#: Bits a dimension on the curve's grid.
BITS = 4
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies within these hundredths of the positive's.
LOW, HIGH = 30, 90
_MOST = 1 << 62  # components and scores beyond this count as this

_ROWS = "row bigint, vec_id bigint, label bigint, vec binary"
_BLOCKS = "block bigint, label bigint, n int, rows binary, ids binary, vecs binary, low binary, high binary, floors binary"
_GROUPS = "g bigint, m int, labels binary, rows binary, ids binary, vecs binary, floors binary"


def _numbers(data: bytes, width: int | None = None) -> np.ndarray:
    values = np.frombuffer(data, "<i8")
    return values if width is None else values.reshape(-1, width)


def _vectors(data: bytes, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width) if width else np.zeros((0, 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two sets of whole vectors, exact; in floating point where every sum stays below 2**53."""
    most = a.shape[1] * max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0)))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < _MOST:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -_MOST, _MOST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each vector with any point of each box, widened by what rounding may cost."""
    up, down = np.maximum(a, 0).astype(float), np.minimum(a, 0).astype(float)
    low, high = low.T.astype(float), high.T.astype(float)
    slack = 1 + 1e-9 * (np.abs(a).astype(float) @ np.maximum(np.abs(low), np.abs(high)))
    return up @ low + down @ high - slack, up @ high + down @ low + slack


def hilbert_keys(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve, as rows of bytes that sort in curve order. ``grid`` has points in rows, values below 2**bits."""
    x = grid.T.astype(np.uint32).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(dims):
            high = (x[i] & np.uint32(q)) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(high, p, swap).astype(np.uint32)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8), axis=0).T.copy()


def best(scores: np.ndarray, open_to: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``scores`` the places of its ``k`` highest values where ``open_to``, ties by id, then by row number."""
    held = np.where(open_to, scores, np.iinfo(np.int64).min)
    if held.shape[1] > k:
        least = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        open_to = open_to & (held >= least[:, None])
    of, at = np.nonzero(open_to)
    order = np.lexsort((rows[at], ids[at], -held[of, at], of))
    of, at = of[order], at[order]
    first = np.searchsorted(of, np.arange(len(scores)))
    taken = np.arange(len(of)) - first[of] < k
    return of[taken], at[taken]


def quantised(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``row``, ``vec_id``, ``label``, ``vec`` (64-bit whole numbers) of the rows that take part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias(vector)
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull())
    rows = rows.filter(fine.cast("boolean")).withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            column = batch.column(2)
            flat = np.floor(np.asarray(column.flatten(), float) * SCALE)
            whole = np.clip(flat, -float(_MOST), float(_MOST)).astype("<i8").tobytes()
            edges = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]) * 8
            vecs = [whole[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(vecs))), batch.column(0), batch.column(1), pa.array(vecs, pa.binary())],
                names=["row", "vec_id", "label", "vec"],
            )
            number += len(vecs)

    return store(rows.select("vec_id", "label", vector).mapInArrow(run, _ROWS), "quantised")


def ranges(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each dimension; shorter vectors end in zeros. Collects a row a dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                v = _numbers(data)
                width = max(len(v), len(low))
                low, high, v = (np.pad(x, (0, width - len(x))) for x in (low, high, v))
                low, high = np.minimum(low, v), np.maximum(high, v)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    found = rows.select("vec").mapInArrow(run, "d bigint, low bigint, high bigint").groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    found = sorted(found.collect(), key=lambda r: r.d)
    return np.array([r.low for r in found], np.int64), np.array([r.high for r in found], np.int64)


def _kind(low: np.ndarray, high: np.ndarray) -> str:
    most = max(int(np.abs(low).max(initial=0)), int(np.abs(high).max(initial=0)))
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"


def blocks_of(rows: DataFrame, low: np.ndarray, high: np.ndarray, anchor_every: int, positives: int) -> DataFrame:
    """Blocks in curve order with zone maps. ``floors``: for an anchor, a score that ``positives`` rows of its block reach."""
    width, kind = len(low), _kind(low, high)
    widest = np.argsort(-(high.astype(float) - low), kind="stable")  # these dimensions turn first along the curve

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = (high.astype(float) - low) + 1
        for batch in batches:
            full = np.zeros((batch.num_rows, width), np.int64)
            for i, data in enumerate(batch.column(3).to_pylist()):
                v = _numbers(data)
                full[i, : len(v)] = v
            grid = np.minimum((full - low.astype(float)) * (1 << BITS) / span, (1 << BITS) - 1)
            keys = hilbert_keys(grid[:, widest]) if width else np.zeros((batch.num_rows, 0), np.uint8)
            vecs = [v.tobytes() for v in full.astype(kind)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(vecs, pa.binary())],
                names=["row", "vec_id", "label", "place", "vec"],
            )

    def pack(label: int, block: int, held: list[tuple]) -> dict:
        own = np.array([r for r, _, _ in held], "<i8")
        ids = np.array([i for _, i, _ in held], "<i8")
        vecs = _vectors(b"".join(v for _, _, v in held), kind, width) if width else np.zeros((len(held), 0), kind)
        floors = np.full(len(held), -_MOST, "<i8")
        anchors = np.flatnonzero(ids % anchor_every == 0)
        if len(anchors) and len(held) > positives:
            scores = products(vecs[anchors], vecs)
            scores[np.arange(len(anchors)), anchors] = -_MOST
            floors[anchors] = np.partition(scores, len(held) - positives, axis=1)[:, len(held) - positives]
        return {
            "block": block, "label": label, "n": len(held), "rows": own.tobytes(), "ids": ids.tobytes(), "vecs": vecs.tobytes(),
            "low": vecs.min(0).astype("<i8").tobytes(), "high": vecs.max(0).astype("<i8").tobytes(), "floors": floors.tobytes(),
        }

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, of, held = TaskContext.get().partitionId() << 33, None, []
        for batch in batches:
            made = []
            for row, vec_id, label, vec in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (label != of or len(held) == BLOCK):
                    made.append(pack(of, number, held))
                    number, held = number + 1, []
                of = label
                held.append((row, vec_id, vec))
            if made:
                yield pa.RecordBatch.from_pylist(made, block_schema)
        if held:
            yield pa.RecordBatch.from_pylist([pack(of, number, held)], block_schema)

    block_schema = _schema(_BLOCKS)
    placed = rows.mapInArrow(keyed, "row bigint, vec_id bigint, label bigint, place binary, vec binary")
    order = ["label", "place", "row"]
    lying = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "vec_id", "label", "vec")
    return store(lying.mapInArrow(settled(packed), _BLOCKS), "vector_blocks")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def anchor_groups(blocks: DataFrame, anchor_every: int, kind: str, width: int) -> DataFrame:
    """Anchors in curve order, up to ``GROUP`` together."""

    def out_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = _numbers(b["ids"])
                at = np.flatnonzero(ids % anchor_every == 0)
                if len(at):
                    vecs = _vectors(b["vecs"], kind, width)[at] if width else np.zeros((len(at), 0), kind)
                    columns = [np.full(len(at), b["block"]), at, np.full(len(at), b["label"]), _numbers(b["rows"])[at], ids[at], _numbers(b["floors"])[at]]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, columns), pa.array([v.tobytes() for v in vecs], pa.binary())],
                        names=["block", "at", "label", "row", "vec_id", "least", "vec"],
                    )

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 33, []

        def group() -> pa.RecordBatch:
            label, row, vec_id, least, vec = zip(*held, strict=True)
            packed = [np.array(c, "<i8").tobytes() for c in (label, row, vec_id)]
            values = [number, len(held), *packed, b"".join(vec), np.array(least, "<i8").tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(group_schema.names, values, strict=True))], group_schema)

        for batch in batches:
            for anchor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(anchor)
                if len(held) == GROUP:
                    yield group()
                    number, held = number + 1, []
        if held:
            yield group()

    group_schema = _schema(_GROUPS)
    anchors = store(
        blocks.select("block", "label", "rows", "ids", "vecs", "floors")
        .mapInArrow(out_of, "block bigint, at bigint, label bigint, row bigint, vec_id bigint, least bigint, vec binary"),
        "anchors",
    )
    order = ["label", "block", "at"]
    dealt = anchors.repartitionByRange(max(1, -(-anchors.count() // GROUP)), *order).sortWithinPartitions(*order)
    return store(dealt.select("label", "row", "vec_id", "least", "vec").mapInArrow(grouped, _GROUPS), "anchor_groups")


_CHOSEN = "g bigint, part bigint, block bigint"
_WINDOWS = "array<struct<at:int,nth:int,positive_id:bigint,positive_score:bigint>>"


def _windows(group: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a group's positives: the anchor's place, the positive's place, and the least and largest score of a negative."""
    found = group["positives"] or []
    scores = [w["positive_score"] for w in found]
    low = np.array([-(-LOW * p // 100) for p in scores], np.int64)
    high = np.array([HIGH * p // 100 for p in scores], np.int64)
    return np.array([w["at"] for w in found], np.int64), np.arange(len(found)), low, high


def chosen_blocks(groups: DataFrame, blocks: DataFrame, kind: str, width: int, negatives: bool) -> DataFrame:
    """``g``, ``part``, ``block``: the blocks that a group must read, in parts of ``PART``."""
    cells = -(-blocks.count() // ZONES) or 1
    salts = -(-groups.count() // GROUPS) or 1
    zones = blocks.select("block", "label", "low", "high").withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells).cast("bigint")))
    zones = zones.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = groups.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))))
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("g"), F.lit(salts)).cast("int"))

    def choose(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"g": [], "part": [], "block": []}
        if left.num_rows and right.num_rows:
            block, label = right["block"].to_numpy(), right["label"].to_numpy()
            low, high = (np.stack([_numbers(x) for x in right[c].to_pylist()]) for c in ("low", "high"))
            for group in left.to_pylist():
                a = _vectors(group["vecs"], kind, width) if width else np.zeros((group["m"], 0), np.int64)
                least, most = bounds(a, low, high)
                same = _numbers(group["labels"])[:, None] == label[None, :]
                if negatives:
                    at, _, floor, ceiling = _windows(group)
                    needed = (~same[at] & (most[at] >= floor[:, None]) & (least[at] <= ceiling[:, None]) & (floor <= ceiling)[:, None]).any(0)
                else:
                    needed = (same & (most >= _numbers(group["floors"])[:, None])).any(0)
                own = np.sort(block[needed])
                found["g"] += [group["g"]] * len(own)
                found["part"] += ((key[0].as_py() << 32) + np.arange(len(own)) // PART).tolist()
                found["block"] += own.tolist()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()})

    return store(asked.groupBy("cell", "salt").cogroup(zones.groupBy("cell", "salt")).applyInArrow(choose, _CHOSEN), "chosen_blocks")


_FOUND = "anchor bigint, g bigint, at int, nth int, row bigint, vec_id bigint, score bigint"


def scanned(groups: DataFrame, blocks: DataFrame, chosen: DataFrame, kind: str, width: int, k: int, negatives: bool) -> DataFrame:
    """Each part's ``k`` best rows of each anchor (``nth`` 0), or of each of its windows."""
    data = chosen.join(blocks.select("block", "label", "rows", "ids", "vecs"), "block")
    parts = chosen.select(F.col("g").alias("of"), F.col("part").alias("of_part")).distinct()
    parts = parts.join(groups, F.col("of") == F.col("g")).drop("of").withColumnRenamed("g", "of")

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name: [] for name in ("anchor", "g", "at", "nth", "row", "vec_id", "score")}
        for group in left.to_pylist():
            a = _vectors(group["vecs"], kind, width) if width else np.zeros((group["m"], 0), np.int64)
            own, labels = _numbers(group["rows"]), _numbers(group["labels"])
            lists = {c: right[c].to_pylist() for c in ("label", "rows", "ids", "vecs")}
            rows, ids = (np.concatenate([_numbers(x) for x in lists[c]]) for c in ("rows", "ids"))
            of_block = np.repeat(np.array(lists["label"], np.int64), [len(x) // 8 for x in lists["rows"]])
            vecs = np.concatenate([_vectors(x, kind, width) for x in lists["vecs"]]) if width else np.zeros((len(rows), 0), np.int64)
            places, windows, floor, ceiling = _windows(group) if negatives else (np.arange(len(a)), np.zeros(len(a), np.int64), None, None)
            for start in range(0, len(places), 128):
                at = places[start : start + 128]
                scores = products(a[at], vecs)
                same = labels[at][:, None] == of_block[None, :]
                if negatives:
                    fit = ~same & (scores >= floor[start : start + 128, None]) & (scores <= ceiling[start : start + 128, None])
                else:
                    fit = same & (own[at][:, None] != rows[None, :])
                which, where = best(scores, fit, ids, rows, k)
                anchor = at[which]
                nth = windows[start : start + 128][which]
                if negatives:
                    nth = np.array([w["nth"] for w in group["positives"]], np.int64)[nth]
                for name, values in zip(out, (own[anchor], np.full(len(anchor), group["of"]), anchor, nth, rows[where], ids[where], scores[which, where]), strict=True):
                    out[name].append(values)
        return pa.table({
            name: pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)).cast(field.type)
            for (name, values), field in zip(out.items(), found_schema, strict=True)
        })

    found_schema = _schema(_FOUND)
    found = parts.groupBy("of", "of_part").cogroup(data.groupBy("g", "part")).applyInArrow(scan, _FOUND)
    order = Window.partitionBy("anchor", "nth").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchor_every: int = 100,
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part. A shorter vector ends in
    zeros; components and scores beyond 2**62 count as that. Repeated rows are rows of their own: each is an anchor, a
    positive of the others, and may come out several times. Ties go to the smaller id. An anchor without positives, or a
    positive without negatives, gives no rows; an empty table none. Other columns are not read.
    """
    rows = quantised(vectors, key, vector, label)
    low, high = ranges(rows)
    kind, width = _kind(low, high), len(low)
    blocks = blocks_of(rows, low, high, anchor_every, positives)
    groups = anchor_groups(blocks, anchor_every, kind, width)
    near = chosen_blocks(groups, blocks, kind, width, False)
    best_of = store(scanned(groups, blocks, near, kind, width, positives, False), "positives")
    told = F.struct("at", F.col("rank").cast("int").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = best_of.groupBy("g").agg(F.sort_array(F.collect_list(told)).cast(_WINDOWS).alias("positives"))  # a group is bounded
    aimed = store(groups.join(windows, "g"), "aimed_groups")
    far = chosen_blocks(aimed, blocks, kind, width, True)
    found = scanned(aimed, blocks, far, kind, width, negatives, True)
    pairs = aimed.select("g", F.explode("positives").alias("p"), "ids").select(
        "g", F.col("p.at").alias("at"), F.col("p.nth").alias("nth"), "p.positive_id", "p.positive_score"
    )
    named = found.select("anchor", "g", "at", "nth", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    anchors = rows.filter(F.col("vec_id") % anchor_every == 0).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return named.join(pairs, ["g", "at", "nth"]).join(anchors, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )

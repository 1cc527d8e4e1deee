"""Near duplicates by a prefix-tree join of word-shingle sets.

1. Every document becomes its set of distinct 5-word shingles; equal sets are one class with one representative.
2. Shingles are ordered by how many representatives have them, over the whole corpus (``exchange``). A set's prefix is
   its first n - ceil(t * n) + 1 shingles: similar sets share one of them, so shingles that occur once never match and a
   set whose prefix holds only such ones has no partner. Most documents end here.
3. The others meet in blocks: the components of sharing a prefix shingle. A large block is split into parts, and every
   two parts meet in a cell of bounded size.
4. In a cell the ordered sets are stored in a prefix tree. A set descends it once for all earlier sets, adding the overlap
   of shared edges once, and leaves a subtree when the overlap so far and the remaining lengths cannot reach the
   threshold, or when all of it is known to be connected. Links that connect something new come out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import exchange
from tidemark.llm.common import batches_of, numbered, settled, store, text_of, utf8
from tidemark.llm.components import components

WORDS = 5
PERCENT = 80
#: Sizes of a part of a block: representatives and their matchable shingles.
PART_SETS, PART_TOKENS = 500, 1_000_000
_BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_GAP = re.compile(rb"[\t-\r ]")
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_BYTE = exchange.mixed_bits(np.arange(1, 257, dtype=np.uint64))
_PLACE = exchange.mixed_bits(np.arange(1, 65, dtype=np.uint64) * _ROOT) | np.uint64(1)
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full((1 << 20) + 4096, _ROOT), dtype=np.uint64)])
_NEGATIVE = np.concatenate([[np.uint64(1)], np.cumprod(np.full((1 << 20) + 4096, _INVERSE), dtype=np.uint64)])


def _word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a lower-cased text; a very long text goes through in blocks cut at white space."""
    found = []
    at = 0
    while at < len(text):
        stop = min(len(text), at + _BLOCK_BYTES)
        if stop < len(text):
            cut = max(text.rfind(s, at, stop) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < at:  # one word longer than a block
                gap = _GAP.search(text, stop)
                end = gap.start() if gap else len(text)
                found.append(_hash_word(text, at, end))
                at = end
                continue
            stop = cut + 1
        found.append(_hash_block(text[at:stop]))
        at = stop
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _hash_word(text: bytes, at: int, end: int) -> np.ndarray:
    """The hash that ``_hash_block`` gives a word, summed over blocks of it."""
    total = 0
    for a in range(at, end, _BLOCK_BYTES):
        data = np.frombuffer(text, np.uint8, min(_BLOCK_BYTES, end - a), a)
        total += int((_BYTE[data] * _POWERS[: len(data)]).sum()) * pow(int(_ROOT), a - at, 1 << 64)
    return exchange.mixed_bits(np.array([(total + end - at) % (1 << 64)], np.uint64))


def _hash_block(text: bytes, places: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    space = np.concatenate([[True], _SPACE[data], [True]])
    edges = np.diff(space.view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWERS[: len(data)], out=sums[1:])
    codes = exchange.mixed_bits((sums[ends] - sums[starts]) * _NEGATIVE[starts] + (ends - starts).astype(np.uint64))
    return (codes, starts) if places else codes


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of so many word hashes."""
    total = np.full(max(0, len(codes) - width + 1), np.uint64(width))
    for i in range(width):
        total += codes[i : len(codes) - width + 1 + i] * _PLACE[i]
    return exchange.mixed_bits(total)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; fewer words are one shingle, none give none."""
    codes = _word_hashes(text.lower())  # bytes: A-Z only
    return np.unique(_windows(codes, min(WORDS, len(codes)))) if len(codes) else codes


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """``shingles`` of each text, hashed together in blocks of many texts."""
    group: list[bytes] = []
    held = 0
    for text in [*texts, None]:
        if group and (text is None or held + len(text) > _BLOCK_BYTES):
            yield from _sets_of_block(group)
            group, held = [], 0
        if text is not None:
            group.append(text)
            held += len(text) + 1


def _sets_of_block(texts: list[bytes]) -> Iterator[np.ndarray]:
    if len(texts) == 1:
        yield shingles(texts[0])
        return
    codes, starts = _hash_block(b"\n".join(texts).lower(), True)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, begins)
    hashes = _windows(codes, WORDS)
    for a, z in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        if z - a >= WORDS:
            yield np.unique(hashes[a : z - WORDS + 1])
        else:
            yield _windows(codes[a:z], z - a) if z > a else codes[:0]


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, 8 << 20):
        sets = list(shingle_sets(utf8(batch.column(1))))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
                batch.column(2),
            ],
            names=["doc_id", "n_shingles", "digest", "n_bytes"],
        )


def _representatives(rows: pa.Table, classes: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """The representatives of a chunk with their sets, in a fixed order."""
    wanted = {(i, d) for i, d in zip(classes.column("rep").to_pylist(), classes.column("digest").to_pylist(), strict=True) if d is not None}
    ids_wanted = {i for i, _ in wanted}
    ids, texts = exchange.in_order(rows)
    chosen = [(i, t) for i, t in zip(ids.tolist(), texts, strict=True) if i in ids_wanted]
    for (doc_id, _), tokens in zip(chosen, shingle_sets([t for _, t in chosen]), strict=True):
        if (doc_id, own := _digest(tokens)) in wanted:
            wanted.discard((doc_id, own))
            yield doc_id, tokens


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many of ``n`` ordered tokens must hold one that a similar set has as well."""
    return n - -(-percent * n // 100) + 1


def _similar(common: int, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def _needed(n: int, m: int, percent: int) -> int:
    """Least overlap of similar sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


class PrefixTree:
    """Ordered sets that share their beginnings; nodes are ranges of the sorted sets with an edge of tokens each."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, width: int):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.sizes = sizes[self.order]
        self.mark = np.zeros(width, bool)
        shared = [0] + [self._common(a, b) for a, b in zip(self.sets, self.sets[1:], strict=False)] + [0]
        self.nodes: list[tuple] = []
        self.top = self._build(shared)

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def _build(self, shared: list[int]) -> list[int]:
        """Nodes from the common beginnings of neighbours, innermost first; the stack holds open ranges."""
        stack: list[list] = [[0, 0, []]]  # depth, first set, children
        for i, own in enumerate(self.sets):
            while stack[-1][0] > shared[i]:
                self._close(stack, i, shared[i])
            if stack[-1][0] < shared[i]:
                # The last child of the open node began earlier and shares this much with the next set.
                child = stack[-1][2].pop()
                stack.append([shared[i], self.nodes[child][0], [child]])
                self._retop(child, shared[i])
            stack[-1][2].append(self._add(i, i + 1, shared[i], len(own), []))
        while len(stack) > 1:
            self._close(stack, len(self.sets), stack[-2][0])
        for child in stack[0][2]:
            self._retop(child, 0)
        return stack[0][2]

    def _close(self, stack: list, end: int, depth: int) -> None:
        bottom, first, children = stack.pop()
        for child in children:
            self._retop(child, bottom)
        node = self._add(first, end, max(depth, stack[-1][0]), bottom, children)
        if stack[-1][0] < depth:
            stack.append([depth, first, [node]])
        else:
            stack[-1][2].append(node)

    def _add(self, first: int, end: int, top: int, bottom: int, children: list[int]) -> int:
        rest = max(len(s) for s in self.sets[first:end]) - bottom if not children else max(
            len(self.sets[first]) - bottom, *(self.nodes[c][3] - bottom + self.nodes[c][6] for c in children)
        )
        own = self.sizes[first:end]
        self.nodes.append((first, end, top, bottom, int(own.min()), int(own.max()), rest, children))
        return len(self.nodes) - 1

    def _retop(self, node: int, top: int) -> None:
        self.nodes[node] = (*self.nodes[node][:2], top, *self.nodes[node][3:])

    def links(self, percent: int = PERCENT, parts: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
        """Pairs of positions of the given sets that connect what was not connected before, all of them similar.

        With ``parts`` only pairs of different parts are looked for.
        """
        label = np.arange(len(self.sets))
        part = None if parts is None else parts[self.order]
        for x, own in enumerate(self.sets):
            self.mark[own] = True
            n = int(self.sizes[x])
            # Those before it in the tree's order, the most similar ones last.
            stack = [(node, 0) for node in self.top]
            while stack:
                at, common = stack.pop()
                first, end, top, bottom, low, high, rest, children = self.nodes[at]
                end = min(end, x)
                if first >= end or 100 * high < percent * n or 100 * n < percent * low:
                    continue
                edge = self.sets[first][top:bottom]
                common += int(np.count_nonzero(self.mark[edge]))
                left = len(own) - int(np.searchsorted(own, edge[-1], "right")) if len(edge) else len(own)
                if common + min(left, rest) < _needed(n, max(low, -(-percent * n // 100)), percent):
                    continue
                if (label[first:end] == label[x]).all():
                    continue
                if children:
                    stack.extend((c, common) for c in children)
                    continue
                if part is not None and part[first] == part[x]:
                    continue
                if _similar(common, n, int(self.sizes[first]), percent):
                    yield self.order[first], self.order[x]
                    label[label == label[x]] = label[first]
            self.mark[own] = False


def _cell_links(_: tuple, rows: pa.Table) -> pa.Table:
    reps, sizes = rows.column("rep").to_pylist(), np.array(rows.column("n").to_pylist(), np.int64)
    parts = np.array(rows.column("part").to_pylist(), np.int64)
    raw = [np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()]
    values, places, counts = np.unique(np.concatenate(raw), return_inverse=True, return_counts=True)
    # Frequent tokens first: the more sets begin alike, the more the tree shares.
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    ranked = rank[places]
    bounds = np.cumsum([0] + [len(t) for t in raw])
    sets = [np.sort(ranked[a:b]).astype(np.uint32) for a, b in zip(bounds, bounds[1:], strict=False)]
    one = len(set(parts.tolist())) == 1
    found = list(PrefixTree(sets, sizes, len(values)).links(PERCENT, None if one else parts))
    return pa.table(
        {"a": pa.array([reps[i] for i, _ in found], pa.int64()), "b": pa.array([reps[j] for _, j in found], pa.int64())}
    )


def class_links(docs: DataFrame, classes: DataFrame, total_bytes: int, text: str, key: str) -> DataFrame:
    """Links (``a``, ``b``) between representatives that connect all similar classes."""
    n_chunks, buckets = exchange.pieces(total_bytes)
    chunks = exchange.dealt(docs, n_chunks, text, key).groupBy("chunk")
    # The chunk of a representative follows from its id and length, as for its row.
    reps = classes.select(exchange.chunk_of("rep", F.col("n_bytes"), n_chunks).alias("chunk"), "rep", "digest")

    def ask(chunk: tuple, docs_: pa.Table, classes_: pa.Table) -> pa.Table:
        sets = [s for _, s in _representatives(docs_, classes_)]
        prints, counts = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
        return exchange.questions(chunk[0].as_py(), prints, counts, buckets)

    asked = chunks.cogroup(reps.groupBy("chunk")).applyInArrow(ask, exchange.ASKED)
    told = exchange.answered(asked).select("chunk", F.lit(None).cast("bigint").alias("rep"), F.lit(None).cast("binary").alias("digest"), "bucket", "payload")
    both = told.unionByName(reps.select("*", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("payload")))

    def survivors(_: tuple, docs_: pa.Table, given: pa.Table) -> pa.Table:
        sets = list(_representatives(docs_, given.select(["rep", "digest"])))
        prints, places = np.unique(np.concatenate([*(s for _, s in sets), np.zeros(0, np.uint64)]), return_inverse=True)
        replies = {b: p for b, p in zip(given.column("bucket").to_pylist(), given.column("payload").to_pylist(), strict=True) if b is not None}
        codes = exchange.read_answers(prints, buckets, replies)
        codes = codes[places]
        out: list[tuple] = []
        at = 0
        for rep, tokens in sets:
            own = codes[at : at + len(tokens)]
            at += len(tokens)
            free = prefix_length(len(tokens)) - int(np.count_nonzero(own < 2))
            if free > 0:
                order = np.lexsort((tokens, own))
                shared = tokens[order][len(tokens) - int(np.count_nonzero(own >= 2)) :]
                out.append((rep, len(tokens), shared[:free].view(np.int64).tolist(), shared.tobytes()))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["rep", "n", "prefix", "tokens"])

    found = chunks.cogroup(both.groupBy("chunk")).applyInArrow(
        survivors, "rep bigint, n bigint, prefix array<bigint>, tokens binary"
    )
    alive = store(found, "survivors")
    # A representative with a shingle of its prefix belongs to the shingle's block, as its smallest one does.
    sharing = alive.select("rep", F.explode("prefix").alias("token"))
    hubs = sharing.groupBy("token").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    blocks = components(sharing.join(hubs, "token").select("rep", "hub"), "rep", "hub")
    members = store(
        alive.join(blocks, alive["rep"] == blocks["node"]).select(F.col("component").alias("block"), "rep", "n", "tokens"), "blocks"
    )
    loads = members.groupBy("block").agg(F.count("*").alias("sets"), F.sum(F.octet_length("tokens") / 8).alias("load"))
    parts = F.greatest(F.ceil(F.col("sets") / PART_SETS), F.ceil(F.col("load") / PART_TOKENS), F.lit(1))
    placed = members.join(loads.select("block", parts.alias("parts")), "block").withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    # Every two parts of a block meet in one cell, and every part meets itself where it is the only one.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    cells = placed.withColumn("other", other).select(
        "block", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "rep", "n", "tokens"
    )
    # Dealt by cell: the rows still lie by block, which would put all cells of a block into one task.
    return cells.repartition("block", "x", "y").groupBy("block", "x", "y").applyInArrow(_cell_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row: ``doc_id``, ``n_shingles``, ``component_id``.

    Documents link when 100 * common >= 80 * united shingles; a component has the smallest id that links reach. Texts
    without words have no shingles and are alone. A row without an id is in the component of its equal sets, where there
    is one. A repeated id with other texts counts as further documents. No rows in, no rows out; other columns are not
    read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    kinds = "doc_id bigint, n_shingles bigint, digest binary, n_bytes int"
    profile = store(rows.select("*", F.octet_length("text").alias("n_bytes")).mapInArrow(settled(_profile), kinds), "profile")
    total = profile.agg(F.sum("n_bytes").alias("n")).first().n or 0
    first = profile.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "n_bytes")).alias("m"))
    classes = store(first.select("digest", F.col("m.doc_id").alias("rep"), F.col("m.n_bytes").alias("n_bytes")), "classes")
    links = store(class_links(docs, classes, total, text, key), "links")
    merged = components(links, "a", "b").select(F.col("node"), "component")
    named = classes.join(merged, F.col("rep") == F.col("node"), "left")
    joined = profile.join(named.select("digest", F.coalesce("component", "rep").alias("smallest")), "digest", "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their component, with all their columns.

    Every row is a document of its own here, whatever its id: of a component the row with the smallest id stays and, of
    its rows without an id, the first. Rows whose texts have no words stay.
    """
    rows, row = numbered(docs, "near-rows")
    near = near_duplicates(rows, text, row).filter("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select(F.col(row).alias("row"), F.col(key).cast("bigint").alias("id"))
    placed = store(near.join(ids, "row").select("row", "id", "component_id", F.isnull("id").alias("no_id")), "placed")
    several = placed.groupBy("component_id", "no_id").agg(F.min(F.struct("id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = placed.join(several, ["component_id", "no_id"]).filter("row != first.row").select(F.col("row").alias(row))
    # Stored, its size is known before the join is planned: the texts are shuffled only if it is large.
    return rows.join(store(gone, "gone"), row, "left_anti").select(*docs.columns)

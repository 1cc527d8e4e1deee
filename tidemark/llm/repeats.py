"""Repeated passages by a run-length suffix index.

A string of 50 bytes is repeated when it also starts in a document with a smaller id. The corpus is too large for one
index, so the 50-byte windows of a text are grouped by their anchor, the 24-byte string in them with the smallest hash:
equal windows have equal anchors. Windows in a row with one anchor form a segment. Anchors that only one document has are
dropped after a corpus-wide count (``exchange``); each chunk of documents sends the distinct segments of the others, with
the smallest id that has them, to the bucket of the anchor. A bucket builds an index over the distinct segments of the
anchors that have several: all suffixes sorted, the Burrows-Wheeler transform kept as its runs, the borders between rows
whose common beginning is shorter than 50, and the smallest owner at each border. The segments are then streamed through
the index backwards, one byte of all segments a step; wherever 50 bytes are matched, the border interval of the row names
the first document that has them. The answers go back to the chunks, which mark the bytes and cut them out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import exchange
from tidemark.llm.common import text_of

LENGTH = 50
ANCHOR = 24
#: Anchor positions in a window, and most windows of a segment.
WINDOW = LENGTH - ANCHOR + 1
_WIDTH = LENGTH + WINDOW  # of a segment's row: its bytes, then nothing
#: Bytes of segments that one index holds (more only if one anchor has more).
INDEX_BYTES = 1 << 19
#: Buckets here for one of the exchange's, as segments are larger than fingerprints.
SPLIT = 4
_BLOCK = 1 << 20
#: Occurrences whose windows are compared at once.
_SLICE = 1 << 15
_BYTE = exchange.mixed_bits(np.arange(1, 257, dtype=np.uint64))
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_SEGMENTS = "bucket bigint, chunk bigint, anchors binary, owners binary, lengths binary, body binary"
_FIRSTS = "chunk bigint, bucket bigint, anchors binary, runs binary, spans binary, firsts binary"


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 24 bytes at each position."""
    h = _BYTE[data]
    for step, shift in zip(_STEPS, (1, 2, 4, 8), strict=False):
        h = h[:-shift] * step + h[shift:]
        h ^= h >> np.uint64(29)
    # h covers 16 bytes; 8 more are joined by the overlap of two of them.
    return exchange.mixed_bits(h[:-8] * _STEPS[4] + h[8:])


def _lowest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    out, size = h, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Segments:
    """Segments of some texts, in order of text and place: anchor, text, first window, number of windows."""

    anchors: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    def where(self, keep: np.ndarray) -> Segments:
        return Segments(self.anchors[keep], self.texts[keep], self.starts[keep], self.counts[keep])


def segments_of(texts: list[bytes]) -> Segments:
    """The segments of all texts. Short texts are hashed together, long ones in blocks, so memory is bounded."""
    found = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    group: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if group:
            sizes = np.array([len(texts[i]) for i in group])
            begins = np.cumsum(sizes) - sizes
            found.append(_block(b"".join([texts[i] for i in group]), begins, sizes, np.array(group), np.zeros(len(group), np.int64)))
        group, held = [], 0

    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        if len(text) <= _BLOCK // 4:
            if held + len(text) > _BLOCK:
                flush()
            group.append(i)
            held += len(text)
            continue
        flush()
        for at in range(0, len(text) - LENGTH + 1, _BLOCK):
            part = text[at : at + _BLOCK + LENGTH - 1]
            found.append(_block(part, np.array([0]), np.array([len(part)]), np.array([i]), np.array([at])))
    flush()
    return Segments(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _block(data: bytes, begins: np.ndarray, sizes: np.ndarray, texts: np.ndarray, offsets: np.ndarray) -> tuple:
    """Segments of the texts that lie in ``data`` one after another, each of at least 50 bytes."""
    low = _lowest(_anchor_hashes(np.frombuffer(data, np.uint8)), WINDOW)
    cut = np.concatenate([[True], low[1:] != low[:-1]])
    cut[begins] = True
    # Windows that reach over the end of a text belong to none.
    for begin, size in zip(begins[1:].tolist(), sizes.tolist(), strict=False):
        cut[begin - LENGTH + 1 : begin] = False
        cut[begin - LENGTH + 1] = True
    starts = np.flatnonzero(cut)
    place = np.searchsorted(begins, starts, "right") - 1
    last = begins[place] + sizes[place] - LENGTH
    inside = starts <= last
    ends = np.append(starts[1:], len(low))[inside]
    starts, place, last = starts[inside], place[inside], last[inside]
    counts = np.minimum(ends, last + 1) - starts
    if counts.max() > WINDOW:  # periodic text: cut its segments to the usual length
        pieces = -(-counts // WINDOW)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        counts = np.minimum(np.repeat(counts, pieces) - nth * WINDOW, WINDOW)
        starts, place = np.repeat(starts, pieces) + nth * WINDOW, np.repeat(place, pieces)
    # Minima are small numbers; mixed again, anchors fill all buckets alike.
    return exchange.mixed_bits(low[starts]), texts[place], starts - begins[place] + offsets[place], counts


class Chunk:
    """The segments of a chunk's documents whose anchors are shared, and their distinct contents by bucket."""

    def __init__(self, texts: list[bytes], shared: np.ndarray, buckets: int, segments: Segments | None = None):
        """``shared`` is sorted."""
        own = segments or segments_of(texts)
        at = np.minimum(np.searchsorted(shared, own.anchors), max(len(shared) - 1, 0))
        own = own.where(shared[at] == own.anchors if len(shared) else np.zeros(len(own.anchors), bool))
        self.anchors, self.docs, self.starts, self.counts = own.anchors, own.texts, own.starts, own.counts
        rows = np.zeros((len(self.docs), _WIDTH), np.uint8)
        bounds = np.searchsorted(self.docs, np.arange(len(texts) + 1))
        for place in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[place], bounds[place + 1])
            data = np.frombuffer(texts[place] + bytes(_WIDTH), np.uint8)
            rows[own] = data[self.starts[own][:, None] + np.arange(_WIDTH)]
        lengths = self.counts + LENGTH - 1
        rows[np.arange(_WIDTH) >= lengths[:, None]] = 0
        rows[:, _WIDTH - 1] = lengths  # texts may hold zero bytes
        view = rows.view(f"V{_WIDTH}").ravel()
        _, first, self.content = np.unique(view, return_index=True, return_inverse=True) if len(view) else (view, np.zeros(0, int), np.zeros(0, int))
        self.first = first
        self.lengths = lengths[first]
        self.rows = rows[first]
        self.bucket = exchange.bucket_of(self.anchors[first], buckets).astype(np.int64)


def _bounds(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    for b, a, z in zip(found, starts, np.append(starts[1:], len(order)), strict=True):
        yield int(b), order[a:z]


class RunLengthIndex:
    """Suffixes of some strings as a run-length Burrows-Wheeler transform with owners at the borders of length 50."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray, owners: np.ndarray):
        n, width = len(rows), int(lengths.max()) + 1
        inside = np.arange(width) < lengths[:, None]
        symbols = np.where(inside, rows[:, :width].astype(np.int64) + 1, 0)
        ranks = np.zeros((n, width), np.int64)
        for i in range(7):  # seven symbols of nine bits
            ranks = (ranks << 9) | self._moved(symbols, i)
        ranks, depth = self._dense(ranks, inside), 7
        part, part_depth = ranks, depth  # the deepest ranks that do not look beyond 50 symbols
        while depth < width:
            if ranks.max() < 1 << 21:  # three at a time
                keys = (ranks << 42) | (self._moved(ranks, depth) << 21) | self._moved(ranks, 2 * depth)
                depth *= 3
            else:
                keys = (ranks << 31) | self._moved(ranks, depth)
                depth *= 2
            ranks = self._dense(keys, inside)
            if depth <= LENGTH:
                part, part_depth = ranks, depth
        # All suffixes with their end marks; equal ones in the order of their strings.
        valid = np.arange(width) <= lengths[:, None]
        string, column = np.nonzero(valid)
        order = np.argsort((ranks[valid] << 31) | np.arange(len(string)))
        string, column = string[order], column[order]
        before = np.where(column > 0, symbols[string, column - 1], 0)
        heads = np.concatenate([[True], before[1:] != before[:-1]])
        self.run_start = np.flatnonzero(heads)
        self.run_symbol = before[self.run_start]
        run_length = np.diff(np.append(self.run_start, len(before)))
        # Of each run: how often its symbol stands in earlier runs, and where suffixes with that symbol begin.
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        total = np.cumsum(run_length[by_symbol]) - run_length[by_symbol]
        group = np.searchsorted(self.run_symbol[by_symbol], self.run_symbol[by_symbol])
        earlier = np.empty(len(total), np.int64)
        earlier[by_symbol] = total - total[group]
        smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols[valid], minlength=258))])
        self.run_base = smaller[self.run_symbol] + earlier
        # Rows that begin with the same 50 symbols, seen from overlapping parts of them.
        new = np.zeros(len(order), bool)
        new[0] = True
        for at in [*range(0, LENGTH - part_depth, part_depth), LENGTH - part_depth]:
            own = self._moved(part, at)[string, column]
            new[1:] |= own[1:] != own[:-1]
        self.border = np.flatnonzero(new)
        self.border_owner = np.minimum.reduceat(owners[string], self.border)

    @staticmethod
    def _moved(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        if by < x.shape[1]:
            out[:, : x.shape[1] - by] = x[:, by:]
        return out

    @staticmethod
    def _dense(keys: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Ranks from 1 of the keys inside; 0 outside."""
        flat = keys[inside]
        order = np.argsort(flat)
        ordered = flat[order]
        rank = np.empty(len(flat), np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        out = np.zeros(keys.shape, np.int64)
        out[inside] = rank
        return out

    def first_owners(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per string and window: the smallest owner of a string that holds its 50 bytes. Strings must be the index's own.

        The matching length grows by one with each step as long as the byte extends the match, which it always does here.
        """
        out = np.full((len(rows), WINDOW), exchange.NO_ID, np.int64)
        row = np.arange(len(rows))  # the end marks are the first rows, in order
        for matched in range(1, int(lengths.max()) + 1):
            live = np.flatnonzero(lengths >= matched)
            run = np.searchsorted(self.run_start, row[live], "right") - 1
            column = lengths[live] - matched
            assert (self.run_symbol[run] == rows[live, column].astype(np.int64) + 1).all()
            row[live] = self.run_base[run] + row[live] - self.run_start[run]
            if matched >= LENGTH:
                out[live, column] = self.border_owner[np.searchsorted(self.border, row[live], "right") - 1]
        return out


def first_owners(anchors: np.ndarray, rows: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Smallest owner of each window of each segment (rows may repeat), by indexes over whole anchors."""
    view = np.ascontiguousarray(rows).view(f"V{_WIDTH}").ravel()
    _, first, content = np.unique(view, return_index=True, return_inverse=True)
    smallest = np.full(len(first), exchange.NO_ID, np.int64)
    np.minimum.at(smallest, content, owners)
    rows, lengths, anchors = rows[first], lengths[first], anchors[first]
    out = np.where(np.arange(WINDOW) < (lengths - LENGTH + 1)[:, None], smallest[:, None], exchange.NO_ID)
    # The only segment of its anchor has no other text to match.
    order = np.argsort(anchors, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], anchors[order][1:] != anchors[order][:-1]]))
    sizes = np.diff(np.append(starts, len(order)))
    several = np.repeat(sizes > 1, sizes)
    order, starts = order[several], (np.cumsum(sizes[sizes > 1]) - sizes[sizes > 1])
    if len(order):
        weight = np.cumsum(lengths[order])
        part = weight[starts] // INDEX_BYTES
        cuts = np.append(starts[np.concatenate([[True], part[1:] != part[:-1]])], len(order))
        for a, z in zip(cuts, cuts[1:], strict=False):
            own = order[a:z]
            out[own] = RunLengthIndex(rows[own], lengths[own], smallest[own]).first_owners(rows[own], lengths[own])
    return out[content]


def _ask(buckets: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        _, texts = exchange.in_order(rows)
        own = segments_of(texts)
        order = np.lexsort((own.texts, own.anchors))
        anchors, places = own.anchors[order], own.texts[order]
        new = np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)]
        once = new | np.concatenate([[True], places[1:] != places[:-1]])[: len(anchors)]
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(once.astype(np.int64), starts) if len(starts) else starts
        return exchange.questions(key[0].as_py(), anchors[starts], counts, buckets)

    return run


def _send(buckets: int):
    def run(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = exchange.in_order(rows)
        found = segments_of(texts)
        prints = np.unique(found.anchors)
        replies = dict(zip(told.column("bucket").to_pylist(), told.column("payload").to_pylist(), strict=True))
        codes = exchange.read_answers(prints, buckets, replies)
        chunk = Chunk(texts, prints[codes >= 2], buckets, found)
        owners = ids[chunk.docs[chunk.first]]  # documents are in order of ids, so the first has the smallest
        out = []
        for b, own in _bounds(chunk.bucket):
            body = chunk.rows[own][np.arange(_WIDTH) < chunk.lengths[own][:, None]]
            out.append((b, key[0].as_py(), chunk.anchors[chunk.first[own]].tobytes(), owners[own].tobytes(), chunk.lengths[own].astype(np.uint8).tobytes(), body.tobytes()))
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        columns = list(zip(*out, strict=True)) or [()] * 6
        names = ["bucket", "chunk", "anchors", "owners", "lengths", "body"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _index(_: tuple, rows: pa.Table) -> pa.Table:
    def joined(name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.frombuffer(x, kind) for x in rows.column(name).to_pylist()]
        return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])

    anchors, bounds = joined("anchors", np.uint64)
    owners, lengths, body = joined("owners", np.int64)[0], joined("lengths", np.uint8)[0].astype(np.int64), joined("body", np.uint8)[0]
    wide = np.zeros((len(lengths), _WIDTH), np.uint8)
    wide[np.arange(_WIDTH) < lengths[:, None]] = body
    wide[:, _WIDTH - 1] = lengths
    first = first_owners(anchors, wide, lengths, owners)
    # Windows of a segment mostly have one first owner: answer in runs.
    windows = np.arange(WINDOW) < (lengths - LENGTH + 1)[:, None]
    head = windows.copy()
    head[:, 1:] &= first[:, 1:] != first[:, :-1]
    at, column = np.nonzero(head)
    stop = np.append(column[1:], 0)
    last = np.append(at[1:] != at[:-1], True)
    span = np.where(last, lengths[at] - LENGTH + 1, stop) - column
    runs = head.sum(1).astype(np.uint8)
    ends = np.cumsum(runs, dtype=np.int64)
    out: list[list[bytes]] = [[], [], [], []]
    for a, z in zip(bounds, bounds[1:], strict=False):
        x, y = (int(ends[a - 1]) if a else 0), int(ends[z - 1]) if z else 0
        for column_, value in zip(out, (anchors[a:z], runs[a:z], span[x:y].astype(np.uint8), first[at[x:y], column[x:y]]), strict=True):
            column_.append(value.tobytes())
    arrays = [pa.array(c, pa.binary()) for c in out]
    return pa.table([rows.column("chunk"), rows.column("bucket"), *arrays], names=["chunk", "bucket", "anchors", "runs", "spans", "firsts"])


def _cut(buckets: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ("kept", pa.binary()),
        ]
    )

    def run(_: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = exchange.in_order(rows)
        replies = {r["bucket"]: r for r in told.to_pylist()}
        shared = np.unique(np.concatenate([*(np.frombuffer(r["anchors"], np.uint64) for r in replies.values()), np.zeros(0, np.uint64)]))
        spans: list[list[dict]] = [[] for _ in texts]
        if len(shared):
            chunk = Chunk(texts, shared, buckets)
            first = np.full((len(chunk.first), WINDOW), exchange.NO_ID, np.int64)
            for b, own in _bounds(chunk.bucket):
                runs = np.frombuffer(replies[b]["runs"], np.uint8)
                span = np.frombuffer(replies[b]["spans"], np.uint8)
                value = np.repeat(np.frombuffer(replies[b]["firsts"], np.int64), span)
                total = np.add.reduceat(span.astype(np.int64), np.cumsum(runs, dtype=np.int64) - runs)
                at = np.repeat(np.arange(len(own)), total)
                column = np.arange(len(value)) - np.repeat(np.cumsum(total) - total, total)
                first[own[at], column] = value
            places, starts = [], []
            for at in range(0, len(chunk.content), _SLICE):
                own = slice(at, at + _SLICE)
                hit, column = np.nonzero(first[chunk.content[own]] < ids[chunk.docs[own]][:, None])
                places.append(chunk.docs[own][hit])
                starts.append(chunk.starts[own][hit] + column)
            place, start = np.concatenate(places), np.concatenate(starts)
            order = np.lexsort((start, place))
            place, start = place[order], start[order]
            if len(place):
                new = np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] > start[:-1] + LENGTH)])
                a = np.flatnonzero(new)
                z = np.append(a[1:], len(place)) - 1
                for p, x, y in zip(place[a].tolist(), start[a].tolist(), (start[z] + LENGTH).tolist(), strict=True):
                    spans[p].append({"start": x, "stop": y})
        kept = []
        for text, cut in zip(texts, spans, strict=True):
            stops = [0, *(s["stop"] for s in cut)]
            kept.append(b"".join(text[a:z] for a, z in zip(stops, [*(s["start"] for s in cut), len(text)], strict=True)) if cut else text)
        made = [[None if i == exchange.NO_ID else i for i in ids.tolist()], [len(t) for t in texts], spans, kept]
        return pa.table([pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    return run


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row: ``doc_id``, ``n_bytes``, ``removed`` (maximal byte spans), ``kept`` (the remaining bytes).

    Removed is each byte covered by a 50-byte string of the text that also starts in a document with a smaller id, judged
    on the input. A null id counts as larger than all; rows with equal ids do not remove each other. Null and empty texts
    and texts under 50 bytes stay whole. No rows in, no rows out; other columns are not read.
    """
    total = docs.select(F.sum(F.octet_length(text_of(text))).alias("n")).first().n or 0
    chunks, buckets = exchange.pieces(total)
    buckets *= SPLIT
    # One shuffle of the texts; the plan reads it three times.
    dealt = exchange.dealt(docs, chunks, text, key).groupBy("chunk")
    told = exchange.answered(dealt.applyInArrow(_ask(buckets), exchange.ASKED))
    sent = dealt.cogroup(told.groupBy("chunk")).applyInArrow(_send(buckets), _SEGMENTS)
    firsts = sent.groupBy("bucket").applyInArrow(_index, _FIRSTS)
    kinds = "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,stop:bigint>>, kept binary"
    return dealt.cogroup(firsts.groupBy("chunk")).applyInArrow(_cut(buckets), kinds)

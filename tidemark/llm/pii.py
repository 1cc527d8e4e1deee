"""Personal data: fixed shapes, and identifiers found through the contexts they stand in.

Emails, IPs, cards and phones have fixed shapes (the base). They are the seeds of a bootstrap over a graph of lexical
patterns (words beside a token) and instances (tokens that look like identifiers): a pattern is trusted for a kind if, by
the lower bound of its success rate, its instances are of that kind; an instance is believed by the trusted patterns it
occurs in; believed instances count for further patterns. This goes on until nothing new is believed; what is believed stays
so, and thus the rounds end. What is believed at the end are spans as well.

Instances are tokens, digits in groups (``555 123 4567``, a card that fails its check) and addresses with ``(at)`` and
``(dot)``. They are told apart by a hash of their whole text, contexts by whole words.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, store, text_of

KINDS = ("email", "ip", "card", "phone")
#: A pattern is trusted if the 95 % lower bound of its success rate is at least this.
TRUST = 0.75
#: A token is marked if it is believed at least this much.
BELIEF = 0.8
#: What an unknown instance weighs against a pattern, next to 1 for one of another kind.
UNKNOWN = 0.25
_BATCH_BYTES = 4 << 20
_BASE = (
    "uid bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
    "base array<struct<start:bigint,kind:int,stop:bigint>>, "
    "seen array<struct<start:bigint,kind:int,stop:bigint,instance:string,patterns:array<string>>>"
)

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails at its first digit fails at all, so these begin at the first and give nothing back.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, seen from each @, in time linear in the text."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        if at >= free and (domain := _DOMAIN.match(text, at)):
            start = at
            while start > free and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, domain.end()
                at = free = domain.end()
                continue
        at += 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points by start, then kind."""
    if not _ANY.search(text):
        return []
    spans = [(a, 0, b) for a, b in _emails(text)]
    spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(spans)


_EDGE = ".,;:!?()[]{}\"'|"
#: Digits in groups with one or two marks or blanks between them.
_GROUPED = re.compile(r"\(?[0-9]++(?:[\x20()./-]{1,2}[0-9]++)++")
_AT = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?(?=[A-Za-z0-9-])", re.I)
_DOTTED = re.compile(r"[A-Za-z0-9-]++(?:\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?[A-Za-z0-9-]++)+", re.I)
_LONG_WORD = 40


def _identifier(token: str) -> bool:
    """Looks like an identifier: at least 6 characters with 4 digits or more, or with an @ inside."""
    return len(token) >= 6 and (sum("0" <= c <= "9" for c in token) >= 4 or "@" in token[1:-1])


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def _word(text: str) -> str:
    """A context word: lower case, without marks at its ends, digits as #; a long one by a hash of the whole word."""
    word = re.sub(r"[0-9]", "#", text.lower().strip(_EDGE))
    return word if len(word) <= _LONG_WORD else f"#{_digest(word)}"


def _apart(found: Iterator[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the ranges in order, those that overlap none of the taken ones, which are in order of their start."""
    out, i, reach = [], 0, 0
    for start, stop in found:
        while i < len(taken) and taken[i][0] < stop:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            out.append((start, stop))
    return out


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with (at) and (dot), seen from each (at)."""
    free = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start() and (domain := _DOTTED.match(text, m.end())):
            yield start, domain.end()
            free = domain.end()


def _grouped(text: str) -> Iterator[tuple[int, int]]:
    for m in _GROUPED.finditer(text):
        if sum("0" <= c <= "9" for c in m[0]) >= 7:
            yield m.start(), m.end()


def seen_instances(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """Base spans, and other ranges that look like identifiers, with the patterns of the words beside them."""
    if not spans and not _ANY.search(text) and not _AT.search(text):
        return []
    places = [(a, k, b) for a, k, b in spans]
    taken = [(a, b) for a, _, b in spans]
    more = _apart(_spelled(text), taken)
    taken = sorted([*taken, *more])
    groups = _apart(_grouped(text), taken)
    taken = sorted([*taken, *groups])
    words = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]

    def tokens() -> Iterator[tuple[int, int]]:
        for a, b in words:
            token = text[a:b].strip(_EDGE)
            if _identifier(token):
                start = a + text[a:b].index(token)
                yield start, start + len(token)

    places += [(a, -1, b) for a, b in sorted([*more, *groups, *_apart(tokens(), taken)])]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    out = []
    for start, kind, stop in sorted(places):
        # The word that the range begins or ends in counts with what lies outside the range.
        first, last = bisect_right(starts, start) - 1, bisect_left(ends, stop)
        left = [text[max(a, 0) : min(b, start)] for a, b in words[max(0, first - 2) : first + 1]]
        before = [w for w in map(_word, left) if w][-2:]
        right = [text[max(a, stop) : b] for a, b in words[last : last + 2]]
        after = next((w for w in map(_word, right) if w), "")
        patterns = []
        if before:
            if len(before) == 2:
                patterns.append(f"{before[0]} {before[1]} _")
            if after:
                patterns.append(f"{before[-1]} _ {after}")
            patterns.append(f"{before[-1]} _")
        out.append((start, kind, stop, _digest(text[start:stop].lower()), patterns))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())])
    seen_type = pa.struct([*span, ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
    for batch in batches_of(batches, _BATCH_BYTES):
        columns: list[list] = [[] for _ in range(8)]
        for text in batch.column(1).to_pylist():
            spans = base_spans(text)
            seen = seen_instances(text, spans)
            told = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
            counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
            row = [number, *counts, hashlib.sha256(told.encode()).hexdigest(), [dict(zip(("start", "kind", "stop"), s, strict=True)) for s in spans], [dict(zip(("start", "kind", "stop", "instance", "patterns"), s, strict=True)) for s in seen]]
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            number += 1
        kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(span), pa.list_(seen_type)]
        made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [made[0], batch.column(0), *made[1:]],
            names=["uid", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "seen"],
        )


def _lower_bound(hits: str, n: str):
    """Wilson's lower bound (95 %, one-sided) of a success rate."""
    z = 1.645
    p = F.col(hits) / F.col(n)
    return (p + z * z / (2 * F.col(n)) - z * F.sqrt(p * (1 - p) / F.col(n) + z * z / (4 * F.col(n) * F.col(n)))) / (1 + z * z / F.col(n))


def believed_instances(links: DataFrame) -> DataFrame:
    """``instance``, ``kind``: unknown instances that trusted patterns give a kind.

    ``links`` has ``pattern``, ``instance`` and ``kind`` (-1 for unknown). An instance that is a seed anywhere keeps its
    kinds. Every step is a grouping or a join on the pattern or the instance, pre-aggregated to distinct pairs. An instance
    once believed stays so with its first kind; the rounds end when none is added.
    """
    pairs = store(links.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pairs")
    seeds = pairs.filter("kind >= 0").select("instance", "kind").distinct().withColumn("belief", F.lit(1.0))
    held, size = store(seeds, "belief"), -1
    while size < (size := held.count()):
        # A pattern's instances: those believed to be of a kind, and the others, which weigh less while unknown.
        known = held.groupBy("instance").agg(F.max_by("kind", F.struct("belief", -F.col("kind"))).alias("of"), F.max("belief").alias("belief"))
        voted = pairs.select("pattern", "instance").join(known, "instance", "left")
        by_kind = voted.groupBy("pattern", "of").agg(
            F.sum(F.coalesce("belief", F.lit(UNKNOWN)).cast("decimal(20,6)")).cast("double").alias("mass")
        )
        totals = by_kind.groupBy("pattern").agg(
            F.sum("mass").alias("total"), F.max_by("of", F.when(F.col("of").isNotNull(), F.struct("mass", -F.col("of")))).alias("kind"),
            F.max(F.when(F.col("of").isNotNull(), F.col("mass"))).alias("hits"),
        )
        trusted = totals.filter("hits is not null").withColumn("trust", _lower_bound("hits", "total")).filter(F.col("trust") >= TRUST)
        found = (
            pairs.select("pattern", "instance").join(trusted.select("pattern", "kind", "trust"), "pattern")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.999))).cast("decimal(20,9)")).cast("double"))).alias("belief"))
            .filter(F.col("belief") >= BELIEF)
            .groupBy("instance").agg(F.max_by(F.struct("kind", "belief"), F.struct("belief", -F.col("kind"))).alias("m"))
            .join(held.select("instance").distinct(), "instance", "left_anti")
            .select("instance", "m.kind", "m.belief")
        )
        held = store(held.unionByName(found), "belief")
    return held.join(seeds.select("instance").distinct(), "instance", "left_anti").select("instance", "kind")


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row: ``doc_id``, base counts, ``base_sha256``, ``spans`` (kind:start:end by start, then kind).

    Whole texts are read; null and empty ones have no spans. Repeated rows are found alike; an empty table gives no rows;
    other columns are not read. Positions are code points.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    scanned = store(rows.mapInArrow(_scan, _BASE), "scanned")
    seen = scanned.select("uid", F.explode("seen").alias("s")).select("uid", "s.*")
    links = seen.select(F.explode("patterns").alias("pattern"), "instance", "kind")
    believed = believed_instances(links)
    added = (
        seen.filter("kind < 0").select("uid", "start", "stop", "instance").join(believed, "instance")
        .groupBy("uid").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("added"))
    )
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>"))))
    names = F.array(*map(F.lit, KINDS))
    told = F.transform(every, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    return scanned.join(added, "uid", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(told, ",").alias("spans")
    )

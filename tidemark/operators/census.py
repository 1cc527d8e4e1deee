"""A tagged key census: all key rules of many tables from one grouping.

Every table is read once. Each of its rows gives one small record per key that it holds, tagged with the kind of key (order,
shipment, ...), and one per row rule that it breaks. All records meet in one grouping by (kind, key), which has a count for
each role that tables play in a kind. Uniqueness, orphans, multiplicities and row rules are sums over that grouping, taken
together in a second, tiny one. Map-side sums make a key that holds a third of all rows one record per task.
Where one table alone uses a kind and its keys should be unique, the passes below leave these sums out: they would hold a
record per row of a task's files, and spill.

Over large tables the records of all kinds together would take several times the disk of the tables. There the census goes
kind by kind, and through the keys of a kind with many records in shares, by a hash of the key. Each pass is a job whose
shuffle is deleted when it ends; as a key is in one pass only, the sums over all groups are the sums over the passes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import LARGE, input_bytes, shuffles_deleted

#: Over large tables, a pass holds about one in so many of all records.
SHARES = 8
_RULE = -1
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Use:
    """A table's use of a column as a key: its role among those that share this kind of key.

    ``when`` limits the rows that count. ``top`` is a value of which the census keeps the greatest per key.
    """

    kind: str
    role: str
    key: Column | str
    when: Column | None = None
    top: Column | None = None


@dataclass(frozen=True)
class Source:
    """A table with its keys, and row rules: how many times a row breaks each (a boolean counts as 0 or 1)."""

    frame: DataFrame
    uses: list[Use] = field(default_factory=list)
    rules: dict[str, Column] = field(default_factory=dict)


class Census:
    """The grouping, and aggregates to take over it with ``totals``. Build all aggregates first: one pass answers them, or
    with ``shares`` over 1 (by default over large tables) a few, which run when ``totals`` is called."""

    def __init__(self, sources: list[Source], shares: int | None = None):
        self._sources = sources
        self._kinds: dict[str, int] = {}
        self._roles: dict[tuple[str, str], int] = {}
        self._rules: dict[str, int] = {}
        for source in sources:
            for use in source.uses:
                self._kinds.setdefault(use.kind, len(self._kinds))
                self._roles.setdefault((use.kind, use.role), sum(k == use.kind for k, _ in self._roles))
            for name in source.rules:
                self._rules.setdefault(name, len(self._rules))
        self._shares = shares or (SHARES if input_bytes(*[s.frame for s in sources]) > LARGE else 1)
        # Roles whose keys should each come once.
        self._unique: set[tuple[str, str]] = set()
        # Sums over the groups: of a kind a value per key, of a rule its breaches.
        self._sums: dict[str, tuple[str | None, Column | str]] = {}

    @staticmethod
    def _key(use: Use) -> Column:
        return use.key if isinstance(use.key, Column) else F.col(use.key)

    def _whole(self, source: Source, use: Use) -> bool:
        return isinstance(source.frame.select(self._key(use)).schema[0].dataType, _WHOLE)

    @staticmethod
    def _breaches(broken: Column) -> Column:
        return F.coalesce(broken.cast("bigint"), F.lit(0).cast("bigint"))

    def _records(self, source: Source) -> DataFrame:
        """A record per key and broken rule of every row, with its kind."""
        none_top = F.lit(None).cast("decimal(38,0)")
        records = []
        for use in source.uses:
            whole, key = self._whole(source, use), self._key(use)
            record = self._record(
                self._kinds[use.kind],
                key.cast("bigint") if whole else F.lit(None).cast("bigint"),
                F.lit(None).cast("string") if whole else key.cast("string"),
                self._roles[use.kind, use.role],
                F.lit(1).cast("bigint"),
                none_top if use.top is None else use.top.cast("decimal(38,0)"),
            )
            records.append(record if use.when is None else F.when(use.when, record))
        for name, broken in source.rules.items():
            weight = self._breaches(broken)
            record = self._record(_RULE, F.lit(self._rules[name]).cast("bigint"), F.lit(None).cast("string"), 0, weight, none_top)
            records.append(F.when(weight > 0, record))
        return source.frame.select(F.inline(F.array_compact(F.array(*records))))

    @staticmethod
    def _record(kind: int, number: Column, text: Column, slot: int, weight: Column, top: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), number.alias("number"), text.alias("text"), F.lit(slot).alias("slot"),
            weight.alias("weight"), top.alias("top"),
        )

    def _grouped(self) -> DataFrame:
        """All records by kind and key, from one shuffle."""
        every = reduce(lambda a, b: a.unionByName(b), [self._records(source) for source in self._sources])
        width = 1 + max((slot for slot in self._roles.values()), default=0)
        counts = [F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("weight"))), F.lit(0)).alias(f"c{i}") for i in range(width)]
        return every.groupBy("kind", "number", "text").agg(*counts, F.max("top").alias("top"))

    def _narrow(self, kind: str) -> list[DataFrame]:
        """The records of one kind: of each source and key column a frame with ``number`` or ``text`` or both, a count for
        each role and, where some use has one, ``top``."""
        ours = [(source, use) for source in self._sources for use in source.uses if use.kind == kind]
        whole = {id(use): self._whole(source, use) for source, use in ours}
        width = sum(k == kind for k, _ in self._roles)
        tops = any(use.top is not None for _, use in ours)
        frames = []
        for source in self._sources:
            by_key: dict[str, list[Use]] = {}
            for use in source.uses:
                if use.kind == kind:
                    by_key.setdefault(use.key if isinstance(use.key, str) else f"{use.key} {id(use.key)}", []).append(use)
            for uses in by_key.values():
                key, columns = self._key(uses[0]), []
                if any(whole.values()):
                    columns.append((key.cast("bigint") if whole[id(uses[0])] else F.lit(None).cast("bigint")).alias("number"))
                if not all(whole.values()):
                    columns.append((F.lit(None).cast("string") if whole[id(uses[0])] else key.cast("string")).alias("text"))
                one = {i: F.lit(0) for i in range(width)}
                for use in uses:
                    held = F.lit(1) if use.when is None else F.when(use.when, 1).otherwise(0)
                    one[self._roles[kind, use.role]] = one[self._roles[kind, use.role]] + held
                columns += [column.alias(f"c{i}") for i, column in one.items()]
                if tops:
                    of = [use.top.cast("decimal(38,0)") if use.when is None else F.when(use.when, use.top.cast("decimal(38,0)")) for use in uses if use.top is not None]
                    none = F.lit(None).cast("decimal(38,0)")
                    columns.append((F.greatest(*of) if len(of) > 1 else of[0] if of else none).alias("top"))
                df = source.frame
                if all(use.when is not None for use in uses):
                    df = df.where(reduce(lambda a, b: a | b, [F.coalesce(use.when, F.lit(False)) for use in uses]))
                frames.append(df.select(*columns))
        return frames

    def _by_passes(self) -> dict[str, int]:
        """All sums, from one small job per source for its rules and rows, and one job per kind and share of its keys."""
        found, rows = {}, dict.fromkeys(self._kinds, 0)
        rule_sums = {rule: name for name, (kind, rule) in self._sums.items() if kind is None}
        for source in self._sources:
            breaches = {rule_sums[r]: self._breaches(broken) for r, broken in source.rules.items() if r in rule_sums}
            sums = [F.sum(F.when(weight > 0, weight)).alias(name) for name, weight in breaches.items()]
            (row,) = source.frame.agg(F.count(F.lit(1)).alias("rows"), *sums).collect()
            for name in breaches:
                found[name] = found.get(name, 0) + (row[name] or 0)
            # Each key column sends a record per row; those of text are about twice as large.
            for kind, key, whole in {(u.kind, str(u.key), self._whole(source, u)) for u in source.uses}:
                rows[kind] += row["rows"] * (1 if whole else 2)
        for kind in self._kinds:
            wanted = {name: value for name, (k, value) in self._sums.items() if k == kind}
            shares = max(1, -(-rows[kind] * self._shares // max(1, sum(rows.values()))))
            for share in range(shares if wanted else 0):
                (row,) = self._pass(kind, share, shares).agg(*[F.sum(value).alias(name) for name, value in wanted.items()]).collect()
                for name in wanted:
                    found[name] = found.get(name, 0) + (row[name] or 0)
        return found

    def _pass(self, kind: str, share: int, shares: int) -> DataFrame:
        """The keys of a kind whose hash falls into a share, with their counts."""
        frames = self._narrow(kind)
        keys = [c for c in ("number", "text") if c in frames[0].columns]
        if shares > 1:
            frames = [df.where(F.pmod(F.xxhash64(*keys), F.lit(shares)) == share) for df in frames]
        every = reduce(lambda a, b: a.unionByName(b), frames)
        if len(frames) == 1 and {use for use in self._roles if use[0] == kind} <= self._unique:
            # Sums in the tasks that read would hold every key of their files and send as many records. They are taken in
            # two steps of one task after the shuffle instead, hence the more parts.
            parts = 2 * int(every.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            every = every.repartition(parts, *keys)
        rest = [c for c in every.columns if c not in keys]
        aggregates = [F.max(c).alias(c) if c == "top" else F.sum(c).alias(c) for c in rest]
        missing = {"number": "bigint", "text": "string", "top": "decimal(38,0)"}
        none = {c: F.lit(None).cast(t) for c, t in missing.items() if c not in every.columns}
        return every.groupBy(*keys).agg(*aggregates).withColumns(none)

    def count(self, kind: str, role: str) -> Column:
        """Within a key: rows in this role. For use in ``keys_where`` and ``rows_where``."""
        return F.col(f"c{self._roles[kind, role]}")

    def unknown(self) -> Column:
        """Whether the key is NULL."""
        return F.col("number").isNull() & F.col("text").isNull()

    def _sum(self, kind: str | None, value: Column | str) -> Column:
        name = f"s{len(self._sums)}"
        self._sums[name] = (kind, value)
        return F.col(name)

    def _of(self, kind: str, value: Column) -> Column:
        return self._sum(kind, value)

    def surplus(self, kind: str, role: str) -> Column:
        """Rows beyond the first of each key; rows without a key are one key."""
        self._unique.add((kind, role))
        return self._of(kind, F.greatest(self.count(kind, role) - 1, F.lit(0)))

    def orphans(self, kind: str, child: str, parent: str) -> Column:
        """Child rows whose key is NULL or has no parent row."""
        return self.rows_where(kind, child, self.unknown() | (self.count(kind, parent) == 0))

    def rows_where(self, kind: str, role: str, condition: Column) -> Column:
        """Rows in this role of the keys that meet the condition; a NULL condition does not count."""
        return self._of(kind, F.when(condition, self.count(kind, role)))

    def keys_where(self, kind: str, condition: Column) -> Column:
        return self._of(kind, condition.cast("bigint"))

    def broken(self, rule: str) -> Column:
        """Breaches of a rule in all rows."""
        return self._sum(None, rule)

    def _over_groups(self, kind: str | None, value: Column | str) -> Column:
        """A sum over the groups of all kinds."""
        if kind is None:
            kind_is, value = (F.col("kind") == _RULE) & (F.col("number") == self._rules[value]), F.col("c0")
        else:
            kind_is = F.col("kind") == self._kinds[kind]
        return F.coalesce(F.sum(F.when(kind_is, value)), F.lit(0)).cast("bigint")

    def totals(self, wanted: dict[str, Column]) -> DataFrame:
        """All aggregates as one row."""
        if self._shares > 1:
            spark = self._sources[0].frame.sparkSession
            with shuffles_deleted(spark):
                found = self._by_passes()
            one = spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in found.items()])
        else:
            sums = [self._over_groups(*x).alias(name) for name, x in self._sums.items()]
            one = self._grouped().agg(F.count(F.lit(1)).alias("keys"), *sums)
        return one.select(*[column.alias(name) for name, column in wanted.items()])

    def rows(self, wanted: dict[str, Column], shape: Callable[[str, Column], Column]) -> DataFrame:
        """One row per aggregate, as the struct that ``shape`` makes of its name and value."""
        slots = {name: f"v{i}" for i, name in enumerate(wanted)}
        one = self.totals({slots[name]: column for name, column in wanted.items()})
        return one.select(F.inline(F.array(*[shape(name, F.col(slot)) for name, slot in slots.items()])))
